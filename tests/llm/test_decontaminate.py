import collections
import hashlib
import random
import re

from waitband.llm import decontaminate

from . import cases

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, items):
    windows = collections.defaultdict(set)
    sizes = set()
    for i, t in items:
        ws = words(t)
        k = min(10, len(ws))
        sizes.add(k)
        for a in range(len(ws) - k + 1) if k else ():
            windows[tuple(ws[a:a + k])].add(str(i))
    out = []
    for d, t in docs:
        ws, hit, found = words(t), set(), set()
        for k in sizes - {0}:
            for a in range(len(ws) - k + 1):
                if own := windows.get(tuple(ws[a:a + k])):
                    found |= own
                    hit |= set(range(a, a + k))
        out.append((-1 if d is None else d, len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def test_against_all_windows(spark):
    rng = random.Random(2)
    vocab = ["a", "b", "C", "d1", "É", "é", "x"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 4, 9, 10, 11, 25])))) for i in range(25)]
    items += [(7, "one more row of the same item id with quite enough words in it"), (90, None), (91, ""), (92, "a " * 40)]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 400)))) for i in range(40)]
    for k, (_, t) in enumerate(items[:25]):
        cut = (t or "").split()
        docs.append((100 + k, "zz " * (k % 3) + "; ".join(cut[:10 + k % 5]).upper() + " yy"))
    docs += [(200, None), (201, ""), (202, "a " * 300), (203, "word " * 5), docs[0], docs[0], (None, items[3][1]), (None, None), (0, "another text of the same id a b C d1")]
    got = decontaminate.contamination(spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, n int, key string"),
                                      spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, at int"))
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got.collect()) == brute(docs, items)


def test_no_short_items_and_the_wide_way(spark, monkeypatch):
    """Beyond the broadcast bound the joins shuffle; results stay."""
    rng = random.Random(4)
    text = [f"w{rng.randint(0, 500)}" for _ in range(3000)]
    items = [(i, " ".join(text[100 * i:100 * i + 30])) for i in range(20)]
    docs = [(i, " ".join(text[60 * i:60 * i + 75])) for i in range(45)]
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", 0)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert sorted(map(tuple, decontaminate.contamination(d, i).collect())) == want
    assert {r.doc_id for r in decontaminate.clean(d, i).collect()} == {w[0] for w in want if not w[5]}


def test_edge_rows(spark):
    docs = cases.documents(spark)
    items = spark.createDataFrame([(1, docs.collect()[0].text)], "item_id long, text string")
    out = decontaminate.contamination(docs, items)
    assert out.count() == docs.count()
    assert decontaminate.clean(docs, items).columns == docs.columns
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.contamination(docs, none).collect()} == {0}
    assert decontaminate.clean(docs, none).count() == docs.count()
    assert decontaminate.contamination(cases.empty(spark), items).count() == 0


def test_keys_of_a_long_item_carry_only_the_words_around(spark):
    words = [f"w{k * 7919 % 3001}" for k in range(3000)]
    items = spark.createDataFrame([("long", " ".join(words))], "item_id string, text string")
    keys = decontaminate.item_keys(items, []).collect()
    assert len(keys) > 100 and max(len(v) for r in keys for v in r if isinstance(v, list)) <= decontaminate.SPAN + 2 * (decontaminate.SPAN - decontaminate.GRAM)
    texts = [" ".join(words[:10]), " ".join(words[-10:]), "a " + " ".join(words[1500:1530]) + " b", " ".join(words[700:709])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.contamination(docs, items).collect()} == {0: 10, 1: 10, 2: 30, 3: 0}
