import random
from collections import Counter

import numpy as np
import pytest

from waitband.llm import bagminhash, graph, neardup

from . import cases


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    for case in range(4):
        n = 50
        top = [2, 9, 40, 3][case]
        a = rng.integers(0, top, n)
        b = np.where(rng.random(n) < 0.7, a, rng.integers(0, top, n))
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        got = []
        for _ in range(60):
            ids = rng.integers(0, 1 << 63, n).astype(np.uint64)
            which = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
            sig = bagminhash.signatures(which, np.concatenate([ids[a > 0], ids[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, 128)
            got.append((sig[0] == sig[1]).mean())
        assert abs(np.mean(got) - want) < 4 * np.std(got) / 60 ** 0.5 + 0.003, (want, np.mean(got))


def test_signatures_do_not_depend_on_the_block():
    rng = np.random.default_rng(2)
    bags = [(rng.integers(0, 1 << 63, n).astype(np.uint64), rng.integers(1, 6, n)) for n in (1, 3, 50, 700)]
    which = np.repeat(np.arange(4), [len(e) for e, _ in bags])
    together = bagminhash.signatures(which, np.concatenate([e for e, _ in bags]), np.concatenate([c for _, c in bags]), 4, 192)
    for k, (e, c) in enumerate(bags):
        assert (bagminhash.signatures(np.zeros(len(e), int), e, c, 1, 192)[0] == together[k]).all()


def test_overlap():
    rng = random.Random(3)
    for _ in range(50):
        a, b = ([rng.randint(0, 9) for _ in range(rng.randint(0, 30))] for _ in range(2))
        ca, cb = Counter(a), Counter(b)
        want = sum((ca & cb).values()) / sum((ca | cb).values()) if a and b else 0.0
        assert neardup.overlap(np.sort(np.array(a, np.uint32)), np.sort(np.array(b, np.uint32))) == want


def test_components(spark):
    rng = random.Random(1)
    for edges in ([], [(1, 2)], [(i, i + 1) for i in range(0, 60)], [(0, i) for i in range(1, 50)], [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)]):
        up = {n: n for e in edges for n in e if e[0] != e[1]}

        def find(x):
            while up[x] != x:
                x = up[x]
            return x
        for a, b in edges:
            if a != b:
                ra, rb = find(a), find(b)
                up[max(ra, rb)] = min(ra, rb)
        got = {r.node: r.comp for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {n: find(n) for n in up}


def brute(docs):
    """Classes of all pairs, compared by their multisets of word runs."""
    def bag(t):
        ws = neardup.WORD.findall((t or "").lower())
        k = min(5, len(ws))
        return Counter(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)) if ws else Counter()
    bags = [bag(t) for _, t in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(docs)):
        for j in range(i):
            if bags[i] and sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {frozenset(k for k in range(len(docs)) if find(k) == c) for c in {find(k) for k in range(len(docs))}}


def near_copies(rng):
    """Chains and stars of edited copies, whose ends may be less alike than the limit."""
    docs = []
    for g in range(8):
        text = [f"w{rng.randint(0, 900)}" for _ in range(rng.randint(6, 260))]
        for k in range(rng.randint(1, 9)):
            docs.append(" ".join(text))
            if rng.random() < 0.7:
                text = list(text)
                for _ in range(max(1, len(text) // 90)):
                    text[rng.randrange(len(text))] = f"w{rng.randint(0, 900)}"
            if rng.random() < 0.2:
                text = text + text[:len(text) // 8]
    common = " ".join(f"c{k}" for k in range(60))
    docs += [common + " " + " ".join(f"o{i}x{k}" for k in range(rng.randint(3, 60))) for i in range(25)]
    docs += ["a b", "a b", "a  B!", "a b c", "a b c d e", "a b c d e f"]
    return docs


def test_classes_against_all_pairs(spark):
    for seed in (1, 2):
        docs = list(enumerate(near_copies(random.Random(seed))))
        docs += [(900, None), (901, None), (902, ""), (903, "!!"), (904, "")]
        rows = neardup.classes(spark.createDataFrame([(*d, 1, 1) for d in docs], "doc_id long, text string, row long, key int")).collect()
        at = {d: k for k, (d, _) in enumerate(docs)}
        found = {}
        for r in rows:
            found.setdefault(r.class_id, set()).add(at[r.doc_id])
        assert {frozenset(s) for s in found.values()} == brute(docs)
        assert all(r.class_id == min(x.doc_id for x in rows if x.class_id == r.class_id) for r in rows)
        assert sorted(r.doc_id for r in rows if r.first) == sorted(found)


def test_prefix_filter_loses_no_pair(spark):
    """Texts with a heavy common part of all shares: every similar pair of different components is proposed."""
    rng = np.random.default_rng(4)
    bags = []
    for _ in range(120):
        heavy = int(rng.integers(60, 140))
        rare = rng.integers(100, 2000, int(rng.integers(0, 45)))
        base = rng.integers(0, 6)
        bags.append(np.sort(np.concatenate([np.full(heavy, 1), np.full(heavy // 2, 2), np.arange(3 + 20 * base, 3 + 20 * base + rng.integers(0, 15)), rare]).astype(np.uint32)))
    nodes = spark.createDataFrame([(k, k % 50, bytearray(b.tobytes())) for k, b in enumerate(bags)], "node long, comp long, bag binary")
    got = {(r.a, r.b) for r in neardup.prefix_pairs(nodes).collect()}
    want = {(a, b) for b in range(120) for a in range(b) if a % 50 != b % 50 and neardup.overlap(bags[a], bags[b]) >= 0.8}
    every = sum(a % 50 != b % 50 for b in range(120) for a in range(b))
    assert want and want <= got and len(got) < every


def test_classes_when_all_buckets_are_large(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 1)
    docs = list(enumerate(near_copies(random.Random(5))))
    rows = neardup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = {}
    for r in rows:
        found.setdefault(r.class_id, set()).add(r.doc_id)
    assert {frozenset(s) for s in found.values()} == brute(docs)


def test_keep_first_and_edge_rows(spark):
    docs = cases.documents(spark)
    rows = neardup.classes(docs)
    assert rows.count() == docs.count()
    kept = neardup.keep_first(docs)
    assert kept.columns == docs.columns
    # copies of texts 0, 1 and 3 go, and what has equal content; of the wordless rows equal in id and text one stays
    texts = [r.text for r in kept.collect() if r.text and neardup.WORD.search(r.text)]
    assert len(texts) == len(set(texts)) == len({r.text for r in docs.collect() if r.text and neardup.WORD.search(r.text)})
    assert neardup.classes(cases.empty(spark)).count() == 0 and neardup.keep_first(cases.empty(spark)).count() == 0


def test_texts_pass_to_python_in_small_batches(spark, monkeypatch):
    from waitband.session import BATCH_ROWS
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def first_job(df, name):
        raise RuntimeError(f"{name} {spark.conf.get(key)}")

    monkeypatch.setattr(neardup, "materialise", first_job)
    try:
        for own, want in ((10_000, BATCH_ROWS), (0, BATCH_ROWS), (7, 7)):   # a caller's smaller batches stay
            spark.conf.set(key, str(own))
            with pytest.raises(RuntimeError, match=f"^neardup-rows {want}$"):
                neardup.classified(cases.documents(spark))
            assert spark.conf.get(key) == str(own)
    finally:
        spark.conf.set(key, before)
