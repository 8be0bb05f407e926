import random

from waitband.llm import spans

from . import cases


def passage(rng, n):
    out = []
    for k in range(n):
        out.append("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) + (". " if k % 9 == 8 else " "))
    return "".join(out).strip() + "."


def brute(docs, least):
    """Sentence numbers to remove: every run of sentences, minimal from either side, by its words."""
    found = []
    for i, t in docs:
        ws = [spans.WORD.findall(t[a:b].lower()) for a, b in spans.sentences(t or "")]
        runs = set()
        for a in range(len(ws)):
            for b in range(a, len(ws)):
                n = sum(map(len, ws[a:b + 1]))
                if ws[a] and ws[b] and n >= least and (n - len(ws[a]) < least or n - len(ws[b]) < least):
                    runs.add((a, b))
        found += [(i, a, b, tuple(w for x in ws[a:b + 1] for w in x)) for a, b in runs]
    first = {}
    for i, a, b, w in sorted(found):
        first.setdefault(w, (i, a, b))
    out = {i: set() for i, _ in docs}
    for i, a, b, w in found:
        if first[w] != (i, a, b):
            out[i] |= set(range(a, b + 1))
    return {i: sorted(s) for i, s in out.items()}


def test_sentences_cover_the_text():
    for t in ["", "a", "A b. C d!  E\n\nf", ".", "\n\n", "x. \ny", "no end"]:
        cut = spans.sentences(t)
        assert "".join(t[a:b] for a, b in cut) == t


def test_against_all_runs(spark):
    rng = random.Random(11)
    shared = [passage(rng, 70) for _ in range(3)]
    docs = []
    for i in range(30):
        own = [passage(rng, rng.randint(20, 90)) for _ in range(2)]
        t = own[0] + rng.choice([" ", "\n"]) + (shared[i % 3] if i % 2 else "") + "\n" + own[1]
        docs.append((i, t + ("\n" + own[0] if i == 5 else "")))
    docs += [(50, docs[4][1]), (51, "short. text."), (52, "A b. " * 40)]
    got = spans.dedup(spark.createDataFrame([(*d, 9, 9) for d in docs], "doc_id long, text string, removed int, key int"))
    assert got.columns == ["doc_id", "text", "key", "removed", "n_sentences", "n_removed"]
    rows = {r.doc_id: r for r in got.collect()}
    want = brute(docs, spans.LEAST_WORDS)
    for i, t in docs:
        cut = spans.sentences(t)
        assert rows[i].removed == want[i] and rows[i].n_sentences == len(cut) and rows[i].n_removed == len(want[i])
        assert rows[i].text == "".join(t[a:b] for k, (a, b) in enumerate(cut) if k not in want[i])
    assert rows[1].text.count(shared[1]) == 1 and all(shared[1] not in rows[i].text for i in (7, 13, 19, 25))
    assert rows[50].text == ""


def test_edge_rows(spark):
    docs = cases.documents(spark)
    out = spans.dedup(docs)
    assert out.count() == docs.count()
    assert sum(r.text is None for r in out.collect()) == sum(r.text is None for r in docs.collect())
    assert spans.dedup(cases.empty(spark)).count() == 0
    again = spark.createDataFrame([(1, "one two three. " * 30)] * 2 + [(2, "x")], "doc_id long, text string")
    a, b = [r.text for r in spans.dedup(again).filter("doc_id = 1").collect()]
    assert a == b != ""


def test_short_runs_of_several_sentences(spark):
    rng = random.Random(12)
    two = "The ferry left the old harbour late. Nobody on the pier had seen it go."
    pieces = [passage(rng, 9).rstrip(".") for _ in range(3)]  # one sentence of 27 words, or three lines
    docs = [(1, f"{passage(rng, 30)} {two} {passage(rng, 30)}"), (2, f"Cut here so {two[4:]} {two} And {passage(rng, 30)}"),
            (3, "Read more. Sign up. " + passage(rng, 30)), (4, "Read more. Sign up. " + passage(rng, 30)),
            (5, " ".join(pieces) + "."), (6, "\n".join(pieces)), (7, "... A b. ! " * 3)]
    rows = {r.doc_id: r for r in spans.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[1].n_removed == 0 and rows[1].text.count(two) == 1
    assert two not in rows[2].text and rows[2].n_removed == 2 and rows[2].text.startswith("Cut here so")
    assert rows[3].n_removed == rows[4].n_removed == 0  # a stock phrase under the floor
    assert rows[5].n_removed == 0 and rows[6].text == ""  # the 25-word runs stand beside
    # every run of several sentences over the floor that stands earlier is covered
    some = [" ".join(rng.choice("abcdef") for _ in range(n)) + ". " for n in (0, 1, 2, 3, 4, 5, 6)]
    text = "".join(rng.choice(some) for _ in range(120))
    ws = [spans.WORD.findall(text[a:b]) for a, b in spans.sentences(text)]
    _, again = spans.runs(text, 25)
    got, want, seen = {k for a, b in again for k in range(a, b + 1)}, set(), set()
    for a in range(len(ws)):
        for b in range(a + 1, len(ws)):
            run = tuple(map(tuple, filter(None, ws[a:b + 1])))
            if ws[a] and ws[b] and sum(map(len, run)) >= spans.FLOOR_WORDS:
                want |= set(range(a, b + 1)) if run in seen else set()
                seen.add(run)
    assert want <= got and want
