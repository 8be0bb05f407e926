import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from waitband.llm import runs

from . import cases


def by_definition(words):
    """(start, length, period): every stretch that equals itself q further on, for every q."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    a, out = np.array([number[w] for w in words], int), {}
    for q in range(1, len(a) // 3 + 1):
        edge = np.diff(np.concatenate([[0], (a[:-q] == a[q:]).astype(int), [0]]))
        for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if e - s + q >= max(24, 3 * q):
                out.setdefault((s, e - s + q), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def woven(rng):
    """Words of periodic stretches, stretches of stretches, and noise."""
    letters, words = [str(i) for i in range(rng.choice([1, 2, 3, 5, 20]))], []
    for _ in range(rng.randint(1, 6)):
        kind = rng.random()
        if kind < 0.4:
            words += rng.choices(letters, k=rng.randint(0, 60))
        elif kind < 0.8:
            p = rng.choices(letters, k=rng.randint(1, 30))
            if rng.random() < 0.4:
                p = p * rng.randint(1, 5) + rng.choices(letters, k=rng.randint(0, 3))
            p = p * rng.randint(1, 8)
            words += p[:rng.randint(len(p) // 2, len(p))]
            if words and rng.random() < 0.3:
                words += words[-rng.randint(1, len(words)):]
        elif words:
            words += words[-rng.randint(1, 40):] * rng.randint(1, 4)
    return words[:900]


@pytest.mark.parametrize("part", range(4))
def test_runs_by_definition(part):
    for seed in range(part * 250, part * 250 + 250):
        words = woven(random.Random(seed))
        assert runs.find(words) == by_definition(words), seed


@pytest.mark.parametrize("words", [
    ["a"] * 5000,
    ["a", "b"] * 1500 + ["a"],
    (list("aab") * 9 + ["c"]) * 30,
    [w for i in range(14) for w in ["x"] * 25 + [str(i % 2)]],
    [bin(i).count("1") % 2 and "1" or "0" for i in range(4096)],  # overlap-free: no run
])
def test_extremes(words):
    assert runs.find(words) == by_definition(words)


def test_grammar_gives_the_sequence_back():
    rng = random.Random(8)
    for _ in range(50):
        number: dict = {}
        ids = [number.setdefault(w, len(number)) for w in woven(rng) or ["a"]]
        g = runs.Grammar(ids)

        def spell(x):
            return [x] if x < g.base else spell(g.left[x - g.base]) + spell(g.right[x - g.base])

        assert [i for _, x in g.top for i in spell(x)] == ids
        for k in range(len(g.size)):
            text = spell(g.base + k)
            assert ids[g.at[k]:g.at[k] + g.size[k]] == text and len(text) == g.size[k]
        pairs = [(a[1], b[1]) for a, b in zip(g.top, g.top[1:])]
        again = {p for p in pairs if pairs.count(p) > 1 and p[0] != p[1]}
        assert not again  # no pair is left twice


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = by_definition(words)
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            sha("".join(f"{s},{k},{q}\n" for s, k, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_rows_by_definition(spark):
    rng = random.Random(1)
    texts = [cases.prose(rng, rng.randint(1, 300)) for _ in range(60)] + [" ".join(woven(rng)) for _ in range(30)]
    texts += [None, "", " \n\t", "é " * 30, "a\x85b " * 40, "a b c " * 20, "x" * 30_000, cases.prose(rng, 6000), texts[0]]
    df = cases.documents(spark, texts)
    key = lambda r: tuple((x is None, x) for x in r)
    want = sorted((expected(r["doc_id"], r["text"]) for r in df.collect()), key=key)
    assert sorted((tuple(r) for r in runs.digests(df).collect()), key=key) == want
    assert any(r[1] > 1 for r in want)
    assert runs.digests(cases.empty(spark)).collect() == []


def test_runs_and_collapsed_texts(spark):
    df = spark.createDataFrame([(1, "say " + "on and " * 15 + "end"), (2, None), (3, "plain words")], "doc_id long, text string")
    assert [tuple(r) for r in runs.detect(df).collect()] == [(1, 1, 30, 2)]
    assert {r["doc_id"]: r["text"] for r in runs.collapse(df).collect()} == {1: "say on and end", 2: "", 3: "plain words"}
