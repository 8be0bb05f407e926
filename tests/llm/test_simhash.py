import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from waitband.llm import simhash

from . import cases


def by_definition(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [words[i:i + 4] for i in range(len(words) - 3)] if len(words) >= 4 else [words] if words else []
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def reachable(rows):
    """Least id that links of at most four bits lead to, by all pairs."""
    fps = sorted({f for _, f in rows})
    up = {f: f for f in fps}

    def top(f):
        while up[f] != f:
            f = up[f]
        return f

    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= 4:
            up[top(a)] = top(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[top(f)] = min(i, least.get(top(f), i))
    return [(i, f"{f:016x}", least.get(top(f))) for i, f in rows]


def key(r):
    return tuple((x is None, x) for x in r)


def test_fingerprints_and_components_by_definition(spark):
    rng = random.Random(2)
    base = [cases.prose(rng, 60).split() for _ in range(6)]
    texts = [" ".join(b) for b in base]
    for b in base:
        for _ in range(25):
            c = list(b)
            c[rng.randrange(len(c))] = "changed"
            texts.append(" ".join(c).swapcase() if rng.random() < 0.3 else " ".join(c))
    texts += [None, "", " \n", "one", "ONE", "one two three four", "one two three four five", "é É", "x " * 70_000, "a\x1cb c\x85d", texts[3], texts[9]]
    df = cases.documents(spark, texts)
    want = reachable([(r["doc_id"], by_definition(r["text"])) for r in df.collect()])
    got = [tuple(r) for r in simhash.classes(df).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert len({c for _, _, c in got}) < len(texts)


@pytest.mark.parametrize("small", [1, 2, 5, simhash.SMALL])
def test_no_link_is_lost_in_clouds(spark, small):
    """Long lists go by the fingerprints half-way, short ones by pairs."""
    rng = np.random.default_rng(3)
    fps = set()
    for c in rng.integers(0, 1 << 63, 4, dtype=np.uint64).tolist():
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            fps.add(c ^ sum(1 << int(k) for k in flips))
    fps |= {0, 15, (1 << 64) - 1, 1 << 63}
    df = spark.createDataFrame([(np.uint64(f).astype(np.int64).item(),) for f in fps], "fp long")
    comp = {r["node"] & (1 << 64) - 1: r["comp"] for r in simhash.links(df, small).collect()}
    want = {}
    for i, f, c in reachable(list(enumerate(sorted(fps)))):
        want.setdefault(c, set()).add(int(f, 16))
    got = {}
    for f in fps:
        got.setdefault(comp.get(f, ("alone", f)), set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_lists_meet_exactly_at_four_shared_bytes(spark):
    rng = np.random.default_rng(4)
    fps = [int(x) for x in rng.integers(0, 1 << 62, 30)]
    fps += [f ^ int.from_bytes(bytes(rng.choice([0, 0, 0, 7], 8).tolist()), "little") & (1 << 62) - 1 for f in fps]
    rows = spark.createDataFrame([(f,) for f in fps], "fp long").select("fp", simhash.lists().alias("l")).collect()
    for a, b in combinations(rows, 2):
        same = sum(a["fp"] >> 8 * p & 255 == b["fp"] >> 8 * p & 255 for p in range(8))
        assert bool(set(a["l"]) & set(b["l"])) == (same >= 4)


def test_empty_and_missing(spark):
    assert simhash.classes(cases.empty(spark)).collect() == []
    only = simhash.classes(cases.documents(spark, [None, None]).selectExpr("cast(null as long) as doc_id", "text")).collect()
    assert [tuple(r) for r in only] == [(None, "0" * 16, None)] * 2
