import math
import random
from fractions import Fraction

import numpy as np
import pytest

from waitband.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, w int, id int, n int"


def table(spark, vectors):
    vectors = [v and [None if c is None else float(c) for c in v] for v in vectors]
    return spark.createDataFrame([(i, v, 0, "x", 1, 1, 1) for i, v in enumerate(vectors)], SCHEMA)


def random_vectors(rng, n, dims, copies=0):
    out = [[float(np.float32(rng.gauss(0.1 * d, 0.2 + 0.1 * d))) for d in range(dims)] for _ in range(n)]
    return out + [out[0]] * copies


def by_definition(vectors, k, counts=False):
    """Exact sums and covariance in fractions; eigenvectors of the rounded matrix."""
    rows = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in enumerate(vectors)
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = {}
    for _, x in rows:
        fit[x] = fit.get(x, 0) + 1 if counts else 1
    n, dims = sum(fit.values()), len(rows[0][1])
    s = [sum(w * x[d] for x, w in fit.items()) for d in range(dims)]
    cov = np.array([[float(sum(w * (x[a] - Fraction(s[a], n)) * (x[b] - Fraction(s[b], n)) for x, w in fit.items()) / n)
                     for b in range(dims)] for a in range(dims)])
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1], vec[:, ::-1]
    out = {}
    for i, x in rows:
        dev = sum((n * x[d] - s[d]) ** 2 for d in range(dims))
        y = np.array([float(Fraction(n * x[d] - s[d], n)) for d in range(dims)])
        for c in range(min(k, dims)):
            out.setdefault((i, c + 1), []).append((n, dev, float(y @ vec[:, c] / math.sqrt(e[c])), e[c] / cov.trace()))
    return out


@pytest.mark.parametrize("weights", ["one", "count"])
def test_rows_by_definition(spark, weights):
    rng = random.Random(4)
    vectors = random_vectors(rng, 150, 6, copies=80)
    vectors += [None, [1.0, None, 0, 0, 0, 0], [math.nan] + [0.0] * 5, [math.inf] + [0.0] * 5, [-0.0] * 6, [0.0] * 6]
    df = table(spark, vectors).repartition(5)
    got = whitening.whiten(df.union(df.filter("vec_id = 7")), weights=weights).collect()
    want = by_definition([*vectors, vectors[7]], 4, counts=weights == "count")
    assert len(got) == 4 * (150 + 80 + 2 + 1)
    sign = {}
    for r in got:
        n, dev, z, explained = want[min(r["vec_id"], len(vectors)), r["component"]][0]
        assert (r["n"], r["deviation"]) == (n, dev)
        if abs(z) > 1e-3:
            assert sign.setdefault(r["component"], np.sign(z * r["whitened"])) == np.sign(z * r["whitened"])
        assert abs(abs(r["whitened"]) - abs(z)) < 1e-9 and abs(r["explained"] / explained - 1) < 1e-9
        assert r["identity_error"] < 1e-9
    assert len(sign) == 4


def test_covariance_is_exact_for_huge_entries(spark):
    """Products beyond 2^53 and 2^63 are added as whole numbers."""
    rng = random.Random(6)
    vectors = [[rng.uniform(-1, 1) * 10.0 ** rng.choice([0, 6, 12]), rng.uniform(9e9, 9.1e9), rng.uniform(-1, 1)] for _ in range(60)]
    df = table(spark, vectors)
    x = [[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors]
    rows = whitening.gridded(df, "vec_id", "embedding", 256).collect()
    assert {r["id"]: r["x"] for r in rows} == dict(enumerate(x))
    fit = whitening.gridded(df, "vec_id", "embedding", 256).selectExpr("x", "1L as w").repartition(4)
    n, s, cov = whitening.covariance(fit, 3)
    assert (n, s.tolist()) == (60, [sum(c) for c in zip(*x)])
    for a in range(3):
        for b in range(3):
            true = sum((r[a] - Fraction(s[a], n)) * (r[b] - Fraction(s[b], n)) for r in x) / n
            assert cov[a, b] == float(true)
    over = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df).collect()}
    for i, r in enumerate(x):
        dev = sum((60 * c - int(t)) ** 2 for c, t in zip(r, s))
        assert over[i] == (dev if dev < 1 << 63 else None)


def test_degenerate_tables(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [None, [], [math.nan]])).collect() == []
    same = whitening.whiten(table(spark, [[1.0, 2.0]] * 3)).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same] == [
        (c, 1, 0, None, None, None) for _ in range(3) for c in (1, 2)]
    flat = whitening.whiten(table(spark, [[1.0, 2.0, 3.0], [2.0, 4.0, 3.0], [2.0, 4.0]])).collect()  # the last ends with a zero
    assert {r["component"] for r in flat} == {1, 2, 3} and all((r["whitened"] is None) == (r["component"] == 3) for r in flat)
    assert all(r["identity_error"] < 1e-9 for r in flat)
