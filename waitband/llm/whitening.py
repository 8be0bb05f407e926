"""Embedding whitening with weighted multiplicities (operator 11).

Entries are put on a grid: x = floor(grid * c), a whole number.  Rows with equal
x are one distinct vector; the fit list is the distinct vectors, each weighing
as much as it has rows (``weights="count"``) or one (``weights="one"``).

1. Rows are grouped by x, with their number.  A vector that holds a third of all
   rows is counted in every task before the shuffle.
2. The weights and each dimension's weighted sum are added up exactly.
3. Centred GEMM: every task multiplies its vectors, moved by the whole number next
   to each mean and weighted, block by block.  While products fit, 64-bit floats
   hold these whole numbers exactly; beyond, Python's integers do.  The tasks'
   matrices are added per row of the matrix; what is left of the centring (less
   than one half in each dimension) is corrected exactly in whole numbers, so
   the covariance (divisor: sum of weights) is the true one, correctly rounded,
   however the rows were dealt.
4. Components are the covariance's unit eigenvectors by falling eigenvalue, their
   entry of largest size positive.
5. Each distinct vector is whitened once: x - mean, projected, over the square root
   of the eigenvalue; then the rows take their vector's result by a join on x.

Only matrices of dimensions x dimensions reach the driver (``DIMENSIONS`` at
most, else an error); vectors stay in tables.

Rows whose vector is null or holds a null, NaN or infinite entry are dropped.
Vectors shorter than the longest count as zero where they end.  Entries beyond a
long stop at its limits.  Components whose eigenvalue is zero (under 1e-12 of the
trace: fewer distinct vectors than dimensions, constant columns) have null
``whitened`` and explained 0 (null if all vectors are equal) and do not count in
``identity_error``.  A deviation beyond a long is null.  Repeated rows and
null ids each keep their rows; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, narrow, tidy

#: Grid steps per unit.
GRID = 256
#: Dimensions up to which the covariance (8 bytes an entry) goes to the driver.
DIMENSIONS = 4096
#: Vectors multiplied together.
BLOCK = 4096
#: Whole numbers up to here are exact as 64-bit floats.
EXACT = 1 << 53
SMALLEST = 1e-12


def gridded(rows: DataFrame, id_col: str, vector_col: str, grid: float) -> DataFrame:
    """(id, x) of the rows with whole vectors."""
    v = F.col("v")
    sound = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return narrow(rows, {id_col: "long", vector_col: "array<double>"}).toDF("id", "v").filter(F.coalesce(sound, F.lit(False))).select(
        "id", F.transform(v, lambda c: F.floor(c * F.lit(float(grid))).cast("long")).alias("x"))


def block(column: pa.Array, dims: int) -> np.ndarray:
    """(rows, dims) whole numbers; what a vector lacks is zero."""
    lens = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (lens == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lens), dims), np.int64)
    for k, row in enumerate(np.split(flat, np.cumsum(lens)[:-1])):
        out[k, :len(row)] = row
    return out


def largest(a: np.ndarray) -> int:
    return max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0


def moved(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    """x - by, exact."""
    wide = largest(x) + largest(by) >= 1 << 62
    return x.astype(object) - by if wide else x - by.astype(np.int64)


def product(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sum of w * y y' over the rows, as whole numbers of any size."""
    if y.dtype != object and largest(y) ** 2 * int(w.sum()) < EXACT:
        f = y.astype(np.float64)
        return ((f * w[:, None]).T @ f).astype(np.int64).astype(object)
    y = y.astype(object)
    return (y * w.astype(object)[:, None]).T @ y


def added(matrices: DataFrame) -> DataFrame:
    """Rows (i, cells) with the same i added up; cells are whole numbers, space-joined."""
    def run(key, table):
        total = sum(np.array([int(c) for c in t.as_py().split()], object) for t in table.column("cells"))
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "cells": [" ".join(map(str, total))]})

    return matrices.groupBy("i").applyInArrow(run, "i int, cells string")


def sums(vectors: DataFrame, dims: int, centre: np.ndarray | None = None) -> list[np.ndarray]:
    """Over the fit list ``vectors`` (x, w): one row with the weighted sum of each
    dimension, or, centred, the matrix of the sums of products."""
    def run(batches):
        total = np.zeros((1 if centre is None else dims, dims), object)
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                part = b.slice(lo, BLOCK)
                x, w = block(part.column(0), dims), part.column(1).to_numpy()
                if centre is not None:
                    total += product(moved(x, centre), w)
                elif largest(x) * int(w.sum()) < 1 << 62:
                    total[0] += (x * w[:, None]).sum(axis=0)
                else:
                    total[0] += (x.astype(object) * w.astype(object)[:, None]).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([" ".join(map(str, r)) for r in total])], ["i", "cells"])

    parts = vectors.select("x", "w").mapInArrow(tidy(run), "i int, cells string")
    found = {r["i"]: r["cells"] for r in added(parts).collect()}
    return [np.array([int(c) for c in found[i].split()], object) for i in sorted(found)]


def covariance(vectors: DataFrame, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(sum of weights, weighted sums, covariance) of the fit list; the first two exact."""
    n = int(vectors.agg(F.sum("w")).first()[0])
    s = sums(vectors, dims)[0]
    centre = np.array([(2 * int(t) + n) // (2 * n) for t in s], object)
    rest = s - n * centre  # what the moved vectors still add up to: at most n / 2
    cells = sums(vectors, dims, centre)
    # of whole numbers, Python's division is correctly rounded
    return n, s, np.array([[(n * int(c) - int(a) * int(b)) / (n * n) for c, b in zip(row, rest)] for row, a in zip(cells, rest)], float)


def components(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (zero if too small to tell) and unit eigenvectors as columns."""
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1][:k].copy(), vec[:, ::-1][:, :k].copy()
    e[e <= SMALLEST * max(np.trace(cov), 0)] = 0
    return e, vec * np.where(vec[np.abs(vec).argmax(axis=0), np.arange(vec.shape[1])] < 0, -1, 1)


def projected(vectors: DataFrame, dims: int, n: int, s: np.ndarray, e: np.ndarray, vec: np.ndarray) -> DataFrame:
    """(x, w, deviation, z): each distinct vector whitened."""
    scale = vec / np.sqrt(np.where(e > 0, e, np.nan))

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                part = b.slice(lo, BLOCK)
                x = block(part.column(0), dims)
                exact = n * (largest(x) + 1) + largest(s)
                y = n * x - s.astype(np.int64) if exact < 1 << 62 else n * x.astype(object) - s
                far = (y * y if exact ** 2 * dims < 1 << 63 else y.astype(object) ** 2).sum(axis=1)
                z = (y / n).astype(np.float64) @ scale
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([int(f) if f < 1 << 63 else None for f in far], pa.int64()),
                    pa.array([[None if np.isnan(c) else c for c in r] for r in z.tolist()], pa.list_(pa.float64()))], ["x", "w", "deviation", "z"])

    return vectors.mapInArrow(tidy(run), "x array<long>, w long, deviation long, z array<double>")


def identity_error(whitened: DataFrame, live: list[int]) -> float | None:
    """Largest entry, in size, of the whitened vectors' covariance minus the identity."""
    if not live:
        return None
    total = F.sum("w")
    mean = whitened.agg(*[(F.sum(F.col("w") * F.get("z", F.lit(k))) / total).alias(f"m{k}") for k in live]).first()
    off = {k: F.get("z", F.lit(k)) - F.lit(mean[f"m{k}"]) for k in live}
    pairs = [(a, b) for a in live for b in live if a <= b]
    cov = whitened.agg(*[(F.sum(F.col("w") * off[a] * off[b]) / total).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(cov[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(rows: DataFrame, k: int = 4, weights: str = "one", grid: float = GRID, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """A row per sound row and component up to ``k`` (fewer if there are fewer
    dimensions): vec_id, component, n (sum of weights), deviation (sum over
    dimensions of (n x - S)^2), whitened, explained, identity_error."""
    if weights not in ("one", "count"):
        raise ValueError(f"weights is {weights!r}, not one or count")
    x = gridded(rows, id_col, vector_col, grid)
    vectors = materialise(x.groupBy("x").agg(F.count("*").alias("rows")).select(
        "x", (F.lit(1).cast("long") if weights == "one" else F.col("rows")).alias("w")), "whitening-vectors")
    dims = vectors.agg(F.max(F.size("x"))).first()[0]
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not dims:  # no vectors, or only empty ones: no components
        return rows.sparkSession.createDataFrame([], schema)
    if dims > DIMENSIONS:
        raise ValueError(f"{dims} dimensions; at most {DIMENSIONS}")
    n, s, cov = covariance(vectors, dims)
    e, vec = components(cov, min(k, dims))
    trace = float(np.trace(cov))
    whitened = materialise(projected(vectors, dims, n, s, e, vec), "whitening-whitened")
    error = identity_error(whitened, [i for i in range(len(e)) if e[i] > 0])
    parts = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.get("z", F.lit(i)).alias("whitened"),
                               F.lit(float(e[i]) / trace if trace > 0 else None).cast("double").alias("explained")) for i in range(len(e))])
    done = whitened.select("x", "deviation", parts.alias("parts"))
    return x.join(done, "x").select("id", "deviation", F.explode("parts").alias("p")).select(
        F.col("id").alias("vec_id"), "p.component", F.lit(n).cast("long").alias("n"), "deviation", "p.whitened", "p.explained",
        F.lit(error).cast("double").alias("identity_error"))
