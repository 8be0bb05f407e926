"""Toxicity grades by cumulative-link ordinal regression (operator 4).

A document's features are its distinct lower-case words and their first four,
five and six letters, hashed.  P(grade <= k) = sigmoid(theta_k - w.x): one weight
vector for all thresholds, which stay in order because their distances are
exponentials.  The output is the expected grade, the likeliest grade and
P(grade >= 1), the verdict.

Fitting uses a bounded sample: at most ``SAMPLE`` distinct pairs of a labelled id
and a text, those of least id hash; an id that stands in any number of rows
counts once per text.  Ids are joined by broadcast (the bound makes that safe), their
features counted per class in Spark, and only the at most ``FEATURES`` that tell
the classes apart beyond chance (G2 of at least ``LEAST_G2``, and found in toxic
documents most of the time) reach the driver, with the sample's rows in sparse form.  Scoring runs over every document, whole
texts, without a shuffle.

Grades.  ``fit`` takes whole-number grades from 0.  Where labels only say toxic
or not, ``graded`` makes them out of fold: the sample is dealt into two halves,
each half's telling features are found, and a toxic document gets 1 to 3 by
thirds of how many of its distinct words carry a telling feature of the other
half.  So a document's own label has no part in what makes its grade.  (Shares
of its words instead of their number made grades that no sum over features can
order: on the check tool's small input a quarter of the toxic documents was
then missed.)

A null or empty text scores by the thresholds alone.  Documents without a label,
labels without a document and null labels are not fitted on; a document labelled
twice takes its higher label.  Without labels of both kinds nothing is toxic.
Repeated rows each get a row; a null doc_id is kept and never fitted on.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, narrow, tidy

SAMPLE = 12_000
FEATURES = 4_096
LEAST_G2 = 40.0
PREFIXES = (4, 5, 6)
LEVELS = 3
MEMO = 400_000
WORD = re.compile(r"\w+")


def features(word: str) -> list[int]:
    names = ["w" + word, *(f"p{word[:k]}" for k in PREFIXES if len(word) >= k)]
    return [xxhash.xxh3_64_intdigest(n) - (1 << 63) for n in names]


@dataclass
class Model:
    """Feature hash -> column, weights, ordered thresholds."""
    columns: dict[int, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.array([20.0]))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """P(grade = k) for linear scores ``x``: a row per score."""
        below = 1 / (1 + np.exp(np.clip(x[:, None] - self.thresholds[None, :], -60, 60)))
        return np.diff(below, axis=1, prepend=0.0, append=1.0)


def fit(rows: list[tuple[list[int], int]], width: int, grades: int, rounds: int = 600, ridge: float = 3e-6) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds for ``rows`` of (columns present, grade), by
    gradient steps with momentum and per-weight scale, which need no line search."""
    n = len(rows)
    which = np.repeat(np.arange(n), [len(c) for c, _ in rows])
    cols = np.fromiter((c for r, _ in rows for c in r), np.int64, len(which))
    y = np.array([g for _, g in rows])
    share = np.clip(np.array([(y <= k).mean() for k in range(grades - 1)]), 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    p = np.concatenate([np.zeros(width), start[:1], gaps])
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for t in range(1, rounds + 1):
        w, theta = p[:width], np.cumsum(np.concatenate([p[width:width + 1], np.exp(p[width + 1:])]))
        x = np.bincount(which, w[cols], n)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        hi, lo = edge[y + 1] - x, edge[y] - x
        s_hi, s_lo = np.where(np.isinf(hi), 1.0, sigmoid(hi)), np.where(np.isinf(lo), 0.0, sigmoid(lo))
        mass = np.maximum(s_hi - s_lo, 1e-12)
        d_hi, d_lo = s_hi * (1 - s_hi) / mass, s_lo * (1 - s_lo) / mass
        dx = (d_hi - d_lo) / n
        g_w = np.bincount(cols, dx[which], width) + ridge * w
        g_theta = np.array([-d_hi[y == k].sum() + d_lo[y == k + 1].sum() for k in range(grades - 1)]) / n
        after = np.cumsum(g_theta[::-1])[::-1]
        g = np.concatenate([g_w, after[:1], after[1:] * np.exp(p[width + 1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return p[:width], np.cumsum(np.concatenate([p[width:width + 1], np.exp(p[width + 1:])]))


def sampled(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(doc_id, text, label, half) of the sample: at most ``limit`` rows."""
    order = F.xxhash64("doc_id"), F.col("doc_id")
    marked = narrow(labels, {"doc_id": "long", "label": "int"}).filter("doc_id is not null and label is not null").groupBy(
        "doc_id").agg(F.max("label").alias("label")).orderBy(*order).limit(limit)
    rows = narrow(docs, {"doc_id": "long", "text": "string"}).join(F.broadcast(marked), "doc_id").withColumn("tag", F.xxhash64("text"))
    # an id in many rows: which of its texts count is settled on ids and hashes, before any text moves
    taken = rows.select("doc_id", "tag").distinct().orderBy(*order, "tag").limit(limit)
    one = rows.join(F.broadcast(taken), ["doc_id", "tag"]).groupBy("doc_id", "tag", "label").agg(F.min("text").alias("text"))
    return one.select("doc_id", "text", "label", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int").alias("half"))


def telling(sample: DataFrame, most: int) -> list[int]:
    """Hashes of the features that occur in toxic documents beyond chance, in order."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                found, toxic = [], []
                for t, label in zip(part.column(0), part.column(1)):
                    own = {f for w in set(WORD.findall((t.as_py() or "").lower())) for f in features(w)}
                    found += own
                    toxic += [int(label.as_py() > 0)] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(toxic, pa.int64())], ["f", "toxic"])

    total, bad = sample.agg(F.count("*"), F.sum((F.col("label") > 0).cast("long"))).first()
    if not total or not bad or bad == total:
        return []
    seen = sample.select("text", "label").mapInArrow(tidy(run), "f long, toxic long").groupBy("f").agg(F.sum("toxic").alias("a"), F.count("*").alias("n")).filter("n >= 5")
    base = bad / total
    part = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    a, n = F.col("a"), F.col("n")
    table = [(a, n * base), (n - a, n * (1 - base)), (bad - a, (total - n) * base), (total - n - (bad - a), (total - n) * (1 - base))]
    score = sum((part(o, e) for o, e in table[1:]), part(*table[0])) * 2
    best = seen.filter(a / n > (1 + base) / 2).withColumn("g2", score).filter(F.col("g2") >= LEAST_G2).orderBy(F.desc("g2"), "f").limit(most)
    return [r["f"] for r in best.collect()]


def columns_of(sample: DataFrame, columns: dict[int, int]) -> list[tuple]:
    """(doc_id, label, columns present) of the sample's rows, in id order."""
    def run(batches):
        for b in batches:
            out = []
            for i, t, label in zip(b.column(0), b.column(1), b.column(2)):
                words = set(WORD.findall((t.as_py() or "").lower()))
                out.append((i.as_py(), label.as_py(), sorted({columns[f] for w in words for f in features(w) if f in columns})))
            cols = list(zip(*out)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.list_(pa.int32()))],
                                             ["doc_id", "label", "columns"])

    rows = sample.select("doc_id", "text", "label").mapInArrow(tidy(run), "doc_id long, label int, columns array<int>")
    return sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[0], r[2]))


def counted(sample: DataFrame, found: set[int]) -> dict[int, int]:
    """doc_id -> distinct words that carry a feature of ``found``, the most over its
    texts."""
    def run(batches):
        for b in batches:
            n = [sum(not found.isdisjoint(features(w)) for w in set(WORD.findall((t.as_py() or "").lower()))) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["doc_id", "n"])

    out: dict[int, int] = {}
    for i, n in sample.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, n long").collect():
        out[i] = max(n, out.get(i, 0))
    return out


def graded(sample: DataFrame) -> dict[int, int]:
    """Grades 1 to ``LEVELS`` of the sample's toxic documents: thirds of their
    number of words that are telling in the half that they are not in."""
    grades: dict[int, int] = {}
    for half in (0, 1):
        other = set(telling(sample.filter(F.col("half") != half), FEATURES))
        words = counted(sample.filter((F.col("half") == half) & (F.col("label") > 0)), other)
        ranked = sorted(words.values())
        cuts = [ranked[len(ranked) * k // LEVELS] for k in range(1, LEVELS)] if ranked else []
        grades |= {i: 1 + sum(n >= c for c in cuts) for i, n in words.items()}
    return grades


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, binary: bool = True) -> Model:
    """Fit on ``labels`` (doc_id, label).  ``binary``: labels are 0 or 1 and get
    grades from ``graded``; otherwise they are the grades."""
    sample = materialise(sampled(docs, labels, limit), "toxicity-sample")
    columns = {f: k for k, f in enumerate(telling(sample, FEATURES))}
    if not columns:
        return Model()
    found = columns_of(sample, columns)
    grade = graded(sample) if binary else {}
    rows = [(c, grade.get(i, 1) if binary and label > 0 else max(0, label)) for i, label, c in found]
    return Model(columns, *fit(rows, len(columns), max(g for _, g in rows) + 1))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, expected_severity, grade, p_toxic, toxic) of every row."""
    rows = narrow(docs, {id_col: "long", text_col: "string"}).mapInArrow(
        tidy(scorer(model, 1, [0])), "doc_id long, expected_severity double, grade int, p_toxic double")
    return rows.withColumn("toxic", F.col("p_toxic") >= 0.5)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the model finds toxic, all columns kept."""
    at = docs.columns.index(text_col)

    def run(batches):
        work = scorer(model, at, [])
        for b in batches:
            (s,) = work([b])
            yield b.filter(pa.array(s.column(2).to_numpy() < 0.5))

    return docs.mapInArrow(tidy(run), docs.schema)


def scorer(model: Model, text_at: int, keep: list[int]):
    """Function from batches to batches: columns ``keep`` and the three scores."""
    def run(batches):
        columns, weights = model.columns, model.weights
        memo: dict[str, tuple[int, ...]] = {}
        for b in batches:
            x = np.zeros(b.num_rows)
            for k, t in enumerate(b.column(text_at)):
                own: set[int] = set()
                for w in set(WORD.findall((t.as_py() or "").lower())):
                    cols = memo.get(w)
                    if cols is None:
                        cols = tuple(columns[f] for f in features(w) if f in columns)
                        if len(memo) >= MEMO:
                            memo.clear()
                        memo[w] = cols
                    if cols:
                        own.update(cols)
                x[k] = weights[sorted(own)].sum() if own else 0.0
            p = model.probabilities(x)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array(p @ np.arange(p.shape[1])), pa.array(p.argmax(axis=1).astype("i4")), pa.array(1 - p[:, 0])],
                [*[b.schema.names[c] for c in keep], "expected_severity", "grade", "p_toxic"])
    return run
