"""Quality rules with cross-document line frequency (operator 3).

Each document's lines are normalised (lower case, digits as 0, words joined by
one space, outer punctuation gone) and hashed together with the document's host;
the distinct documents of a host that hold a line are counted, a document being
a distinct text, so copies count once.  A line is removed where more than
``max(LEAST_DOCS, SHARE * documents of the host)`` hold it, and a document that
keeps less than ``LEFT`` of its words is rejected as depleted.

The base rules come first: too few words, or too many repeated three-word
windows.

One Python pass over Arrow batches gives each row its counts and its lines'
hashes; everything after it is narrow.  A line that a third of all documents
hold is counted in each task before the shuffle; the removed lines are broadcast
only if there are at most ``BROADCAST_KEYS`` of them, otherwise a join that
Spark may split for skew meets them.

Null text has no words; a null host is a host of its own.  Rows with equal
content give equal results.  Other columns are ignored by ``measure`` and kept
by ``clean``.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise, tidy

LEAST_WORDS = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
LEAST_DOCS = 10
SHARE = 0.02
LEFT = 0.3
BROADCAST_KEYS = 500_000

DIGITS = re.compile(r"\d")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
ROWS = ("row long, doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "text_key string, host string, keys array<long>, sizes array<int>")


def repeated(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(names) + ids[1:], return_inverse=True)[1].astype(np.int64)
    _, at, count = np.unique(pairs[:-1] * len(names) + ids[2:], return_inverse=True, return_counts=True)
    hot = count[at] > 1
    cover = np.zeros(n, bool)
    for k in range(3):
        cover[k:n - 2 + k] |= hot
    return int(cover.sum())


def normal(line: str) -> str:
    return EDGES.sub("", DIGITS.sub("0", " ".join(line.lower().split())))


def line_key(host: str | None, line: str) -> int:
    name = "" if host is None else "h" + host
    return xxhash.xxh3_64_intdigest(f"{name}\n{normal(line)}") - (1 << 63)


def measured(text: str | None, host: str | None) -> tuple:
    """The columns of ROWS from n_words on, for one text."""
    text = text or ""
    words = text.encode("utf-8").split()
    n = len(words)
    seen: set[str] = set()
    sizes: dict[int, int] = {}
    again = 0
    for line in text.split("\n"):
        k = len(line.encode("utf-8").split()) if line else 0
        if k:
            again += line in seen
            seen.add(line)
            key = line_key(host, line)
            sizes[key] = sizes.get(key, 0) + k
    rep = repeated(words)
    return (n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), again, rep, n < LEAST_WORDS or 100 * rep > 50 * n,
            xxhash.xxh3_128_hexdigest(text), host, list(sizes), list(sizes.values()))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Counts, verdict of the base rules and line hashes of every row."""
    types = [pa.int64(), pa.int64(), *[pa.int64()] * 5, pa.bool_(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = [f.split()[0] for f in ROWS.split(", ")]

    def run(batches):
        for b in batches:
            rows = [measured(t.as_py(), h.as_py()) for t, h in zip(b.column(2), b.column(3))]
            cols = list(zip(*rows)) if rows else [[]] * 10
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, t) for c, t in zip(cols, types[2:])]], names)

    return docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("doc_id"),
                       docs[text_col].cast("string").alias("text"), docs[host_col].cast("string").alias("host")).mapInArrow(tidy(run), ROWS)


def removed_lines(rows: DataFrame) -> DataFrame:
    """(key) of the lines that too many documents of their host hold."""
    first = rows.groupBy("host", "text_key").agg(F.min("row").alias("row"))
    docs = first.groupBy("host").agg(F.greatest(F.lit(LEAST_DOCS), F.floor(F.count("*") * F.lit(SHARE))).alias("most")).withColumnRenamed("host", "d_host")
    one = rows.join(first.select("row"), "row", "left_semi")
    held = one.select("host", F.explode("keys").alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")).filter(F.col("n") > LEAST_DOCS)
    return held.join(docs, F.col("host").eqNullSafe(F.col("d_host"))).filter(F.col("n") > F.col("most")).select("key")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: base counts, n_removed (words in removed lines),
    base_failed, kept."""
    rows = materialise(measure(docs, id_col, text_col, host_col), "lines-rows")
    gone = materialise(removed_lines(rows), "lines-removed")
    if gone.count() <= BROADCAST_KEYS:
        gone = F.broadcast(gone)
    lines = rows.select("row", F.explode(F.arrays_zip("keys", "sizes")).alias("l")).select("row", F.col("l.keys").alias("key"), F.col("l.sizes").alias("size"))
    lost = lines.join(gone, "key").groupBy("row").agg(F.sum("size").alias("n_removed"))
    left = F.col("n_words") - F.col("n_removed")
    return rows.drop("keys", "sizes", "text_key", "host").join(lost, "row", "left").withColumn(
        "n_removed", F.coalesce("n_removed", F.lit(0).cast("long"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (left >= F.col("n_words") * F.lit(LEFT))).alias("kept"), "n_removed")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``docs`` without the lines that too many documents of their host hold,
    all columns and rows kept."""
    gone = materialise(removed_lines(materialise(measure(docs, id_col, text_col, host_col), "lines-rows")), "lines-removed")
    if gone.count() <= BROADCAST_KEYS:
        gone = F.broadcast(gone)

    @F.pandas_udf("array<long>")
    def line_keys(host: pd.Series, text: pd.Series) -> pd.Series:
        def keys(h, t):
            return [line_key(h, line) if line.encode("utf-8").split() else None for line in (t or "").split("\n")]
        return pd.Series([keys(h, t) for h, t in zip(host, text)])

    row, lost = fresh(docs, "__row"), fresh(docs, "__gone")
    marked = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "lines-docs")
    held = marked.select(row, F.posexplode(line_keys(F.col(host_col).cast("string"), F.col(text_col).cast("string"))).alias("pos", "key"))
    hit = held.join(gone, "key").groupBy(row).agg(F.collect_set("pos").alias(lost))
    rest = F.array_join(F.filter(F.split(F.col(text_col), "\n"), lambda _, i: ~F.array_contains(lost, i)), "\n")
    return marked.join(hit, row, "left").withColumn(text_col, F.when(F.col(lost).isNull(), F.col(text_col)).otherwise(rest)).select(*docs.columns)
