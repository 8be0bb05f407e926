"""Substring dedup by sliding sentence spans (operator 10).

A text is cut into sentences (after . ! ? and white space, and at line breaks).
From every sentence a span runs over as many consecutive sentences as it takes
to reach ``LEAST_WORDS`` words, and to every sentence one runs backwards
likewise, so that a passage of that size is covered whole wherever it stands.
Beside them stand the spans that likewise reach two sentences with words and
``FLOOR_WORDS`` words: every run of several sentences over that floor, which only
keeps stock phrases out, is covered by such spans that lie inside it.
The hashes of all spans are joined over the whole corpus; of equal spans the
first (by doc_id, then place) stays, and every sentence that another one covers
is removed.  Spans of one text may repeat as well.

Hashes are 64 bits over normalised words (lower case, without punctuation).
A span shared by very many documents is reduced to one row per task before the
shuffle that finds its first place; the join back to the spans is a plain one
that Spark may split for skew, with broadcast only below its own size limit.
Texts are shuffled once, to meet the numbers of their removed sentences.

A null text stays null with no sentences; a null doc_id comes last.  Rows with
the same doc_id and text are one document given twice: both get what it gets.
All other columns are kept by ``dedup``.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .common import fresh, materialise, tidy

LEAST_WORDS = 25
#: Runs of two or more sentences need only these.
FLOOR_WORDS = 8
END = re.compile(r"(?<=[.!?])\s+|\n+")
WORD = re.compile(r"\w+")


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence with the white space that follows it; they
    lie side by side from 0 to the text's end."""
    cuts = [m.end() for m in END.finditer(text)]
    edges = [0, *(c for c in cuts if 0 < c < len(text)), len(text)]
    return list(zip(edges, edges[1:])) if text else []


def runs(text: str, least: int, floor: int = FLOOR_WORDS) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(hash, first sentence, last sentence) of each distinct span at its first
    place, and (first, last) of those that repeat one of this text."""
    words = [WORD.findall(text[a:b].lower()) for a, b in sentences(text)]
    size = [len(w) for w in words]
    joined = [" ".join(w) for w in words]
    full = [k for k, n in enumerate(size) if n]  # a sentence without words begins and ends no span
    found = set()
    for several, need in ((1, least), (2, floor)):
        end = held = 0
        for a in range(len(full)):  # the span that begins here: its end never moves back
            while end < len(full) and (held < need or end - a < several):
                held += size[full[end]]
                end += 1
            if held < need or end - a < several:
                break
            found.add((full[a], full[end - 1]))
            held -= size[full[a]]
        start, held = len(full) - 1, 0
        for b in range(len(full) - 1, -1, -1):  # the span that ends here
            while start >= 0 and (held < need or b - start < several):
                held += size[full[start]]
                start -= 1
            if held < need or b - start < several:
                break
            found.add((full[start + 1], full[b]))
            held -= size[full[b]]
    once: dict[int, tuple[int, int]] = {}
    again = []
    for a, b in sorted(found):
        key = xxhash.xxh3_64_intdigest(" ".join(filter(None, joined[a:b + 1]))) - (1 << 63)
        if once.setdefault(key, (a, b)) != (a, b):
            again.append((a, b))
    return [(k, a, b) for k, (a, b) in once.items()], again


def spans(docs: DataFrame, least: int, floor: int) -> DataFrame:
    """(doc_id, tag, key, at) of every span of the texts; ``at`` packs its first
    and last sentence, ``key`` is null where the span repeats one of its text."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):  # a few texts at a time: spans are many
                part = b.slice(lo, 256)
                ids, tags, keys, at = [], [], [], []
                for i, g, t in zip(*[c.to_pylist() for c in part.columns]):
                    once, again = runs(t or "", least, floor)
                    ids += [i] * (len(once) + len(again))
                    tags += [g] * (len(once) + len(again))
                    keys += [k for k, _, _ in once] + [None] * len(again)
                    at += [a << 32 | e for _, a, e in once] + [a << 32 | e for a, e in again]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids, tags, keys, at)], ["doc_id", "tag", "key", "at"])

    return docs.mapInArrow(tidy(run), "doc_id long, tag long, key long, at long")


def repeated(docs: DataFrame, least: int, floor: int) -> DataFrame:
    """(g_id, g_tag, removed): the numbers of the sentences of each document
    (doc_id, text) that spans other than the first cover."""
    all_ = materialise(spans(docs.select("doc_id", F.xxhash64("text").alias("tag"), "text"), least, floor), "spans-all")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")
    first = all_.filter("key is not null").groupBy("key").agg(F.min(place).alias("p"), F.count("*").alias("n")).filter("n > 1").select(
        "key", F.col("p.doc_id").alias("first_id"), F.col("p.tag").alias("first_tag"))
    later = all_.join(first, "key").filter(~(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("tag") == F.col("first_tag"))))
    gone = later.select("doc_id", "tag", "at").unionByName(all_.filter("key is null").select("doc_id", "tag", "at"))
    numbers = F.sequence(F.shiftright("at", 32).cast("int"), F.col("at").bitwiseAND(0xFFFFFFFF).cast("int"))
    return gone.select("doc_id", "tag", F.explode(numbers).alias("s")).groupBy(F.col("doc_id").alias("g_id"), F.col("tag").alias("g_tag")).agg(
        F.sort_array(F.collect_set("s")).alias("removed"))


def dedup(docs: DataFrame, least: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text", floor: int = FLOOR_WORDS) -> DataFrame:
    """``docs`` with repeated sentences removed from the text, and n_sentences,
    n_removed and removed (the sentences' numbers), which replace columns of
    these names."""
    docs = docs.drop("removed", "n_sentences", "n_removed")
    id_, tag = fresh(docs, "__id"), fresh(docs, "__tag")
    docs = docs.withColumn(text_col, docs[text_col].cast("string"))
    gone = repeated(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), least, floor).withColumnsRenamed({"g_id": id_, "g_tag": tag})
    same = docs[id_col].cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64(docs[text_col]) == F.col(tag))
    joined = docs.join(gone, same, "left").drop(id_, tag).withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))

    def run(batches):
        for b in batches:
            at = {n: k for k, n in enumerate(b.schema.names)}
            texts, counts = [], []
            for t, g in zip(b.column(at[text_col]), b.column(at["removed"])):
                t, out = t.as_py(), set(g.as_py())
                cut = sentences(t or "")
                texts.append("".join(t[a:e] for k, (a, e) in enumerate(cut) if k not in out) if out else t)
                counts.append(len(cut))
            cols = [pa.array(texts, pa.string()) if n == text_col else b.column(k) for n, k in at.items()]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64())], [*at, "n_sentences"])

    schema = StructType([*joined.schema.fields]).add("n_sentences", LongType())
    return joined.mapInArrow(tidy(run), schema).withColumn("n_removed", F.size("removed").cast("long"))
