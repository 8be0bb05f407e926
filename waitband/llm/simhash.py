"""SimHash near-duplicates by an index of positional bytes (operator 12).

A text is the sequence of its shingles of four words (ASCII letters in lower
case, repeats included; a text of fewer words, but some, is one shingle).  Bit
by bit, the 64-bit fingerprint says whether over half the shingles' hashes have
that bit set.  Two fingerprints are linked if at most ``DIFFER`` bits differ; a
component is what links connect.

A fingerprint is eight bytes at fixed positions.  Four differing bits touch at
most four of them, so a linked pair agrees in at least four positional bytes:
the guaranteed minimum of the count filter.  Lists of single positional bytes
hold a 256th of all fingerprints each, and tallies over them would be pairs by
the square of the corpus.  The index therefore keeps the lists of all *sets of
four* positional bytes (70 a fingerprint): two fingerprints meet in a list
exactly if their tally of shared positional bytes is four or more, and a list
holds one in 2^32 by chance.

1. Equal fingerprints become one node, so copies are never compared.
2. Lists with one node go.  Each node is verified against the ends of its lists,
   and what is linked is contracted.
3. Lists that still hold several components are taken up again, so that no link
   is lost: in those of up to ``SMALL`` nodes the pairs across components are
   verified.  Pairs in longer lists (a cloud of near copies) would grow with the
   square of the list; there every node names all fingerprints within
   ``DIFFER / 2`` bits of it, and nodes that name the same one are linked: two
   fingerprints differ in at most ``DIFFER`` bits exactly if one lies half-way.

Null texts and texts without words have fingerprint zero, which links like any
other.  Repeated rows give a row each.  The component id is the least doc_id of
the component; rows with a null doc_id belong to components but do not name
them (null if no row has an id).  Columns beside the id and the text are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, narrow, tidy
from .graph import components

WORDS = 4
SEED = 42
#: Bits in which linked fingerprints may differ; even.
DIFFER = 4
BYTES = 8
#: Positional bytes that a linked pair shares at least.
LEAST = BYTES - DIFFER
#: Nodes of a list up to which its pairs are verified one by one: all 70 lists of
#: a node then cost about as much as the 2,081 fingerprints around it.
SMALL = 128
#: Shingles whose bits are counted together.
BLOCK = 1 << 16


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of a text."""
    words = (text or "").encode("utf-8").lower().split()
    n = len(words)
    if not n:
        return 0
    digest = xxhash.xxh64_intdigest
    line = b" ".join(words)
    if n <= WORDS:
        return digest(line, SEED)  # of one shingle's bits, those that are set
    end = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    del words
    start = np.concatenate([[0], end[:-WORDS]])
    stop = end[WORDS - 1:] - 1
    total, ones = len(start), np.zeros(64, np.int64)
    for lo in range(0, total, BLOCK):
        spans = zip(start[lo:lo + BLOCK].tolist(), stop[lo:lo + BLOCK].tolist())
        h = np.fromiter([digest(line[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): a row per document; fp holds the 64 bits as a long."""
    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py()) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return narrow(docs, {id_col: "long", text_col: "string"}).mapInArrow(tidy(run), "doc_id long, fp long")


def lists() -> Column:
    """The 70 lists of ``fp``: which positions, and the bytes there."""
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)) for p in range(BYTES)]
    out = []
    for k, at in enumerate(combinations(range(BYTES), LEAST)):
        key = F.lit(k).cast("long")
        for p in at:
            key = F.shiftleft(key, 8).bitwiseOR(byte[p])
        out.append(key)
    return F.array(*out)


def apart(a: str, b: str) -> Column:
    """Bits in which two fingerprints differ."""
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def around(fp: Column) -> Column:
    """All fingerprints within ``DIFFER / 2`` (two) bits of ``fp``."""
    flips = [0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i, j in combinations(range(64), DIFFER // 2)]
    signed = np.array(flips, np.uint64).view(np.int64).tolist()
    return F.transform(F.lit(signed).cast("array<long>"), lambda m: fp.bitwiseXOR(m))


def links(nodes: DataFrame, small: int = SMALL) -> DataFrame:
    """(node, comp) of the distinct fingerprints ``nodes`` (fp) that are linked
    to another; comp is the component's least fingerprint as a long."""
    posted = nodes.select("fp", F.explode(lists()).alias("list")).repartition("list")
    size = posted.groupBy("list").agg(F.count("*").alias("n"), F.min("fp").alias("first"), F.max("fp").alias("last")).filter("n > 1")
    shared = materialise(posted.join(size, "list"), "simhash-lists")

    near = shared.select("fp", F.explode(F.array("first", "last")).alias("end")).filter("fp <> end").filter(apart("fp", "end") <= DIFFER)
    accepted = materialise(near.select(F.least("fp", "end").alias("a"), F.greatest("fp", "end").alias("b")).distinct(), "simhash-links")
    comps = components(accepted)

    own = shared.select("list", "n", "fp").join(comps.withColumnRenamed("node", "fp"), "fp", "left").select(
        "list", "n", "fp", F.coalesce("comp", "fp").alias("comp"))
    split = own.groupBy("list").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("list")
    own = materialise(own.join(split, "list"), "simhash-split")
    few = own.filter(F.col("n") <= small)
    one = few.select("list", F.col("fp").alias("a"), F.col("comp").alias("ca"))
    two = few.select(F.col("list").alias("other"), F.col("fp").alias("b"), F.col("comp").alias("cb"))
    found = one.join(two, (F.col("list") == F.col("other")) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & (apart("a", "b") <= DIFFER))
    found = found.select("a", "b")

    cloud = own.filter(F.col("n") > small).select("fp").distinct()
    named = cloud.select("fp", F.explode(around(F.col("fp"))).alias("middle"))
    first = named.groupBy("middle").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a <> b")
    # a name that more than two give links them all to the first
    met = named.join(first, "middle").select("a", F.col("fp").alias("b")).filter("a <> b")
    more = materialise(found.unionByName(met).distinct(), "simhash-links")
    return components(accepted.unionByName(more)) if not more.isEmpty() else comps


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL) -> DataFrame:
    """(doc_id, fingerprint, component_id): a row per document; the fingerprint
    is 16 lowercase hex digits."""
    rows = materialise(fingerprints(docs, id_col, text_col), "simhash-rows")
    nodes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    linked = nodes.join(links(nodes.select("fp"), small).withColumnRenamed("node", "fp"), "fp")
    least = linked.groupBy("comp").agg(F.min("least").alias("component_id"))
    linked = linked.join(least, "comp").select("fp", "component_id", F.lit(True).alias("linked"))
    named = nodes.join(linked, "fp", "left").select(
        "fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
