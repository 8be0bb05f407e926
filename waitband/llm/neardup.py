"""Near-duplicates by BagMinHash (operator 5).

A text is the multiset of its runs of five words (lower case, punctuation
dropped; a text of fewer words, but some, is one run).  Two texts are linked if
the weighted Jaccard similarity of their multisets is 0.8 or more; a class is a
connected component of links.

1. One pass over the documents gives the content's hash, the BagMinHash
   signature cut into bands, and the multiset as sorted 32-bit hashes.
2. Equal contents become one node, so copies are never compared.
3. Bands are counted per value; values that only one node has go.  Each node is
   paired with the first and the last node of its buckets, not with everyone:
   the pair that most bands propose is verified first, on the multisets.
4. Components of the verified links are contracted.  Buckets that still hold
   several components are taken up again so that no link the bands propose is
   lost: in those of at most ``SMALL`` nodes every pair across components is
   verified; the nodes of larger ones (texts that share one passage, say) meet by
   an exact prefix filter instead.  Two texts that are similar enough must share
   one of the rarest runs that make up a fifth of either, and what follows that
   run must be large enough in both, so texts that share just the common part
   are never paired.

With 32 bands of 6 values a pair at similarity 0.8 shares a band with
probability 0.99994, one at 0.85 with 0.9999997.

Null texts and texts without a word have no runs; each is a class by itself.
Repeated rows have equal content.  The class id is the least doc_id in it (null
if there is none).  Other columns are ignored by ``classes`` and kept by
``keep_first``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_batches
from .bagminhash import GOLD, mixed, signatures
from .common import fresh, materialise, tidy
from .graph import components

RUN = 5
SIMILAR = 0.8
BANDS, BAND_ROWS = 32, 6
#: Nodes of a bucket up to which its pairs across components are verified directly.
SMALL = 16
#: Elements whose signatures are worked out together, and documents cut into runs together.
BLOCK, ROWS = 50_000, 256
WORD = re.compile(r"\w+")
SCHEMA = "row long, doc_id long, tag long, hi long, lo long, bands array<long>, bag binary"


def shingles(text: str) -> np.ndarray:
    """64-bit hashes of the runs of words, in order, with repeats."""
    words = WORD.findall(text.lower())
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(RUN, n)
    with np.errstate(over="ignore"):
        run = np.full(n - k + 1, k, np.uint64)
        for i in range(k):
            run = mixed(run * GOLD + h[i:n - k + 1 + i])
    return run


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted arrays with repeats."""
    if not len(a) or not len(b):
        return 0.0
    (va, ca), (vb, cb) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[ia], cb[ib]).sum())
    return both / (len(a) + len(b) - both)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(docs, BANDS) 64-bit keys; a band's number is part of its key."""
    bits = np.ascontiguousarray(sig).view(np.uint64).reshape(len(sig), BANDS, BAND_ROWS)
    with np.errstate(over="ignore"):
        key = mixed(np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * GOLD, bits.shape[:2]).copy())
        for r in range(BAND_ROWS):
            key = mixed(key * GOLD + bits[:, :, r])
    return key.view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """SCHEMA rows of (row, doc_id, tag, text)."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                texts = part.column(3).to_pylist()
                runs = [shingles(t or "") for t in texts]
                digests = [xxhash.xxh3_128_digest(r.tobytes()) for r in runs]
                hi, lo_ = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2).T
                bands: list = [[] for _ in runs]
                # small texts together: the rounds of a block end with its slowest text
                todo = sorted((k for k in range(len(runs)) if len(runs[k])), key=lambda k: len(runs[k]))
                at = 0
                while at < len(todo):
                    end, held = at, 0
                    while end < len(todo) and (end == at or held + len(runs[todo[end]]) <= BLOCK):
                        held += len(runs[todo[end]])
                        end += 1
                    bags = [np.unique(runs[k], return_counts=True) for k in todo[at:end]]
                    which = np.repeat(np.arange(len(bags)), [len(v) for v, _ in bags])
                    sig = signatures(which, np.concatenate([v for v, _ in bags]), np.concatenate([c for _, c in bags]), len(bags), BANDS * BAND_ROWS)
                    for k, keys in zip(todo[at:end], band_keys(sig)):
                        bands[k] = keys
                    at = end
                bag = [np.sort((r >> np.uint64(32)).astype(np.uint32)).tobytes() for r in runs]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(hi), pa.array(lo_),
                                                  pa.array(bands, pa.list_(pa.int64())), pa.array(bag, pa.binary())], names)

    return docs.mapInArrow(tidy(run), SCHEMA)


def verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """(a, b, linked) of the pairs (a, b), by their multisets."""
    def run(batches):
        for b in batches:
            same = [overlap(np.frombuffer(x.as_py(), np.uint32), np.frombuffer(y.as_py(), np.uint32)) >= SIMILAR for x, y in zip(b.column(2), b.column(3))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(same, pa.bool_())], ["a", "b", "linked"])

    n = F.octet_length
    one = bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a"))
    two = bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "bag_a", "bag_b")
    # sizes alone bound the similarity
    close = F.least(n("bag_a"), n("bag_b")) >= F.greatest(n("bag_a"), n("bag_b")) * F.lit(SIMILAR - 1e-9)
    return both.filter(close).mapInArrow(tidy(run), "a long, b long, linked boolean")


def links(rows: DataFrame) -> DataFrame:
    """(node, comp) of the nodes of ``rows`` (node, bands, bag) that are linked
    to another."""
    members = rows.select("node", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first <> last")
    members = materialise(members.join(shared, "key"), "neardup-members")
    bags = rows.select("node", "bag")

    # each node with the ends of its buckets, the ends that most of its bands name first
    ends = members.select("node", F.explode(F.array("first", "last")).alias("end")).filter("node <> end").groupBy("node", "end").agg(F.count("*").alias("n"))
    best = ends.groupBy("node").agg(F.max(F.struct("n", (-F.col("end")).alias("end"))).alias("m")).select("node", (-F.col("m.end")).alias("end"))
    pair = lambda df: df.select(F.least("node", "end").alias("a"), F.greatest("node", "end").alias("b")).distinct()
    tried = materialise(verified(pair(best), bags), "neardup-tried")
    accepted = tried.filter("linked").select("a", "b")
    comps = components(accepted)

    rest = across(pair(ends), comps).join(tried, ["a", "b"], "left_anti")
    tried = tried.unionByName(materialise(verified(rest, bags), "neardup-tried"))
    accepted = tried.filter("linked").select("a", "b")
    comps = components(accepted)

    # what is left: buckets of several components
    own = members.select("key", "node").join(comps, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    split = own.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).filter("lo <> hi")
    own = materialise(own.join(split.select("key", "n"), "key"), "neardup-split")
    few = own.filter(F.col("n") <= SMALL)
    left = few.select("key", F.col("node").alias("a"), F.col("comp").alias("ca")).join(
        few.select("key", F.col("node").alias("b"), F.col("comp").alias("cb")), "key").filter("a < b and ca <> cb").select("a", "b")
    many = own.filter(F.col("n") > SMALL).select("node", "comp").distinct().join(bags, "node")
    left = left.unionByName(prefix_pairs(many)).distinct().join(tried, ["a", "b"], "left_anti")
    more = materialise(verified(left, bags), "neardup-tried").filter("linked").select("a", "b")
    return components(accepted.unionByName(more)) if not more.isEmpty() else comps


def prefix_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, comp, bag) of different components that
    may be similar enough: exact, by the prefix and position filters of
    similarity joins.

    Runs are ordered from rare to common.  If the runs that stand first in a and
    make up more than a fifth of it have none in common with those of b, the
    overlap is under four fifths of one of them.  At the first common run the
    overlap is at most what is left of either from there on."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                node, size, token, weight = [], [], [], []
                for n, bag in zip(part.column(0), part.column(2)):
                    v, c = np.unique(np.frombuffer(bag.as_py(), np.uint32), return_counts=True)
                    node.append(np.full(len(v), n.as_py(), np.int64))
                    size.append(np.full(len(v), c.sum(), np.int64))
                    token.append(v.astype(np.int64))
                    weight.append(c.astype(np.int64))
                cols = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (node, size, token, weight)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["node", "size", "token", "weight"])

    tokens = materialise(nodes.select("node", "comp", "bag").mapInArrow(tidy(run), "node long, size long, token long, weight long"), "neardup-tokens")
    seen = tokens.groupBy("token").agg(F.count("*").alias("seen"))
    # a node's runs in one row: an array as long as its text
    ranked = tokens.join(seen, "token").groupBy("node", "size").agg(F.collect_list(F.struct("seen", "token", "weight")).alias("runs"))

    def cut(batches):
        """The runs that others have too among the rarest that make up a fifth, with what stands before each."""
        for b in batches:
            out = [[], [], [], []]
            for n, size, runs in zip(b.column(0), b.column(1), b.column(2)):
                own, token, weight = (runs.values.field(k).to_numpy() for k in range(3))
                order = np.lexsort((token, own))
                own, token, weight = own[order], token[order], weight[order]
                at = np.cumsum(weight) - weight
                keep = (at * 5 <= size.as_py()) & (own > 1)
                for c, v in zip(out, (np.full(keep.sum(), n.as_py()), np.full(keep.sum(), size.as_py()), token[keep], at[keep])):
                    c.append(v)
            cols = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in out]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["node", "size", "token", "at"])

    prefix = ranked.mapInArrow(tidy(cut), "node long, size long, token long, at long")
    prefix = materialise(prefix.join(nodes.select("node", "comp"), "node"), "neardup-prefix")
    one = prefix.select("token", *[F.col(c).alias(f"{c}_a") for c in ("node", "comp", "size", "at")])
    two = prefix.select("token", *[F.col(c).alias(f"{c}_b") for c in ("node", "comp", "size", "at")])
    room = F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b"))
    # overlap / (a + b - overlap) >= 4/5, in whole numbers
    close = (one["token"] == two["token"]) & (F.col("node_a") < F.col("node_b")) & (F.col("comp_a") != F.col("comp_b")) & (
        room * 9 >= (F.col("size_a") + F.col("size_b")) * 4) & (F.least("size_a", "size_b") * 5 >= F.greatest("size_a", "size_b") * 4)
    return one.join(two, close).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def across(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different components."""
    a = comps.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    b = comps.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    return pairs.join(a, "a", "left").join(b, "b", "left").filter(~F.coalesce(F.col("ca") == F.col("cb"), F.lit(False))).select("a", "b")


def classified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, tag, class): one row per document."""
    text = docs[text_col].cast("string")
    with small_batches(docs.sparkSession):
        rows = materialise(signed(docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("doc_id"),
                                              F.xxhash64(text).alias("tag"), text.alias("text"))), "neardup-rows")
        some = F.size("bands") > 0
        nodes = materialise(rows.filter(some).groupBy("hi", "lo").agg(F.min("row").alias("node")), "neardup-nodes")
        comps = links(rows.join(nodes.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("node"), "bands", "bag"))
    named = nodes.join(comps, "node", "left").select(F.col("hi").alias("h"), F.col("lo").alias("l"), F.coalesce("comp", "node").alias("comp"))
    narrow = rows.select("row", "doc_id", "tag", "hi", "lo", some.alias("some"))
    return narrow.join(named, F.col("some") & (F.col("hi") == F.col("h")) & (F.col("lo") == F.col("l")), "left").select(
        "row", "doc_id", "tag", F.coalesce("comp", "row").alias("class"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, first): one row per document; the class id is the
    least doc_id of its class, ``first`` marks the one row of it that stays."""
    rows = materialise(classified(docs, id_col, text_col), "neardup-classes")
    least = rows.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    # of the rows with that id one is kept: the least row number
    keep = rows.join(least, "class").filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class").agg(F.min("row").alias("kept"))
    return rows.join(least, "class").join(keep, "class").select("doc_id", "class_id", (F.col("row") == F.col("kept")).alias("first"), "tag")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, all columns kept."""
    on = [fresh(docs, n) for n in ("__id", "__none", "__tag")]

    def marks(i: Column, tag: Column) -> list[Column]:
        return [c.alias(n) for c, n in zip((F.coalesce(i, F.lit(0)), i.isNull(), tag), on)]

    kept = classes(docs, id_col, text_col).filter("first").select(*marks(F.col("doc_id"), F.col("tag")))
    marked = docs.select(*docs.columns, *marks(docs[id_col].cast("long"), F.xxhash64(docs[text_col].cast("string"))))
    # a row given twice has both its copies here: the last step drops one
    return marked.join(kept, on, "left_semi").dropDuplicates(on).select(*docs.columns)
