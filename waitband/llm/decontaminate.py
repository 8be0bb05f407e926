"""Benchmark decontamination by winnowing (operator 6), DataFrame functions only.

A text's words are hashed, every run of ``GRAM`` words gets a hash, and of the
hashes in each window of ``SPAN - GRAM + 1`` neighbouring runs the least is
kept.  A stretch of ``SPAN`` words that a document shares with an item shows
both sides the same window, so both keep the same hash: joining the kept hashes
of documents and items misses no shared stretch.  Every joined hit is then
extended: the ``SPAN`` words around it are laid over the item's in each of the
possible alignments, and only stretches whose words are all equal count, so
hash collisions add nothing.

An item of fewer words (but some) is one stretch by itself; for each such
length (at most ``SPAN - 1`` of them) all runs of that length are hashed.

Scale: the item side is broadcast only when its hashes number at most
``BROADCAST_KEYS`` (a row is under 40 bytes); beyond that the joins shuffle and
Spark may split their skewed keys.  Texts are shuffled at most once, by doc_id,
to meet their hits; a hash that a third of all documents hold adds one narrow
row for each of them.

Null texts have no words.  Rows with equal doc_id and text get equal results,
each its own row; an item_id that stands in several rows counts once; a null
item_id marks words as hit but is not listed.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, materialise, narrow

#: Fixed value: what stands between the words of lower-cased text, ASCII that is neither digit nor a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 10
GRAM = 6
BROADCAST_KEYS = 200_000


def words_of(text: Column) -> Column:
    """Words of ``text``, A-Z lower-cased and nothing else."""
    t = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(
        F.translate(t, string.ascii_uppercase, string.ascii_lowercase))
    # splitting costs a tenth of extracting; an edge that is no word leaves an empty string
    return F.array_remove(F.split(low, BETWEEN), "")


def neighbours(xs: Column, shift: int, join) -> Column:
    """``join`` of every element with the one ``shift`` after it."""
    def both(a: Column) -> Column:
        n = F.greatest(F.size(a) - shift, F.lit(0))
        return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(shift + 1), n), join)

    return let(xs, both)


def grams(hashes: Column, k: int) -> Column:
    """Hash of every run of ``k`` words, doubled up from the hashes of shorter runs."""
    def of(h: Column, n: int) -> Column:
        if n == 1:
            return F.transform(h, lambda x: F.xxhash64(F.lit(k), x))
        half = n - n // 2
        return neighbours(of(h, half), n - half, lambda a, b: F.xxhash64(F.lit(n), a, b))

    return let(hashes, lambda h: of(h, k))


def kept(runs: Column) -> Column:
    """Winnowing: the least hash of each window of neighbouring runs."""
    w, width, low = SPAN - GRAM + 1, 1, runs
    while width < w:
        step = min(width, w - width)
        low = neighbours(low, step, lambda a, b: F.least(a, b))
        width += step
    return low


def hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def short_lengths(items: DataFrame) -> list[int]:
    """Lengths under SPAN that items have; at most SPAN - 1 numbers."""
    n = F.size(words_of(F.col("text")))
    return sorted(r[0] for r in items.select(n.alias("n")).filter((F.col("n") > 0) & (F.col("n") < SPAN)).distinct().collect())


def item_keys(items: DataFrame, lengths: list[int]) -> DataFrame:
    """(key, len, item_id, at, size, from, around): every kept hash of every item
    with its places, the item's number of words and those around the place from
    ``from`` on, so that a row stays small however long the item; a short item is
    one key."""
    rows = items.select("item_id", words_of(F.col("text")).alias("words")).withColumn("h", hashed(F.col("words")))
    runs = rows.filter(F.size("words") >= SPAN).withColumn("runs", grams(F.col("h"), GRAM))
    runs = runs.withColumn("keep", kept(F.col("runs")))
    places = F.transform(F.col("runs"), lambda g, i: F.struct(g.alias("key"), i.alias("at")))
    lead = lambda p: F.greatest(p["at"] - (SPAN - GRAM), F.lit(0))
    near = F.transform(F.filter(places, lambda p: F.array_contains("keep", p["key"])), lambda p: F.struct(
        p["key"].alias("key"), p["at"].alias("at"), lead(p).alias("from"), F.slice(F.col("words"), lead(p) + 1, F.lit(SPAN + (SPAN - GRAM))).alias("around")))
    long = runs.select("item_id", F.size("words").alias("size"), F.explode(near).alias("p")).select(
        F.col("p.key").alias("key"), F.lit(SPAN).alias("len"), "item_id", F.col("p.at").alias("at"), "size", F.col("p.from").alias("from"), F.col("p.around").alias("around"))
    for k in lengths:
        one = rows.filter(F.size("words") == k).select(
            F.element_at(grams(F.col("h"), k), 1).alias("key"), F.lit(k).alias("len"), "item_id", F.lit(0).alias("at"), F.lit(k).alias("size"), F.lit(0).alias("from"), F.col("words").alias("around"))
        long = long.unionByName(one)
    return long


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) as (doc_id, tag, n_words, cover): cover
    lists (start, end, item_id) of all stretches shared with an item, in words."""
    lengths = short_lengths(items)
    keys = materialise(item_keys(items, lengths), "decontaminate-items")
    small = keys.count() <= BROADCAST_KEYS
    fit = F.broadcast if small else (lambda df: df)

    def all_keys(h: Column) -> Column:
        return F.array_distinct(F.concat(kept(grams(h, GRAM)), *[grams(h, k) for k in lengths]))

    # a row's identity is its doc_id and text: rows equal in both have equal results
    words = docs.select("doc_id", F.xxhash64("text").alias("tag"), words_of(F.col("text")).alias("words"))
    words = words.withColumn("h", hashed(F.col("words"))).withColumn("keys", all_keys(F.col("h")))
    rows = materialise(words.select("doc_id", "tag", F.size("words").cast("long").alias("n_words"), "keys"), "decontaminate-keys")
    hits = rows.select("doc_id", F.explode("keys").alias("key")).join(fit(keys.select("key").distinct()), "key", "left_semi")
    hits = materialise(hits.groupBy(F.col("doc_id").alias("hit_id")).agg(F.collect_set("key").alias("seen")), "decontaminate-hits")

    full = docs.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id"))).select(
        "doc_id", F.xxhash64("text").alias("tag"), "seen", words_of(F.col("text")).alias("words")).distinct()
    full = full.withColumn("h", hashed(F.col("words")))
    back = SPAN - GRAM

    def places(k: int, length: int) -> Column:
        """Runs of ``k`` words that have a hit, with the words around them."""
        at = F.transform(grams(F.col("h"), k), lambda g, i: F.struct(g.alias("key"), F.lit(length).alias("len"), i.alias("at")))
        near = F.filter(at, lambda p: F.array_contains("seen", p["key"]))
        lead = back if length == SPAN else 0
        return F.transform(near, lambda p: F.struct(
            p["key"].alias("key"), p["len"].alias("len"), p["at"].alias("at"), F.greatest(p["at"] - lead, F.lit(0)).alias("from"),
            F.slice(F.col("words"), F.greatest(p["at"] - lead, F.lit(0)) + 1, F.lit(length + lead)).alias("around")))

    found = F.concat(places(GRAM, SPAN), *[places(k, k) for k in lengths])
    hit = full.select("doc_id", "tag", F.size("words").alias("n"), F.explode(found).alias("p")).select("doc_id", "tag", "n", "p.*")
    side = keys.select("key", "len", "item_id", F.col("at").alias("item_at"), F.col("size").alias("item_size"),
                       F.col("from").alias("item_from"), F.col("around").alias("item_around"))
    both = hit.join(fit(side), ["key", "len"])
    # a stretch may begin up to `back` words before the hit: shift 0..back (short items: 0 alone)
    start = lambda s: F.col("at") - s
    shifts = F.sequence(F.lit(0), F.when(F.col("len") == SPAN, back).otherwise(0))
    equal = F.filter(shifts, lambda s: (start(s) >= 0) & (F.col("item_at") >= s) & (start(s) + F.col("len") <= F.col("n"))
                     & (F.col("item_at") - s + F.col("len") <= F.col("item_size"))
                     & (F.slice(F.col("around"), start(s) - F.col("from") + 1, F.col("len"))
                        == F.slice(F.col("item_around"), F.col("item_at") - s - F.col("item_from") + 1, F.col("len"))))
    cover = both.select("doc_id", "tag", "item_id", "len", F.explode(F.transform(equal, start)).alias("start")).groupBy("doc_id", "tag").agg(
        F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end"))).alias("cover"),
        F.collect_set(F.col("item_id").cast("string")).alias("items")).withColumnsRenamed({"doc_id": "c_id", "tag": "c_tag"})
    return rows.select("doc_id", "tag", "n_words").join(
        cover, F.col("doc_id").eqNullSafe(F.col("c_id")) & F.col("tag").eqNullSafe(F.col("c_tag")), "left").select(
        "doc_id", "tag", "n_words", F.sort_array("cover").alias("cover"), F.sort_array("items").alias("items"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: words, words hit, items found, verdict."""
    rows = overlaps(narrow(docs, {"doc_id": "long", "text": "string"}), narrow(items, {"item_id": "string", "text": "string"}))
    start = F.struct(F.lit(0).alias("until"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(F.col("cover"), start, lambda a, c: F.struct(
        F.greatest(a["until"], c["end"]).alias("until"),
        (a["n"] + F.greatest(c["end"] - F.greatest(a["until"], c["start"]), F.lit(0))).alias("n")), lambda a: a["n"])
    n_hit = F.coalesce(covered, F.lit(0).cast("long"))
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_).cast("long").alias("n_items"),
                       F.sha2(F.array_join(items_, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept."""
    rows = overlaps(narrow(docs, {"doc_id": "long", "text": "string"}), narrow(items, {"item_id": "string", "text": "string"}))
    id_, tag = fresh(docs, "__bad_id"), fresh(docs, "__bad_tag")
    bad = materialise(rows.filter(F.size("cover") > 0).select(F.col("doc_id").alias(id_), F.col("tag").alias(tag)).distinct(), "decontaminate-bad")
    if bad.count() <= BROADCAST_KEYS:
        bad = F.broadcast(bad)
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(F.col(id_)) & F.xxhash64(docs["text"].cast("string")).eqNullSafe(F.col(tag)), "left_anti")
