"""WARC archives: writing, and reading by boundary-chain verification (operator 9).

Writing.  Each page is one record, its payload the html; of records with equal
payloads that with the largest page_id is the response and the others are
revisits without a body.  Archives are plain files of Spark's text writer, the
blank lines that end a record being its line separator, so they go through
Spark's commit protocol into any store it can write.

Reading.  The text reader cuts a file of any size, in parallel byte ranges, at
every occurrence of the version line.  Each piece is a *candidate* record: from
its header follows the offset of its successor.  A version line inside a
payload makes a candidate too, so candidates are not trusted: only those that
the chain of successors reaches from the start of the file are records.
Candidates that follow each other are first drawn together into runs; the runs'
pointers are then doubled until nothing new is reached.  Where payloads hold no
version line a file is one run and no doubling is needed.  The pieces of records
that do hold one are put together again for their digest.

A null html is an empty payload; all empty payloads are equal.  A null page_id
is written as an empty name and read back as null; if all ids of a payload are
null, its rows are all responses.  Repeated rows each make a record.  Line
breaks in a url are dropped.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, materialise

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: Fixed value: how a revisit says that its payload equals an earlier one.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed value: the RFC 4648 base32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Revisits up to which their table (under 100 bytes a row) is broadcast to the writers.
BROADCAST_ROWS = 200_000


def base32_sha1(data: Column) -> Column:
    """SHA-1 in base32: five hex digits are four characters."""
    def group(h: Column, g: int) -> Column:
        n = F.conv(F.substring(h, 5 * g + 1, 5), 16, 10).cast("int")
        return F.concat(*[F.substr(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)])

    return let(F.sha1(data), lambda h: F.concat(*[group(h, g) for g in range(8)]))


def write(pages: DataFrame, path: str, min_revisit: int = 0, taken_at: str = "1970-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write the pages' records below ``path``.  Payloads of fewer than
    ``min_revisit`` bytes are always responses.  ``taken_at`` is the records' date
    (the pages do not say when they were taken)."""
    payload = F.coalesce(pages[html_col].cast("string"), F.lit(""))
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), payload.alias("payload"))
    keyed = rows.select("page_id", base32_sha1(F.encode("payload", "UTF-8")).alias("digest"), F.octet_length("payload").alias("n"))
    # the ids of a payload meet as one row per task and digest; pages then find theirs by id, so a payload that many share is no hot key
    first = keyed.filter(F.col("n") >= min_revisit).groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("copies")).filter("copies > 1")
    moved = keyed.select("page_id", "digest").distinct().join(first, "digest").filter(
        F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))).select(
        F.col("page_id").alias("m_id"), F.col("digest").alias("m_digest"), "response")
    moved = materialise(moved, "warc-revisits")
    if moved.count() <= BROADCAST_ROWS:  # else the pages are shuffled by id to meet it
        moved = F.broadcast(moved)
    rows = rows.withColumn("digest", base32_sha1(F.encode("payload", "UTF-8")))
    rows = rows.join(moved, F.col("page_id").eqNullSafe(F.col("m_id")) & (F.col("digest") == F.col("m_digest")), "left")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    again = F.col("response").isNotNull()
    body = F.when(again, F.lit("")).otherwise(F.col("payload"))
    head = F.concat_ws("\r\n", F.concat(F.lit(VERSION + "WARC-Type: "), F.when(again, "revisit").otherwise("response")),
                       F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))),
                       F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\x00-\x1f]", "")),
                       F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
                       F.concat(F.lit("X-Payload-Length: "), F.octet_length("payload").cast("string")),
                       F.concat(F.lit("WARC-Date: "), F.lit(taken_at)),
                       F.when(again, F.concat(F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), name(F.col("response")))),
                       F.lit("Content-Type: text/html"),
                       F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")))
    rows.select(F.concat(head, F.lit(END), body)).write.option("lineSep", END).option("maxRecordsPerFile", 100_000).text(path)


def pieces(spark: SparkSession, path: str, text: bool = False) -> DataFrame:
    """What stands between version lines: file, block, seq (order inside the
    block), candidate header fields and, if asked for, the bytes themselves."""
    raw = spark.read.option("lineSep", VERSION).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value"))
    head = F.substring_index("value", END, 1)
    size, head_size = F.octet_length("value").cast("long"), F.octet_length(head).cast("long")
    field = lambda n, p: F.regexp_extract(head, rf"(?:^|\r\n){n}: *{p}(?:\r\n|$)", 1)
    length = F.when(head_size < size, F.expr("try_cast(content_length AS bigint)"))
    body = F.substring(F.col("value").cast("binary"), (head_size + 5).cast("int"), F.col("length").cast("int"))
    out = raw.withColumn("content_length", field("(?i:Content-Length)", r"(\d{1,18})")).withColumn("length", length).withColumn(
        "whole", F.coalesce(size == head_size + F.col("length") + 8, F.lit(False)))
    return out.select(
        "file", "block", "seq", size.alias("size"), (head_size + F.col("length") + 8).alias("reach"), (head_size + 4).alias("head_size"), "length", "whole",
        field("(?i:WARC-Type)", r"(\S+)").alias("record_type"), field("(?i:WARC-Record-ID)", r"<urn:page:(-?\d*)>").alias("name"),
        field("(?i:WARC-Refers-To)", r"<urn:page:(-?\d*)>").alias("refers"), field("(?i:WARC-Payload-Digest)", r"sha1:(\S+)").alias("told_digest"),
        field("(?i:X-Payload-Length)", r"(\d+)").alias("told_length"),
        F.when(F.col("whole"), base32_sha1(body)).alias("digest"), *([F.col("value").cast("binary").alias("bytes")] if text else []))


def placed(found: DataFrame) -> DataFrame:
    """Give each piece its number in the file and the offset of its version
    line.  Sums run inside a block and over the blocks' totals."""
    sep = len(VERSION)
    sizes = found.groupBy("file", "block").agg(F.sum(F.col("size") + sep).alias("bytes_in"), F.count("*").alias("n_in"))
    over = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("file", "block", F.coalesce(F.sum("bytes_in").over(over), F.lit(0)).alias("bytes_before"),
                        F.coalesce(F.sum("n_in").over(over), F.lit(0)).alias("n_before"))
    inside = Window.partitionBy("file", "block").orderBy("seq")
    upto = F.coalesce(F.sum(F.col("size") + sep).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = found.withColumn("upto", upto).withColumn("k", F.row_number().over(inside) - 1).join(base, ["file", "block"])
    return rows.withColumn("at", F.col("bytes_before") + F.col("upto") - sep).withColumn("idx", F.col("n_before") + F.col("k")).drop(
        "upto", "k", "bytes_before", "n_before", "block", "seq")


def chain(found: DataFrame) -> tuple[DataFrame, bool]:
    """Pieces that are records: reached from the start of their file.  Also
    whether any record is made of several pieces."""
    sep = len(VERSION)
    links = found.filter("idx > 0").select("file", "idx", (F.col("at") + sep + F.col("reach")).alias("next_at"))
    goal = found.filter("idx > 0").select("file", F.col("at").alias("next_at"), F.col("idx").alias("next"))
    jumps = links.join(goal, ["file", "next_at"], "left").select("file", "idx", "next").filter("next is null or next <> idx + 1")
    jumps = materialise(jumps, "warc-jumps")
    count = found.groupBy("file").agg(F.max("idx").alias("top"))
    # a run ends where its pointer does not go to the next piece; it begins after such an end, or where such a pointer goes
    heads = jumps.select("file", (F.col("idx") + 1).alias("head")).unionByName(
        jumps.filter("next is not null").select("file", F.col("next").alias("head"))).unionByName(count.select("file", F.lit(1).cast("long").alias("head"))).distinct()
    heads = heads.join(count, "file").filter("head <= top")
    runs = heads.withColumn("tail", F.coalesce(F.lead("head").over(Window.partitionBy("file").orderBy("head")) - 1, F.col("top")))
    # a run that ends because another begins goes on there
    ends = jumps.select("file", F.col("idx").alias("tail"), "next", F.lit(True).alias("ends"))
    runs = runs.join(ends, ["file", "tail"], "left").select("file", "head", "tail", F.when(F.col("ends"), F.col("next")).otherwise(F.col("tail") + 1).alias("to"))
    runs = materialise(runs, "warc-runs")
    if runs.filter("head > 1").isEmpty():
        return found.filter("idx > 0"), False
    point = runs.select("file", "head", "to")
    reached = runs.filter("head = 1").select("file", "head")
    n = reached.count()
    while True:
        step = reached.join(point, ["file", "head"]).filter("to is not null").select("file", F.col("to").alias("head"))
        # only heads that exist: the piece after a file's last is none
        step = step.join(runs.select("file", "head"), ["file", "head"], "left_semi")
        reached = materialise(reached.unionByName(step).distinct(), "warc-reached")
        now = reached.count()
        if now == n:
            break
        n = now
        far = point.select("file", F.col("head").alias("to"), F.col("to").alias("far"))
        point = materialise(point.join(far, ["file", "to"]).select("file", "head", F.col("far").alias("to")), "warc-pointers")
    false = runs.join(reached, ["file", "head"], "left_anti").select("file", F.explode(F.sequence("head", "tail")).alias("idx"))
    return found.filter("idx > 0").join(false, ["file", "idx"], "left_anti"), True


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``, as their bytes say: page_id,
    payload_bytes, payload_digest, record_type, refers_to.  A revisit's size and
    digest are those its header gives for the full payload."""
    found = materialise(placed(pieces(spark, path)), "warc-pieces")
    records, torn = chain(found)
    if torn:
        records = rejoined(spark, path, found, records)
    again = F.col("record_type") == "revisit"
    number = lambda c: F.expr(f"try_cast({c} AS bigint)")
    return records.select(
        number("name").alias("page_id"), F.when(again, number("told_length")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(again, F.col("told_digest")).otherwise(F.col("digest")).alias("payload_digest"), "record_type",
        F.when(again, number("refers")).alias("refers_to"))


def rejoined(spark: SparkSession, path: str, found: DataFrame, records: DataFrame) -> DataFrame:
    """Records with the digests of those that span several pieces."""
    records = materialise(records, "warc-records")
    # such a record ends beyond its own piece; its pieces are the false ones before the next record
    torn = records.filter("not whole").select("file", F.col("idx").alias("owner"), "at", (F.col("at") + len(VERSION) + F.col("reach")).alias("until"))
    false = found.filter("idx > 0").select("file", "idx", "at").join(records.select("file", "idx"), ["file", "idx"], "left_anti")
    last = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    both = torn.select("file", F.col("owner").alias("idx"), "at", "owner").unionByName(false.withColumn("owner", F.lit(None).cast("long")))
    parts = both.withColumn("owner", F.last("owner", ignorenulls=True).over(last)).filter("owner is not null").select("file", "idx", "owner")
    body = placed(pieces(spark, path, text=True)).select("file", "idx", "bytes").join(parts, ["file", "idx"])
    pick = F.concat(*[F.lit(VERSION).cast("binary"), F.col("bytes")])
    whole = body.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("idx", pick.alias("b")))).alias("bs"))
    whole = whole.select("file", F.col("owner").alias("idx"), F.aggregate(F.transform("bs", lambda x: x["b"]), F.lit("").cast("binary"), lambda a, b: F.concat(a, b)).alias("all"))
    out = records.join(whole, ["file", "idx"], "left")
    body = F.substring("all", (F.col("head_size") + len(VERSION) + 1).cast("int"), F.col("length").cast("int"))
    return out.withColumn("digest", F.when(F.col("whole"), F.col("digest")).otherwise(base32_sha1(body))).drop("all")
