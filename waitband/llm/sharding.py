"""K-d tree sharding (operator 1).

The rows' metadata dimensions are numbers.  Strings count by the six bytes after
the beginning that all values of their column share (hosts that all begin with
www., say), which keeps their order; strings that agree there too are ties.  A node that stands for ``k`` leaves is split along
the dimension in which it is widest, measured against the whole table, at the
weighted quantile that gives ``k // 2`` leaves their share of the bytes (the
median if ``k`` is even); leaves reach the target size together.

Quantiles are found in the data's place: rows are counted into ``BUCKETS``
buckets per node, all nodes of a level in one aggregation, and the bucket that
the quantile falls into is cut up again until it holds next to nothing.  Rows
of equal value are parted by a hash of the document and, if even that is equal,
by row number, so no tie and no group of copies makes a shard heavy.  Only one
row per node comes to the driver, and the rows are shuffled once, narrow, to be
numbered within their shard.

Nulls: a null text has no bytes, a null dimension counts as the least value, a
null doc_id is kept.  Repeated rows are rows of their own.  An empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

BUCKETS = 4096
TOP = (1 << 63) - 1
#: A bucket holding at most this part of a leaf's bytes is not cut up further.
FINE = 0.002
#: Rows that are numbered together.
NUMBERED = 5_000
#: Rows of a per-node table up to which it is broadcast (a row is under 100 bytes).
BROADCAST_ROWS = 100_000


def shared(least: str | None, greatest: str | None) -> int:
    """Bytes that all values between two strings begin with."""
    a, b = (least or "").encode(), (greatest or "").encode()
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def ordinate(c: Column, kind: str, skip: int = 0) -> Column:
    """A dimension as a whole number that keeps the order; ``skip`` bytes are the
    same in all strings."""
    if kind == "string":
        head = F.rpad(F.substring(F.hex(F.encode(c, "UTF-8")), 1 + 2 * skip, 12), 12, "0")
        return F.coalesce(F.conv(head, 16, 10).cast("long"), F.lit(-1).cast("long"))
    return F.coalesce(c.cast("long"), F.lit(-1).cast("long"))


def measured(docs: DataFrame, id_col: str, text_col: str, dims: list[str]) -> DataFrame:
    """Narrow rows: id, size, checksum, dimensions, what parts ties, and the root node."""
    kinds = dict(docs.dtypes)
    texts = [d for d in dims if kinds[d] == "string"]
    ends = docs.agg(*[f(docs[d]) for d in texts for f in (F.min, F.max)]).first() if texts else ()
    skip = {d: shared(ends[2 * k], ends[2 * k + 1]) for k, d in enumerate(texts)}
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    size = (F.octet_length(text) + 8).cast("long")
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), size.alias("size"), F.crc32(text).alias("text_crc32"),
        F.array(size, *[ordinate(docs[d], kinds[d], skip.get(d, 0)) for d in dims]).alias("x"),
    ).withColumn("tie", F.xxhash64("doc_id", "text_crc32", "x").bitwiseAND(F.lit(TOP))).withColumn("row", F.monotonically_increasing_id()).withColumn("node", F.lit(0))


class Tree:
    """Splits the nodes of ``rows`` level by level.  A node is named by its
    first shard; ``leaves`` says how many shards it will become."""

    def __init__(self, rows: DataFrame, shards: int, dims: int):
        self.dims = dims
        self.spark, self.rows = rows.sparkSession, rows
        self.leaves = {0: shards}
        self.ranges: list[int] = []

    def table(self, rows: list[tuple], schema: str) -> DataFrame:
        small = self.spark.createDataFrame(rows, schema)
        return F.broadcast(small) if len(rows) <= BROADCAST_ROWS else small

    def level(self) -> bool:
        """Split every node of more than one leaf; False if there is none."""
        todo = {n: k for n, k in self.leaves.items() if k > 1}
        if not todo:
            return False
        dims = range(self.dims)
        edge = [f(F.get("x", F.lit(i))).alias(f"{f.__name__}{i}") for i in dims for f in (F.min, F.max)]
        stats = self.rows.groupBy("node").agg(F.sum("size").alias("size"), *edge).collect()
        if not self.ranges:
            self.ranges = [max(1, max(r[f"max{i}"] for r in stats) - min(r[f"min{i}"] for r in stats)) for i in dims]
        # per node: dimension, stage (0 value, 1 hash, 2 row number), the values fixed so far, range in question, bytes wanted, tolerance
        open_: dict[int, dict] = {}
        for r in stats:
            if r["node"] in todo:
                k = todo[r["node"]]
                dim = max(dims, key=lambda i: ((r[f"max{i}"] - r[f"min{i}"]) / self.ranges[i], -i))
                open_[r["node"]] = {"dim": dim, "stage": 0, "v": 0, "t": 0, "lo": r[f"min{dim}"], "hi": r[f"max{dim}"],
                                    "want": r["size"] * (k // 2) / k, "fine": r["size"] / k * FINE}
        cuts = {n: (0, -TOP, -TOP, -TOP) for n in todo if n not in open_}  # nodes without rows
        while open_:
            for node, place in self.crossing(open_).items():
                o, (a, b, before, weight) = open_[node], place
                o["want"] -= before
                if a < b and weight > o["fine"]:
                    o["lo"], o["hi"] = a, b
                elif a == b and o["stage"] < 2 and weight > o["fine"]:
                    o["v" if o["stage"] == 0 else "t"] = a
                    o["stage"] += 1
                    o["lo"], o["hi"] = 0, TOP
                else:
                    last = b if o["want"] > weight / 2 else a - 1
                    fixed = [o["v"], o["t"]][:o["stage"]]
                    cuts[node] = (o["dim"], *([*fixed, last] + [TOP, TOP])[:3])
                    del open_[node]
        rows = [(n, todo[n] // 2, *cut) for n, cut in cuts.items()]
        cut = self.table(rows, "node int, left int, dim int, v long, t long, r long")
        here = F.struct(F.get("x", F.col("dim")), F.col("tie"), F.col("row"))
        right = F.col("left").isNotNull() & (here > F.struct("v", "t", "r"))
        self.rows = self.rows.join(cut, "node", "left").select(
            *[c for c in self.rows.columns if c != "node"], (F.col("node") + F.when(right, F.col("left")).otherwise(0)).alias("node"))
        for n, k in todo.items():
            self.leaves[n], self.leaves[n + k // 2] = k // 2, k - k // 2
        return True

    def crossing(self, open_: dict[int, dict]) -> dict[int, tuple]:
        """Per node the bucket that its quantile falls into: first and last
        value, bytes before it, bytes in it."""
        state = self.table([(n, o["dim"], o["stage"], o["v"], o["t"], o["lo"], o["hi"], max(1, -(-(o["hi"] - o["lo"] + 1) // BUCKETS)), float(o["want"]))
                            for n, o in open_.items()],
                           "node int, dim int, stage int, v long, t long, lo long, hi long, width long, want double")
        x = F.get("x", F.col("dim"))
        key = F.when(F.col("stage") == 0, x).when(F.col("stage") == 1, F.col("tie")).otherwise(F.col("row"))
        same = ((F.col("stage") < 1) | (x == F.col("v"))) & ((F.col("stage") < 2) | (F.col("tie") == F.col("t")))
        hist = self.rows.join(state, "node").filter(same).withColumn("key", key).filter(F.col("key").between(F.col("lo"), F.col("hi"))).groupBy(
            "node", F.expr("(key - lo) div width").alias("bucket")).agg(
            F.sum("size").alias("weight"), F.min("key").alias("a"), F.max("key").alias("b"), F.first("want").alias("want"))
        order = Window.partitionBy("node").orderBy("bucket")
        run = hist.withColumn("upto", F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        last = F.lead("bucket").over(order).isNull()
        found = run.withColumn("last", last).filter((F.col("upto") >= F.col("want")) | F.col("last")).groupBy("node").agg(
            F.min_by(F.struct("a", "b", (F.col("upto") - F.col("weight")).alias("before"), "weight"), "bucket").alias("p"))
        return {r["node"]: tuple(r["p"]) for r in found.collect()}


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id",
              text_col: str = "text", dims: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot), one per document.  Give the
    number of shards or their target bytes; beside ``dims`` the size itself is a
    dimension.  Shards hold equal bytes but for about a row's size and two
    thousandths of a leaf per level."""
    dims = [d for d in dims if d in docs.columns]
    rows = materialise(measured(docs, id_col, text_col, dims), "kd-rows")
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    if shards is None:
        shards = max(1, -(-(total or 0) // target_bytes))
    tree = Tree(rows, shards, 1 + len(dims))
    while count and tree.level():
        pass
    return numbered(tree.rows.withColumnRenamed("node", "shard"), max(1, count // (shards * NUMBERED)), shards)


def numbered(rows: DataFrame, parts: int, shards: int) -> DataFrame:
    """Slots from 0 without gaps in each shard: rows are numbered in ``parts``
    parts per shard, dealt by hash, and each part begins where those before it end."""
    rows = rows.withColumn("part", (F.col("tie") % parts).cast("int"))
    sizes = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    order = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("shard", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("first"))
    if parts * shards <= BROADCAST_ROWS:
        first = F.broadcast(first)
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("tie", "row")) - 1
    return rows.withColumn("inside", inside).join(first, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("inside")).cast("long").alias("slot"))
