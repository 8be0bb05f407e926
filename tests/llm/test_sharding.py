import random
import zlib

from waitband.llm import sharding

from . import cases


def rows(df, n):
    return [r.asDict() for r in sharding.kd_shards(df, shards=n).collect()]


def test_every_row_once_and_numbered(spark):
    docs = cases.documents(spark)
    out = rows(docs, 5)
    want = sorted(((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect()), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=str) == want
    for s in range(5):
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert {r["shard"] for r in out} <= set(range(5))


def test_bytes_are_equal_even_with_a_hot_source_and_copies(spark):
    texts = ["same text of a large group"] * 700 + [f"text {i} " * (1 + i % 9) for i in range(1400)]
    docs = cases.documents(spark, texts)
    for n in (2, 7, 24):
        out = rows(docs, n)
        held = [sum(r["size"] for r in out if r["shard"] == s) for s in range(n)]
        assert max(held) - min(held) <= 4 * max(r["size"] for r in out), held


def test_rows_equal_in_everything_are_parted(spark):
    docs = spark.createDataFrame([(1, "abc", "en", "s")] * 640, "doc_id long, text string, lang string, source string").repartition(4)
    out = rows(docs, 8)
    assert sorted(sum(1 for r in out if r["shard"] == s) for s in range(8)) == [80] * 8


def test_target_bytes_and_empty(spark):
    docs = spark.createDataFrame([(i, "x" * 92) for i in range(40)], "doc_id long, text string")
    out = sharding.kd_shards(docs, target_bytes=1000).collect()
    assert sorted(sum(r.shard == s for r in out) for s in range(4)) == [10] * 4
    assert sharding.kd_shards(cases.empty(spark), shards=3).count() == 0


def test_ordinates_keep_the_order(spark):
    from pyspark.sql import functions as F
    names = ["", "a", "ab", "abc", "b", "zz", "é", None]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", sharding.ordinate(F.col("n"), "string").alias("o"))
    got = [r.n for r in df.orderBy("o", "n").collect()]
    assert got == [None, *sorted(names[:-1], key=lambda n: n.encode())]


def by_definition(points, shards):
    """{id: shard}: points are (id, size, coordinates), no two with an equal coordinate."""
    axes = range(len(points[0][2]))
    span = [max(1, max(p[2][i] for p in points) - min(p[2][i] for p in points)) for i in axes]

    def split(own, first, k):
        if k == 1 or not own:
            return {p[0]: first for p in own}
        widest = max(axes, key=lambda i: ((max(p[2][i] for p in own) - min(p[2][i] for p in own)) / span[i], -i))
        want, left, right = sum(p[1] for p in own) * (k // 2) / k, [], []
        for p in sorted(own, key=lambda p: p[2][widest]):
            # the point that the quantile falls into goes to the side that holds more of it
            (left if want > p[1] / 2 else right).append(p)
            want -= p[1]
        return split(left, first, k // 2) | split(right, first + k // 2, k - k // 2)

    return split(points, 0, shards)


def test_splits_are_weighted_medians_along_the_widest_dimension(spark):
    rng = random.Random(3)
    n = 150
    sizes, a, b = (rng.sample(range(9, 9 + spread), n) for spread in (400, 90_000, 3_000_000))
    b = [x // 1000 if k % 2 else x for k, x in enumerate(b)]
    b = [x if b.count(x) == 1 else 10 ** 7 + k for k, x in enumerate(b)]
    docs = spark.createDataFrame([(k, "x" * (s - 8), p, q) for k, (s, p, q) in enumerate(zip(sizes, a, b))], "doc_id long, text string, a long, b long").repartition(6)
    for shards in (2, 3, 8, 13):
        got = {r.doc_id: r.shard for r in sharding.kd_shards(docs, shards=shards, dims=("a", "b")).collect()}
        assert got == by_definition([(k, sizes[k], (sizes[k], a[k], b[k])) for k in range(n)], shards), shards


def test_hosts_that_begin_alike_still_part_the_shards(spark):
    docs = spark.createDataFrame([(i, "t" * 40, f"www.example{i % 500:04d}.org") for i in range(4000)], "doc_id long, text string, source string")
    where = {}
    for r in sharding.kd_shards(docs, shards=16).collect():
        where.setdefault(r.doc_id % 500, set()).add(r.shard)
    assert sum(map(len, where.values())) / len(where) < 1.2
    assert sharding.shared("www.a", "www.b") == 4 and sharding.shared("x", "x") == 1 and sharding.shared(None, "x") == 0
