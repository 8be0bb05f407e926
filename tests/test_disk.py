"""What steps leave on disk and how often they run: shuffles that go with the
write that made them, months kept apart without a shuffle of wide rows, and
landings that are gzipped and evaluated once."""

import datetime as dt
import os
import zipfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_metrics import raw_frame
from waitband.operators import load as LD
from waitband.plans import fixtures as FX
from waitband.plans import pipeline as P
from waitband.session import scratch_path
from waitband.streaming import ingest as ING

TS = dt.datetime(2026, 2, 1)


def shuffle_files(spark) -> set:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in files.mkString("\n").split("\n") if "/shuffle_" in n}


def test_a_task_of_the_extract_holds_one_month_or_two(spark, monkeypatch):
    from waitband.sources import extract as EX
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(EX, "SPREAD_ROWS", -(-lines // 17))
    placed = {tuple(r) for r in P.raw(spark, SF_SMALL).select(F.spark_partition_id(), "Period").distinct().collect()}
    tasks, months = ({r[k] for r in placed} for k in (0, 1))
    assert len(months) == 6 and len(tasks) > 12
    assert len(placed) < len(tasks) + len(months)   # dealt by hash, every task held every month


def test_a_line_is_narrow_until_its_group_is_whole(spark):
    from waitband.sources import extract as EX
    kinds = dict(EX._line_rows(spark, SF_SMALL, 2).dtypes)
    assert {c for c, t in kinds.items() if t == "string"} == set()
    codes = spark.createDataFrame([(k,) for k in (-3, -1, 0, 7, 8, None)], "k bigint").select(EX._code(F.col("k"), EX.SPECIALTY_CODES)).collect()
    assert [r[0] for r in codes] == [None, None, 0, 7, None, None]


def test_month_loads_free_their_shuffles(spark, tmp_path):
    rows = raw_frame(spark, [{"Period": f"RTT-{m}", "Provider Org Code": f"P{i}", "bands": {1: i}}
                             for i in range(20) for m in ("January-2026", "December-2025")]).repartition(3)
    before = shuffle_files(spark)
    LD.load_months(rows, str(tmp_path / "table"), TS)
    ING.land_csv(rows.withColumn("_month_code", F.lit("Jan26")), str(tmp_path / "landing"), 1)
    FX.write_zip_archives(rows.withColumn("_month_code", F.lit("Jan26")), str(tmp_path / "zips"), "_month_code", str(tmp_path / "csv"))
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert spark.read.parquet(str(tmp_path / "table")).count() == 40


def test_a_landing_runs_its_source_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def month(i):
        seen.add(1)
        return None if i % 10 == 9 else f"M{i % 3}"

    rows = spark.range(0, 60, 1, 3).select(F.col("id").cast("string").alias("x"), month.asNondeterministic()("id").alias("_month_code"))
    landing = str(tmp_path / "landing")
    for rebalance in (False, True):
        ING.land_csv(rows, landing, 1 + rebalance, rebalance=rebalance)
    assert seen.value == 120
    files = [os.path.join(d, f) for d, _, fs in os.walk(landing) for f in fs if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    for version in (1, 2):   # rows without a month complete no month
        assert [ING.latest_complete(spark, landing, m) for m in ("M0", "M1", "M2", "None", "__HIVE_DEFAULT_PARTITION__")] == [2, 2, 2, None, None]
        landed = spark.read.option("header", True).csv(landing).filter(F.col("_landing_version") == version)
        assert sorted(int(r.x) for r in landed.select("x").collect()) == list(range(60))
    # a second landing of a version completes the months that it brings, no other
    ING.land_csv(rows, landing, 3, complete=False)
    ING.land_csv(rows.filter("x < 30").withColumn("_month_code", F.lit("M1")), landing, 3)
    assert [ING.latest_complete(spark, landing, m) for m in ("M0", "M1")] == [2, 3]


def test_the_ingest_stream_reads_no_landed_file(spark, tmp_path):
    """It asks for folder names; a month is read once, when it is rebuilt."""
    landing = str(tmp_path / "landing")
    rows = raw_frame(spark, [{"Provider Org Code": "AAA", "bands": {1: 1}}]).withColumn("_month_code", F.lit("Jan26"))
    ING.land_csv(rows, landing, 1, complete=False)
    folder = ING.version_dir(landing, "Jan26", 1)
    for f in os.listdir(folder):
        with open(os.path.join(folder, f), "wb") as out:
            out.write(b"\x1f\x8bnot gzip at all")
    ING.ingest_available(spark, landing, str(tmp_path / "table"), str(tmp_path / "checkpoint"), TS)   # no marker yet: nothing to build
    assert not os.path.exists(tmp_path / "table")


def test_gzipped_staging_makes_the_same_archive(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 4).selectExpr("cast(id as string) x", "repeat(',', 50) y", "'Jan26' m")
    held, staged = {}, {}
    for kind in (None, "gzip"):
        FX.write_zip_archives(rows, f"{tmp_path}/{kind}", "m", f"{tmp_path}/csv-{kind}", compression=kind)
        with zipfile.ZipFile(f"{tmp_path}/{kind}/Jan26/Jan26_full.zip") as z:
            held[kind] = z.read("Jan26.csv")
        staged[kind] = sum(os.path.getsize(f"{tmp_path}/csv-{kind}/__m=Jan26/{f}") for f in os.listdir(f"{tmp_path}/csv-{kind}/__m=Jan26") if ".csv" in f)
    assert held[None] == held["gzip"] and held[None].count(b"\n") == 4001
    assert staged["gzip"] * 5 < staged[None]


def test_a_run_without_rebalance_loads_the_same(spark, tmp_path):
    raw = P.raw(spark, SF_SMALL)
    done = [P.run_pipeline(raw, scratch_path(spark, "test-run"), source_file="f", rebalance=r) for r in (True, False)]
    assert done[0]["months_loaded"] == done[1]["months_loaded"] and len(done[0]["months_loaded"]) == 6
    for t in ("raw", "fact"):
        a, b = (spark.read.parquet(x[t]) for x in done)
        assert a.count() and not a.exceptAll(b.select(a.columns)).count() and not b.exceptAll(a.select(b.columns)).count()


def test_a_task_reads_few_gzipped_files(spark, tmp_path):
    """Cut by bytes on disk alone, one task would unpack a landing of hundreds of megabytes."""
    from waitband.session import packed_reads
    spark.range(0, 40, 1, 40).selectExpr("cast(id as string) x").write.option("compression", "gzip").csv(str(tmp_path / "g"))
    files = spark.read.schema("x string").csv(str(tmp_path / "g"))
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))   # a file counts as 64 MB
    try:
        with packed_reads(spark):
            assert files.select("x").rdd.getNumPartitions() == 40
        assert files.select("x").rdd.getNumPartitions() <= 20
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
