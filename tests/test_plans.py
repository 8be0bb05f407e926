"""Physical-plan properties that matter at scale."""

import contextlib
import io
import re

import pytest

from tests.conftest import SF_SMALL
from waitband.operators import quality as DQ
from waitband.operators.load import month_overwrite, with_audit
from waitband.operators.pathways import incomplete_pathways
from waitband.operators.staging import staging
from waitband.plans import pipeline as P
from waitband.plans import published as Q
from waitband.session import scratch_path


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def layers(spark):
    raw_path = scratch_path(spark, "plan-raw")
    month_overwrite(with_audit(P.raw(spark, SF_SMALL), P.loaded_at_literal(), source_file="x"), raw_path)
    paths = P.materialise(spark.read.parquet(raw_path), scratch_path(spark, "plan-layers"))
    return raw_path, paths


def test_one_month_query_prunes_partitions(spark, layers):
    fact = spark.read.parquet(layers[1]["fact"])
    p = plan(Q.trust_scorecard(fact))
    assert "PartitionFilters: [isnotnull(period_date" in p and "= 2026-01-01" in p


def test_reports_read_only_needed_columns(spark, layers):
    fact = spark.read.parquet(layers[1]["fact"])
    p = plan(Q.national_monthly(fact))
    read_schema = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "total_incomplete" in read_schema and "provider_org_name" not in read_schema
    assert "rag_status" not in read_schema


def test_pathway_filter_reaches_the_scan(spark, layers):
    raw = spark.read.parquet(layers[0])
    p = plan(incomplete_pathways(staging(raw, loaded_at=P.loaded_at_literal())))
    pushed = [line for line in p.splitlines() if line.startswith("PushedFilters")][0]
    assert "EqualTo(`RTT Part Type`,Part_2)" in pushed
    assert "Not(EqualTo(`Treatment Function Code`,C_999))" in pushed


def test_dq_suite_is_one_scan(spark, layers):
    raw = spark.read.parquet(layers[0])
    p = plan(DQ.run_suite(raw, DQ.raw_extract_rules(), by=["_month_code"]))
    scans = [line for line in p.splitlines() if re.match(r"^\(\d+\) Scan parquet", line)]
    assert len(scans) == 1


def test_big_join_is_not_broadcast_but_seed_is(spark):
    p = plan(P.fact(spark, SF_SMALL))
    assert "SortMergeJoin" in p              # lineitem x orders: both sides grow with the data
    assert "BroadcastHashJoin LeftOuter" in p  # the fixed 24-row specialty seed


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dq_suite_expands_only_after_the_first_shuffle(spark):
    from waitband.operators import quality as DQ
    from waitband.plans import pipeline as P
    plan = _plan(DQ.run_suite(P.raw(spark, SF_SMALL), DQ.raw_extract_rules(), by=["Period"]))
    first = plan.rindex("Expand")   # the tree is printed top down: what stands below comes later
    assert plan.count("Expand") == 1 and "Exchange" in plan[first:] and plan[first:].index("Exchange") < plan[first:].index("FileScan")
    assert "count(distinct" not in plan[plan.index("Exchange", first):]


def test_history_does_not_sort_before_the_first_exchange(spark):
    from waitband.operators import scd2 as SCD
    raw = spark.range(10).selectExpr("cast(id as string) k", "cast('a' as string) a", "cast('b' as string) b", "date'2025-01-01' period_date")
    for df in (SCD.scd2_from_history(raw, "k", ["a", "b"]), SCD.latest_per_key(raw, "k", ["a", "b"])):
        plan = _plan(df)
        below = plan[plan.rindex("Exchange"):]
        assert "Sort" not in below and "HashAggregate" in below


def test_no_forced_hash_join(spark):
    from waitband.plans import pipeline as P
    assert "ShuffledHashJoin" not in _plan(P.raw(spark, SF_SMALL))


def test_gaps_read_the_rows_once(spark):
    from waitband.operators import features as FE
    path = f"{SF_SMALL}/orders.parquet"
    rows = spark.read.parquet(path).selectExpr("o_custkey k", "trunc(to_date(o_orderdate), 'month') period_date")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (FE.submission_gaps(rows, ["k"]), FE.completeness_by_month(rows, ["k"])):
            plan = _plan(df)
            assert plan.count("FileScan") - plan.count("ReusedExchange") <= 1 or "ReusedExchange" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")



def test_spread_is_dealt_by_rows(spark, monkeypatch):
    from waitband.sources import extract as EX
    assert [EX.spread_partitions(n, 1) for n in (0, 1, EX.SPREAD_ROWS, EX.SPREAD_ROWS + 1, 40 * EX.SPREAD_ROWS)] == [1, 1, 1, 2, 40]
    assert [EX.spread_partitions(n, 8) for n in (1, EX.SPREAD_ROWS // 2, EX.SPREAD_ROWS)] == [1, 5, 8]
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(EX, "SPREAD_ROWS", -(-lines // 17))   # more than there are cores
    assert P.raw(spark, SF_SMALL).rdd.getNumPartitions() == EX.spread_partitions(lines, spark.sparkContext.defaultParallelism) >= 17   # not merged by bytes


def test_a_provider_month_stays_in_one_task(spark, monkeypatch):
    """So that the suite's states are a row per provider and month, not one per task as well."""
    from pyspark.sql import functions as F

    from waitband.sources import extract as EX
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(EX, "SPREAD_ROWS", -(-lines // 17))
    rows = P.raw(spark, SF_SMALL).select(F.spark_partition_id().alias("task"), "Period", "Provider Org Code")
    placed = {tuple(r) for r in rows.distinct().collect()}
    assert len({r[0] for r in placed}) > 1
    assert len(placed) == len({r[1:] for r in placed}) > 17


def test_month_writes_do_not_sort_the_rows(spark, tmp_path, monkeypatch):
    """Many months in each task: no sort of the wide rows before the files."""
    from waitband import session as SE
    from waitband.streaming import ingest as ING
    rows = spark.range(0, 600, 1, 3).selectExpr("cast(id as string) x", "concat('M', id % 6) _month_code")
    seen = []
    before = SE.unsorted_write

    def watched(s, *args):
        seen.append(True)
        return before(s, *args)

    monkeypatch.setattr(ING, "unsorted_write", watched)
    ING.land_csv(rows, str(tmp_path / "landing"), 1)
    month_overwrite(rows, str(tmp_path / "table"))
    month_overwrite(rows.filter("_month_code = 'M1'").limit(7), str(tmp_path / "table"))
    got = {r[0]: r[1] for r in spark.read.parquet(str(tmp_path / "table")).groupBy("_month_code").count().collect()}
    assert seen and got == {f"M{i}": 7 if i == 1 else 100 for i in range(6)}
    assert spark.conf.get(SE._WRITERS, "0") == "0"   # as it was
    assert len(list((tmp_path / "landing" / "_month_code=M1" / "_landing_version=1").glob("*.csv"))) <= 1
