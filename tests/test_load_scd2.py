"""Idempotent month loads and SCD2 sequences."""

import datetime as dt

from pyspark.sql import functions as F

from waitband.operators import load as LD
from waitband.operators import scd2 as SCD
from waitband.session import scratch_path
from tests.test_metrics import raw_frame


def test_load_twice_equals_once_and_reload_one_month(spark):
    raw = raw_frame(spark, [{"bands": {1: 1}}, {"Provider Org Code": "XYZ", "bands": {1: 2}},
                            {"Period": "RTT-December-2025", "bands": {2: 3}}])
    path = scratch_path(spark, "test-load")
    a1 = LD.load_months(raw, path, dt.datetime(2026, 2, 1), source_file="f.zip")
    assert {r._month_code: (r.rows_expected, r.rows_loaded, r.success) for r in a1.collect()} == \
        {"Jan26": (2, 2, True), "Dec25": (1, 1, True)}
    LD.load_months(raw, path, dt.datetime(2026, 2, 2), source_file="f.zip")
    LD.load_months(raw, path, dt.datetime(2026, 2, 3), months=["jan26"], source_file="f2.zip")
    t = spark.read.parquet(path)
    assert t.count() == 3
    by_month = {r._month_code: r.src for r in t.groupBy("_month_code").agg(F.max("_source_file").alias("src")).collect()}
    assert by_month == {"Jan26": "f2.zip", "Dec25": "f.zip"}
    s = LD.load_summary(LD.load_reconcile(LD.with_audit(raw, dt.datetime(2026, 2, 1), source_file="x"), t)).first()
    assert (s.months, s.succeeded, s.failed, s.total_rows) == (2, 2, 0, 3)


def _inc(spark, rows):
    return spark.createDataFrame(rows, "provider_org_code string, provider_org_name string, "
                                       "provider_parent_org_code string, provider_parent_name string")


def test_scd2_check_sequence(spark):
    key, cols = "provider_org_code", ["provider_org_name", "provider_parent_org_code", "provider_parent_name"]
    s1 = SCD.scd2_check(None, _inc(spark, [("A", "Alpha", "Q1", "B1"), ("B", "Beta", "Q1", "B1"),
                                           ("C", "Gamma", "Q2", "B2")]), key, cols, dt.date(2025, 1, 1))
    # rename A, move B to another board, delete C, add D
    s2 = SCD.scd2_check(s1, _inc(spark, [("A", "Alpha2", "Q1", "B1"), ("B", "Beta", "Q3", "B3"),
                                         ("D", "Delta", "Q1", "B1")]), key, cols, dt.date(2025, 2, 1))
    # no change, then C reappears
    s3 = SCD.scd2_check(s2, _inc(spark, [("A", "Alpha2", "Q1", "B1"), ("B", "Beta", "Q3", "B3"),
                                         ("D", "Delta", "Q1", "B1"), ("C", "Gamma", "Q2", "B2")]),
                        key, cols, dt.date(2025, 3, 1))
    rows = sorted((r.provider_org_code, r.provider_org_name, str(r.valid_from), str(r.valid_to), r.is_current)
                  for r in s3.collect())
    assert rows == [
        ("A", "Alpha", "2025-01-01", "2025-02-01", False), ("A", "Alpha2", "2025-02-01", "None", True),
        ("B", "Beta", "2025-01-01", "2025-02-01", False), ("B", "Beta", "2025-02-01", "None", True),
        ("C", "Gamma", "2025-01-01", "2025-02-01", False), ("C", "Gamma", "2025-03-01", "None", True),
        ("D", "Delta", "2025-02-01", "None", True)]
    assert SCD.current_versions(s3).count() == 4


def test_scd2_history_and_asof(spark):
    rows = [("A", "Alpha", "Q1", "B1", dt.date(2025, m, 1)) for m in (1, 2)] + \
           [("A", "Alpha2", "Q1", "B1", dt.date(2025, 3, 1)), ("A", "Alpha", "Q1", "B1", dt.date(2025, 4, 1))]
    df = spark.createDataFrame(rows, "provider_org_code string, provider_org_name string, "
                                     "provider_parent_org_code string, provider_parent_name string, period_date date")
    h = SCD.scd2_from_history(df, "provider_org_code", ["provider_org_name", "provider_parent_org_code",
                                                         "provider_parent_name"])
    got = sorted((r.version, r.provider_org_name, str(r.valid_from), str(r.valid_to)) for r in h.collect())
    assert got == [(1, "Alpha", "2025-01-01", "2025-03-01"), (2, "Alpha2", "2025-03-01", "2025-04-01"),
                   (3, "Alpha", "2025-04-01", "None")]
    j = SCD.asof_join(df.select("provider_org_code", "period_date"), h, "provider_org_code", "period_date",
                      ["provider_org_name"])
    assert sorted((str(r.period_date), r.asof_provider_org_name) for r in j.collect()) == [
        ("2025-01-01", "Alpha"), ("2025-02-01", "Alpha"), ("2025-03-01", "Alpha2"), ("2025-04-01", "Alpha")]
    latest = SCD.latest_per_key(df, "provider_org_code", ["provider_org_name"]).first()
    assert latest.provider_org_name == "Alpha"


def test_fact_sink_is_a_full_refresh(spark):
    from waitband.operators.fact import write_fact
    from waitband.plans import pipeline as P
    fact = P.fact(spark, "/root/testdata/sf0.001")
    path = scratch_path(spark, "test-fact")
    write_fact(fact, path)
    assert spark.read.parquet(path).select("period_date").distinct().count() == 6
    write_fact(fact.filter(F.col("period_date") == dt.date(2026, 1, 1)), path)
    assert [r[0] for r in spark.read.parquet(path).select("period_date").distinct().collect()] == [dt.date(2026, 1, 1)]


def test_stray_and_unparsed_rows_never_replace_a_month(spark):
    """A January file with a December row and a junk period: December keeps its
    three rows, and both rows are held back with their reason."""
    path, held = scratch_path(spark, "test-stray"), scratch_path(spark, "test-held")
    dec = raw_frame(spark, [{"Period": "RTT-December-2025", "Provider Org Code": f"P{i}", "bands": {1: i}} for i in range(3)])
    LD.load_months(dec, path, dt.datetime(2026, 1, 20), source_file="Dec25.zip", month="Dec25")
    jan = raw_frame(spark, [{"bands": {1: 1}}, {"Period": "RTT-December-2025", "bands": {2: 3}}, {"Period": "junk", "bands": {2: 3}}])
    audit = LD.load_months(jan, path, dt.datetime(2026, 2, 20), source_file="Jan26.zip", month="Jan26", is_revised=True, quarantine_path=held)
    got = {(r._month_code, r._is_revised): r.n for r in spark.read.parquet(path).groupBy("_month_code", "_is_revised").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {("Dec25", False): 3, ("Jan26", True): 1}
    assert sorted(r[0] for r in spark.read.parquet(held).select("_quarantine_reason").collect()) == sorted([LD.STRAY, LD.UNPARSED])
    assert [tuple(r) for r in audit.collect()] == [("Jan26", 1, 1, True, 2)]
    # without a file month, a row of no month is held back under no month
    alone = LD.load_months(raw_frame(spark, [{"Period": "junk", "bands": {1: 1}}, {"bands": {1: 1}}]), path, dt.datetime(2026, 2, 21),
                           months=["jan26"], source_file="x.zip")
    assert {r._month_code: (r.rows_loaded, r.rows_quarantined) for r in alone.collect()} == {None: (0, 1), "Jan26": (1, 0)}
    assert None not in {r[0] for r in spark.read.parquet(path).select("_month_code").distinct().collect()}


def test_month_and_year_of_paths(spark):
    from waitband.functions.calendar import month_of_path, year_of_month
    rows = [("/raw/rtt/2025-26/Jan26/Full.zip", "Jan26", "2025-26"), ("/x/full_mar25_v2.zip", "Mar25", "2024-25"), ("/Feb24/apr25.zip", "Apr25", "2025-26"),
            ("/x/summary25.zip", None, None), ("/x/Feb2024.zip", None, None)]
    df = spark.createDataFrame([(r[0],) for r in rows], "p string").select("p", month_of_path(F.col("p")).alias("m"))
    got = {r.p: (r.m, r.y) for r in df.select("p", "m", year_of_month(F.col("m")).alias("y")).collect()}
    assert got == {p: (m, y) for p, m, y in rows}


def test_snapshot_versions_switch_by_marker(spark):
    base = scratch_path(spark, "test-snap")
    cols = ["provider_org_name", "provider_parent_org_code", "provider_parent_name"]
    rows = lambda name, day: spark.createDataFrame([("A", name, "Q1", "B1", day)], "provider_org_code string, provider_org_name string, "  # noqa: E731
                                                   "provider_parent_org_code string, provider_parent_name string, period_date date")
    one = SCD.write_snapshot(spark, base, rows("Alpha", dt.date(2025, 1, 1)), "provider_org_code", cols, dt.date(2025, 1, 1))
    two = SCD.write_snapshot(spark, base, rows("Alpha2", dt.date(2025, 2, 1)), "provider_org_code", cols, dt.date(2025, 2, 1))
    assert (one[-4:], two[-4:]) == ("/v=1", "/v=2")
    assert spark.read.parquet(one).count() == 1 and spark.read.parquet(two).count() == 2


def test_fact_labels_travel_with_the_table(spark):
    from waitband.config import FACT_LABELS
    from waitband.operators.fact import table_labels, write_fact
    from waitband.plans import pipeline as P
    path = scratch_path(spark, "test-labels")
    write_fact(P.fact(spark, "/root/testdata/sf0.001"), path)
    assert table_labels(spark, path) == FACT_LABELS and len(FACT_LABELS) == 3


def test_scratch_needs_a_shared_folder_off_local_mode(spark, monkeypatch):
    import pytest

    from waitband import session

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
    path = scratch_path(spark, "test-clear")
    spark.range(3).write.parquet(path)
    monkeypatch.setattr(session, "_SCRATCH", [path])
    assert session.clear_scratch(spark) == 1


def test_run_pipeline_gates_months(spark):
    from waitband.operators import quality as DQ
    from waitband.plans.pipeline import run_pipeline
    raw = raw_frame(spark, [{"Period": "RTT-December-2025", "bands": {1: 5, 30: 2}},
                            {"Period": "RTT-December-2025", "Provider Org Code": "XYZ", "bands": {2: 1}},
                            {"Period": "RTT-January-2026", "bands": {1: -1}, "total": 1}])
    rules = [DQ.RowCountBetween("rows", lo=1, hi=10), DQ.NotNull("period", column="Period"),
             DQ.NoNegatives("no_negatives"), DQ.RequiredValues("core", severity="warning",
                                                               column="Treatment Function Code", values=("C_110",))]
    out = run_pipeline(raw, scratch_path(spark, "test-run"), dt.datetime(2026, 2, 1), rules=rules)
    assert out["months_loaded"] == ["Dec25"] and out["months_blocked"] == ["Jan26"]
    fact = spark.read.parquet(out["fact"])
    assert fact.count() == 2 and {r[0] for r in fact.select("period_date").collect()} == {dt.date(2025, 12, 1)}
    assert spark.read.parquet(out["dim_provider"]).count() == 2
    res = spark.read.parquet(out["dq_results"])
    assert res.filter("_dq_month = 'Jan26' and check_name = 'no_negatives' and not passed").count() == 1
    # a junk period neither gates nor breaks the run
    junk = raw.unionByName(raw_frame(spark, [{"Period": "junk", "bands": {1: 1}}]))
    held = run_pipeline(junk, scratch_path(spark, "test-run"), dt.datetime(2026, 2, 1), rules=rules)
    assert held["months_loaded"] == ["Dec25"] and spark.read.parquet(held["quarantine"]).count() == 1
    # rules about how much data there is only warn
    size = [r for r in DQ.raw_extract_rules() if r.name in ("row_count_in_expected_range", "total_all_between", "provider_org_code_unique_ratio")]
    assert len(size) == 3
    assert run_pipeline(raw, scratch_path(spark, "test-run"), dt.datetime(2026, 2, 1), rules=size)["months_loaded"] == ["Dec25", "Jan26"]
    report_only = run_pipeline(raw, scratch_path(spark, "test-run"), dt.datetime(2026, 2, 1), rules=rules,
                               block_on_error=False)
    assert report_only["months_loaded"] == ["Dec25", "Jan26"]


def test_sorted_asof_equals_the_range_join(spark):
    import random
    rng = random.Random(4)
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    versions, facts = [], [("a", None, -1), (None, day(3), -2), ("ghost", day(5), -3)]
    for key in ("a", "b", "c"):
        starts = sorted(rng.sample(range(900), 40 if key == "a" else 5))
        for s, e in zip(starts, [*starts[1:], None]):
            closed = e if e is None or rng.random() < 0.7 else rng.randint(s + 1, e)  # some versions end before the next
            versions.append((key, day(s), None if closed is None else day(closed), f"{key}{s}"))
        facts += [(key, day(rng.randint(-20, 1000)), i) for i in range(300)]
    v = spark.createDataFrame(versions, "k string, valid_from date, valid_to date, name string")
    f = spark.createDataFrame(facts, "k string, t date, i int").repartition(7)
    want = sorted(map(tuple, SCD.asof_join(f, v, "k", "t", ["name"]).collect()), key=str)
    for unit in ("month", "year", "day"):
        assert sorted(map(tuple, SCD.asof_sorted(f, v, "k", "t", ["name"], slice_unit=unit).collect()), key=str) == want


def test_sorted_asof_splits_a_hot_key_by_time(spark):
    """10,000 versions and 50,000 facts of one key: every window sees a slice."""
    v = spark.range(10_000).select(F.lit("hot").alias("k"), F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, id, 0, 0)").alias("valid_from"),
                                   F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.col("id").alias("n"))
    f = spark.range(50_000).select(F.lit("hot").alias("k"), F.expr("timestamp_ntz'2020-01-01 00:30:00' + make_interval(0, 0, 0, 0, id div 5, id % 5, 0)").alias("t"),
                                   F.col("id"))
    out = SCD.asof_sorted(f, v, "k", "t", ["n"])
    assert out.filter("asof_n <> id div 5").count() == 0 and out.count() == 50_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Join" not in plan
    slices = f.groupBy(F.date_trunc("month", "t")).count().agg(F.max("count")).first()[0]
    assert slices < 4_000
