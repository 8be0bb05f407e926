"""Quarantine per month and file, months without rows, one evaluation of the
source, audits kept per run."""

import datetime as dt

from pyspark.sql import functions as F

from waitband.operators import load as LD
from waitband.session import scratch_path
from tests.test_metrics import raw_frame

AT = dt.datetime(2026, 2, 1)


def held_rows(spark, path):
    return sorted((r["_month_code"] or "", r["_source_file"], r["_quarantine_reason"]) for r in spark.read.parquet(path).collect())


def test_a_load_answers_for_its_own_months_only(spark):
    path, held = scratch_path(spark, "test-load"), scratch_path(spark, "test-held")
    dec = raw_frame(spark, [{"Period": "RTT-December-2025", "bands": {1: 1}}, {"Period": "RTT-January-2026", "bands": {1: 2}}])
    LD.load_months(dec, path, AT, source_file="Dec25.zip", month="Dec25", quarantine_path=held)
    assert held_rows(spark, held) == [("Dec25", "Dec25.zip", LD.STRAY)]
    jan = raw_frame(spark, [{"bands": {1: 1}}, {"Period": "junk", "bands": {1: 2}}])
    LD.load_months(jan, path, AT, source_file="Jan26.zip", month="Jan26", quarantine_path=held)
    assert held_rows(spark, held) == [("Dec25", "Dec25.zip", LD.STRAY), ("Jan26", "Jan26.zip", LD.UNPARSED)]
    # a clean second January file clears January's and leaves December's
    LD.load_months(raw_frame(spark, [{"bands": {1: 1}}]), path, AT, source_file="Jan26_v2.zip", month="Jan26", quarantine_path=held)
    assert held_rows(spark, held) == [("Dec25", "Dec25.zip", LD.STRAY)]
    assert {r[0]: r[1] for r in spark.read.parquet(path).groupBy("_month_code").count().collect()} == {"Dec25": 1, "Jan26": 1}


def test_rows_without_a_month_are_kept_by_file(spark):
    path, held = scratch_path(spark, "test-load"), scratch_path(spark, "test-held")
    junk = raw_frame(spark, [{"Period": "junk", "bands": {1: 1}}, {"bands": {1: 1}}])
    clean = raw_frame(spark, [{"bands": {1: 1}}])
    for name in ("s3://a/x=1.zip", "b.zip"):
        LD.load_months(junk, path, AT, source_file=name, quarantine_path=held)
    LD.load_months(junk, path, AT, source_file="b.zip", quarantine_path=held)
    assert held_rows(spark, held) == [("", "b.zip", LD.UNPARSED), ("", "s3://a/x=1.zip", LD.UNPARSED)]
    LD.load_months(clean, path, AT, source_file="s3://a/x=1.zip", quarantine_path=held)
    assert held_rows(spark, held) == [("", "b.zip", LD.UNPARSED)]


def test_a_month_without_rows_fails(spark):
    path = scratch_path(spark, "test-load")
    raw = raw_frame(spark, [{"bands": {1: 1}}])
    audit = LD.load_months(raw, path, AT, months=["jan26", "Feb26"], source_file="x")
    assert {r["_month_code"]: (r["rows_expected"], r["rows_loaded"], r["success"]) for r in audit.collect()} == {"Jan26": (1, 1, True), "Feb26": (0, 0, False)}
    s = LD.load_summary(audit).first()
    assert (s["months"], s["succeeded"], s["failed"]) == (2, 1, 1)


def test_the_source_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    raw = raw_frame(spark, [{"bands": {1: i}} for i in range(5)] + [{"Period": "junk", "bands": {1: 1}}])
    LD.load_months(raw.mapInArrow(counted, raw.schema), scratch_path(spark, "test-load"), AT, source_file="x",
                   quarantine_path=scratch_path(spark, "test-held")).collect()
    assert seen.value == 6


def test_runs_are_kept_and_repeated_runs_replace_their_own(spark):
    path = scratch_path(spark, "test-audit")
    one = spark.createDataFrame([("Jan26", 1), ("Dec25", 2)], "m string, n int")
    LD.append_run(one, path, AT)
    LD.append_run(one.filter("n = 1"), path, dt.datetime(2026, 3, 1))
    LD.append_run(one.filter("n = 2"), path, AT)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("Dec25", 2, "20260201T000000"), ("Jan26", 1, "20260301T000000")]
    assert [tuple(r) for r in LD.this_run(spark.read.parquet(path), F.lit("2026-03-01 00:00:00").cast("timestamp_ntz")).collect()] == [("Jan26", 1)]
