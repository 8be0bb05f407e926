"""Stateful publication of months that land in parts."""

import time

from pyspark.sql import functions as F

from waitband.session import scratch_path
from waitband.streaming import completeness as CO

COLUMNS = ["Period", "Provider Org Code"]
JAN, DEC = ("Jan26", "RTT-January-2026"), ("Dec25", "RTT-December-2025")


def part(spark, *rows):
    return spark.createDataFrame([(p, code, m) for (m, p), code in rows], "Period string, `Provider Org Code` string, _month_code string")


def table(spark, target):
    rows = spark.read.parquet(target).select("_month_code", "Provider Org Code", "_is_revised").collect()
    return sorted(map(tuple, rows))


class World:
    def __init__(self, spark):
        base = scratch_path(spark, "test-parts")
        self.spark, self.landing, self.target, self.events = spark, f"{base}/landing", f"{base}/table", f"{base}/events"
        self.checkpoint = f"{base}/checkpoint"

    def land(self, df, version, k, n, months=None):
        CO.land_part(df, self.landing, version, k, n, months=months)

    def run(self):
        CO.publish_available(self.spark, self.landing, self.target, self.checkpoint, "2026-02-01", columns=COLUMNS, events_path=self.events)

    def told(self):
        rows = self.spark.read.parquet(self.events).select("_month_code", "status", "version", "parts").collect()
        return sorted(map(tuple, rows))


def test_a_month_in_three_parts_with_restarts_is_published_once(spark):
    w = World(spark)
    w.land(part(spark, (JAN, "A")), 1, 1, 3)
    w.land(part(spark, (DEC, "D")), 1, 1, 1)
    w.run()
    assert table(spark, w.target) == [("Dec25", "D", False)]  # January waits
    w.land(part(spark, (JAN, "C")), 1, 3, 3)
    w.run()
    w.land(part(spark, (JAN, "C")), 1, 3, 3)  # the same part once more
    w.run()
    assert table(spark, w.target) == [("Dec25", "D", False)]
    w.land(part(spark, (JAN, "B")), 1, 2, 3)
    w.run()
    assert table(spark, w.target) == [("Dec25", "D", False)] + [("Jan26", c, False) for c in "ABC"]
    w.run()
    assert w.told() == [("Dec25", "complete", 1, 1), ("Jan26", "complete", 1, 3)]


def test_revisions_supersede_and_late_older_versions_do_not(spark):
    w = World(spark)
    w.land(part(spark, (JAN, "old1")), 1, 1, 2)
    w.land(part(spark, (JAN, "new"), (JAN, "new2")), 2, 1, 1)
    w.run()
    assert table(spark, w.target) == [("Jan26", "new", True), ("Jan26", "new2", True)]
    w.land(part(spark, (JAN, "old2")), 1, 2, 2)  # completes version 1, too late
    w.run()
    assert table(spark, w.target) == [("Jan26", "new", True), ("Jan26", "new2", True)]
    # version 3 has an empty part, and a row of another month that is held back
    w.land(part(spark, (JAN, "last")).withColumn("Period", F.lit(JAN[1])), 3, 1, 2)
    w.run()
    w.land(spark.createDataFrame([], "Period string, `Provider Org Code` string, _month_code string"), 3, 2, 2, months=["Jan26"])
    w.run()
    assert table(spark, w.target) == [("Jan26", "last", True)]
    assert [r[2] for r in w.told()] == [2, 3]


def test_stray_rows_are_held_back_per_month(spark):
    w = World(spark)
    w.land(part(spark, (JAN, "A"), (("Jan26", DEC[1]), "stray")), 1, 1, 1)
    w.run()
    assert table(spark, w.target) == [("Jan26", "A", False)]
    assert [r["Provider Org Code"] for r in spark.read.parquet(f"{w.target}_quarantine").collect()] == ["stray"]
    w.land(part(spark, (JAN, "A")), 2, 1, 1)
    w.run()
    assert spark.read.schema("Period string, _month_code string").parquet(f"{w.target}_quarantine").count() == 0


def test_a_month_that_waits_too_long_is_told(spark):
    w = World(spark)
    w.land(part(spark, (JAN, "A")), 1, 1, 2)
    q = CO.start_publication(spark, w.landing, w.target, w.checkpoint, "2026-02-01", columns=COLUMNS, events_path=w.events,
                             patience_ms=1000, available_now=False)
    try:
        until, told = time.time() + 90, []
        while not told and time.time() < until:
            time.sleep(1)
            try:
                told = w.told()
            except Exception:  # no event yet: no folder
                told = []
    finally:
        q.stop()
    assert ("Jan26", "stalled", 1, 0) in told


def test_the_stateful_step_has_few_tasks_and_landings_are_gzipped(spark):
    import os
    w = World(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        w.land(part(spark, (JAN, "A"), (DEC, "D")), 1, 1, 1)
        w.run()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert table(spark, w.target) == [("Dec25", "D", False), ("Jan26", "A", False)]
    local = lambda p: p.removeprefix("file:")
    assert len([s for s in os.listdir(f"{local(w.checkpoint)}/state/0") if s.isdigit()]) == CO.STATE_TASKS
    landed = [f for _, _, fs in os.walk(f"{local(w.landing)}/version=1") for f in fs if f.startswith("part-")]
    assert len(landed) >= 2 and all(f.endswith(".csv.gz") for f in landed)
