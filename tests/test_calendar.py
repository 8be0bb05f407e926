"""Month codes, financial years, period parsing and spines (table-driven)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from waitband.functions.calendar import financial_year, month_code, parse_period, raw_path
from waitband.operators import calendar_ops as CAL

# a leap February, both sides of a century and of a decade, and of the year's start in April
MONTH_CODES = [((2000, 2), "Feb00"), ((1999, 10), "Oct99"), ((2009, 7), "Jul09"), ((2010, 5), "May10"),
               ((2048, 6), "Jun48"), ((2031, 8), "Aug31")]
FIN_YEARS = [((2000, 2), "1999-00"), ((2000, 4), "2000-01"), ((2000, 3), "1999-00"), ((2009, 4), "2009-10"),
             ((2010, 3), "2009-10"), ((2098, 12), "2098-99"), ((2099, 4), "2099-00")]


def _eval(spark, col_fn, dates):
    df = spark.createDataFrame([(dt.date(y, m, 1),) for y, m in dates], "d date")
    return [r[0] for r in df.select(col_fn(F.col("d"))).collect()]


@pytest.mark.parametrize("ym,expected", MONTH_CODES)
def test_month_code(spark, ym, expected):
    assert _eval(spark, month_code, [ym]) == [expected]


def test_month_codes_all_months(spark):
    got = _eval(spark, month_code, [(2026, m) for m in range(1, 13)])
    assert [g[:3] for g in got] == ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    assert all(g.endswith("26") for g in got)


@pytest.mark.parametrize("ym,expected", FIN_YEARS)
def test_financial_year(spark, ym, expected):
    got = _eval(spark, financial_year, [ym])
    assert got == [expected] and len(got[0]) == 7


def test_parse_period_forms(spark):
    df = spark.createDataFrame([("RTT-January-2026",), ("RTT-January 2026",), ("RTT-january-2026",),
                                ("RTT-Foo-2026",), (None,)], "p string")
    got = [r[0] for r in df.select(parse_period("p")).collect()]
    assert got == [dt.date(2026, 1, 1)] * 3 + [None, None]


def test_raw_path(spark):
    df = spark.createDataFrame([("2025-26", "Jan26", "Full_CSV_Jan26.zip")], "fy string, m string, f string")
    assert df.select(raw_path("fy", "m", "f")).first()[0] == "raw/rtt/2025-26/Jan26/Full_CSV_Jan26.zip"


def test_last_n_months_excludes_current(spark):
    got = [r.period_date for r in CAL.last_n_months(spark, 6, dt.date(2026, 4, 15)).collect()]
    assert got == [dt.date(2025, 10, 1), dt.date(2025, 11, 1), dt.date(2025, 12, 1), dt.date(2026, 1, 1),
                   dt.date(2026, 2, 1), dt.date(2026, 3, 1)]


def test_month_range_inclusive(spark):
    got = CAL.month_range(spark, "2025-10", "2026-01").collect()
    assert [r.month_code for r in got] == ["Oct25", "Nov25", "Dec25", "Jan26"]
    assert CAL.month_range(spark, "2026-02", "2026-01").count() == 0


def test_backfill_plan_statuses(spark):
    spine = CAL.month_range(spark, "2025-10", "2025-12")
    loaded = spark.createDataFrame([(dt.date(2025, 11, 1),)], "period_date date")
    plan = {r.month_code: r.status for r in CAL.backfill_plan(spine, loaded).collect()}
    assert plan == {"Oct25": "pending", "Nov25": "skipped", "Dec25": "pending"}
    forced = {r.month_code: r.status for r in CAL.backfill_plan(spine, loaded, force=True, dry_run=True).collect()}
    assert set(forced.values()) == {"dry_run"}


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1),)], "ts timestamp")
    assert CAL.source_freshness(df, "ts", dt.date(2026, 1, 20)).first().status == "pass"
    assert CAL.source_freshness(df, "ts", dt.date(2026, 2, 8)).first().status == "warn"
    assert CAL.source_freshness(df, "ts", dt.date(2026, 2, 15)).first().status == "error"
