"""Month spines, backfill planning, freshness and publication status.

Spines are generated with ``sequence`` + ``explode`` from one bounds row,
so they never pass through the driver; their size is the number of months.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FRESHNESS_ERROR_DAYS, FRESHNESS_WARN_DAYS
from ..functions.calendar import financial_year, month_code


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def with_month_attrs(df: DataFrame, date_col: str = "period_date") -> DataFrame:
    d = F.col(date_col)
    return df.select("*", F.year(d).cast("bigint").alias("year"), F.month(d).cast("bigint").alias("month"),
                     month_code(d).alias("month_code"), financial_year(d).alias("financial_year"))


def spine_between(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """One row per month from trunc(start) to trunc(end) inclusive, for each
    bounds row (columns other than the bounds are kept)."""
    others = [c for c in bounds.columns if c not in (start_col, end_col)]
    s = F.trunc(F.to_date(_c(start_col)), "month")
    e = F.trunc(F.to_date(_c(end_col)), "month")
    months = F.when(s <= e, F.sequence(s, e, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))
    return with_month_attrs(bounds.select(*others, F.explode(months).alias("period_date")))


def spine_last_n(as_of: DataFrame, n: int, as_of_col: str = "as_of") -> DataFrame:
    """The ``n`` months before the month of ``as_of`` (current month excluded
    because of the publication lag), oldest first."""
    m = F.trunc(F.to_date(_c(as_of_col)), "month")
    b = as_of.select(*[c for c in as_of.columns if c != as_of_col],
                     F.add_months(m, -n).alias("start"), F.add_months(m, -1).alias("end"))
    return spine_between(b)


def month_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Inclusive ``YYYY-MM`` range (parameters only; no data read)."""
    b = spark.range(1).select(F.to_date(F.lit(start + "-01")).alias("start"),
                              F.to_date(F.lit(end + "-01")).alias("end"))
    return spine_between(b)


def last_n_months(spark: SparkSession, n: int, today: dt.date | None = None) -> DataFrame:
    today = today or dt.date.today()
    return spine_last_n(spark.range(1).select(F.lit(today).alias("as_of")), n)


def backfill_plan(spine: DataFrame, loaded: DataFrame, force: bool = False, dry_run: bool = False,
                  key: str = "period_date") -> DataFrame:
    """Per month: ``skipped`` if already loaded (and not forced), else
    ``dry_run`` when dry, else ``pending``.  ``loaded`` holds one row per
    loaded month (deduplicated here, so a raw table can be passed)."""
    present = loaded.select(key).distinct().withColumn("_present", F.lit(True))
    j = spine.join(present, key, "left")
    is_present = F.coalesce(F.col("_present"), F.lit(False))
    status = (F.when(is_present & F.lit(not force), "skipped")
              .when(F.lit(dry_run), "dry_run").otherwise("pending"))
    return j.select(*spine.columns, is_present.alias("already_loaded"), status.alias("status"))


def backfill_summary(plan: DataFrame) -> DataFrame:
    """Counts per status; ``bytes`` / ``is_revised`` / ``error_message`` are
    summed / listed when the plan carries download results."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("months")]
    if "file_size_bytes" in plan.columns:
        aggs.append(F.sum("file_size_bytes").cast("bigint").alias("bytes"))
    if "is_revised" in plan.columns:
        aggs.append(F.sum(F.col("is_revised").cast("int")).cast("bigint").alias("revised"))
    if "error_message" in plan.columns:
        # one entry per failed month: bounded by the number of months planned
        aggs.append(F.collect_list(F.when(F.col("error_message").isNotNull(),
                                          F.concat_ws(": ", F.col("month_code"), F.col("error_message"))))
                    .alias("failures"))
    aggs += [F.min("period_date").alias("first_month"), F.max("period_date").alias("last_month")]
    return plan.groupBy("status").agg(*aggs)


def backfill_success(summary: DataFrame) -> DataFrame:
    """One row: did the backfill as a whole succeed (no failed month)?"""
    failed = F.coalesce(F.sum(F.when(F.col("status") == "failed", F.col("months"))), F.lit(0))
    return summary.agg((failed == 0).alias("success"), F.coalesce(F.sum("months"), F.lit(0)).cast("bigint").alias("months"),
                       failed.cast("bigint").alias("failed"))


def source_freshness(df: DataFrame, ts_col: str, as_of, warn_days: int = FRESHNESS_WARN_DAYS,
                     error_days: int = FRESHNESS_ERROR_DAYS) -> DataFrame:
    """Newest load time vs ``as_of``: pass / warn / error (no rows: error)."""
    a = df.agg(F.max(ts_col).alias("max_loaded_at"), F.count(F.lit(1)).cast("bigint").alias("rows"))
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("max_loaded_at")).cast("bigint")
    status = (F.when(F.col("max_loaded_at").isNull(), "error").when(age > error_days, "error")
              .when(age > warn_days, "warn").otherwise("pass"))
    return a.select("max_loaded_at", "rows", age.alias("age_days"), status.alias("status"))


def publication_status(spine: DataFrame, links: DataFrame, key: str = "month_code") -> DataFrame:
    """Expected months x found release links: is each month published yet?"""
    found = links.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias("links"),
                                   F.max(F.col("is_revised").cast("int")).cast("boolean").alias("has_revision"))
    j = spine.join(found, key, "left")
    return j.select(*spine.columns, F.coalesce("links", F.lit(0).cast("bigint")).alias("links"),
                    (F.coalesce("links", F.lit(0)) > 0).alias("published"),
                    F.coalesce("has_revision", F.lit(False)).alias("has_revision"))
