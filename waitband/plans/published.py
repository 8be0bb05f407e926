"""The ten published analyst queries over the fact table.

Each takes the fact DataFrame (lazy or a written table) and returns the
report.  Ratios of sums use ``try_divide`` on doubles (never decimal), and
are rounded once at the end.  Queries over one month filter ``period_date``
first so a partitioned fact table prunes to one folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SCORECARD_STATUS, THRESHOLDS, Thresholds
from ..functions.metrics import ratio_status, rounded_ratio_pct, safe_ratio

LATEST_PERIOD = dt.date(2026, 1, 1)


def _sum(c: str, alias: str):
    return F.sum(c).cast("bigint").alias(alias)


def national_monthly(fact: DataFrame) -> DataFrame:
    """Q1: national totals and weighted percentage per month."""
    return (fact.groupBy("month_label", "period_date")
            .agg(_sum("total_incomplete", "total_waiting"),
                 _sum("patients_within_18_weeks", "within_18_weeks"),
                 _sum("patients_beyond_18_weeks", "beyond_18_weeks"),
                 _sum("patients_waiting_52_plus_weeks", "over_1_year"),
                 _sum("patients_waiting_over_104_weeks", "over_2_years"))
            .select("month_label", "period_date", "total_waiting", "within_18_weeks", "beyond_18_weeks",
                    rounded_ratio_pct("within_18_weeks", "total_waiting").alias("pct_within_18_weeks"),
                    "over_1_year", "over_2_years")
            .orderBy("period_date"))


def trust_league(fact: DataFrame, period: dt.date = LATEST_PERIOD, th: Thresholds = THRESHOLDS) -> DataFrame:
    """Q2: one month's league table by trust and board, worst first."""
    g = (fact.filter(F.col("period_date") == F.lit(period))
         .groupBy("provider_org_name", "provider_parent_name")
         .agg(_sum("total_incomplete", "total_waiting"), _sum("patients_within_18_weeks", "_within"),
              _sum("patients_waiting_52_plus_weeks", "over_1_year"),
              _sum("patients_waiting_over_104_weeks", "over_2_years")))
    ratio = safe_ratio("_within", "total_waiting")
    return (g.select("provider_org_name", F.col("provider_parent_name").alias("icb"), "total_waiting",
                     F.round(ratio, 1).alias("pct_within_18_weeks"), "over_1_year", "over_2_years",
                     ratio_status(ratio, th=th).alias("rag_status"))
            .orderBy(F.col("pct_within_18_weeks").asc()))


def specialty_performance(fact: DataFrame) -> DataFrame:
    """Q3: per specialty, the unweighted mean of row percentages and totals.

    The mean is taken over integer tenths (row percentages carry one
    decimal), which is exact and independent of summation order."""
    tenths = F.round(F.col("pct_within_18_weeks") * 10).cast("bigint")
    g = (fact.groupBy("treatment_function_name", "specialty_group", "is_surgical")
         .agg(F.sum(tenths).alias("_t"), F.count("pct_within_18_weeks").alias("_n"),
              _sum("total_incomplete", "total_waiting_all_months"),
              _sum("patients_waiting_over_104_weeks", "total_over_2_years")))
    avg = F.round(F.try_divide(F.col("_t").cast("double"), F.col("_n").cast("double") * 10.0), 1)
    return (g.select("treatment_function_name", "specialty_group", "is_surgical",
                     avg.alias("avg_pct_within_18_weeks"), "total_waiting_all_months", "total_over_2_years")
            .orderBy(F.col("avg_pct_within_18_weeks").asc()))


def icb_monthly(fact: DataFrame) -> DataFrame:
    """Q4: board x month comparison."""
    g = (fact.groupBy("provider_parent_name", "provider_parent_org_code", "period_date", "month_label")
         .agg(_sum("total_incomplete", "total_waiting"), _sum("patients_within_18_weeks", "_within"),
              _sum("patients_waiting_over_104_weeks", "over_2_years")))
    return (g.select(F.col("provider_parent_name").alias("icb_name"),
                     F.col("provider_parent_org_code").alias("icb_code"), "period_date", "month_label",
                     "total_waiting", rounded_ratio_pct("_within", "total_waiting").alias("pct_within_18_weeks"),
                     "over_2_years")
            .orderBy("period_date", F.col("pct_within_18_weeks").asc()))


def over_two_years(fact: DataFrame) -> DataFrame:
    """Q5: rows with any patient waiting over 104 weeks, largest first."""
    return (fact.filter(F.col("patients_waiting_over_104_weeks") > 0)
            .groupBy("period_date", "month_label", "provider_org_name", "provider_parent_name",
                     "treatment_function_name")
            .agg(_sum("patients_waiting_over_104_weeks", "patients_over_2_years"),
                 _sum("total_incomplete", "total_waiting"))
            .select("period_date", "month_label", "provider_org_name",
                    F.col("provider_parent_name").alias("icb"), "treatment_function_name",
                    "patients_over_2_years", "total_waiting")
            .orderBy(F.col("patients_over_2_years").desc()))


def trust_trend(fact: DataFrame, provider_org_name: str = "Trust 1") -> DataFrame:
    """Q6: one trust's rows over time."""
    return (fact.filter(F.col("provider_org_name") == provider_org_name)
            .select("month_label", "period_date", "treatment_function_name", "total_incomplete",
                    "patients_within_18_weeks", "pct_within_18_weeks", "patients_waiting_52_plus_weeks",
                    "patients_waiting_over_104_weeks", "rag_status")
            .orderBy("period_date", "treatment_function_name"))


def rag_distribution(fact: DataFrame) -> DataFrame:
    """Q7: RAG counts per month and their share of the month.

    The share window runs on the aggregated rows (months x 4 statuses), so
    its per-month partitions are tiny whatever the fact size."""
    g = fact.groupBy("month_label", "period_date", "rag_status").agg(F.count(F.lit(1)).alias("count"))
    share = F.round(F.col("count").cast("double") * 100.0
                    / F.sum("count").over(Window.partitionBy("period_date")).cast("double"), 1)
    return (g.select("month_label", "period_date", "rag_status", "count", share.alias("pct_of_total"))
            .orderBy("period_date", "rag_status"))


def surgical_vs_medical(fact: DataFrame) -> DataFrame:
    """Q8: specialty group x surgical flag x month (NULL group kept)."""
    g = (fact.groupBy("specialty_group", "is_surgical", "period_date", "month_label")
         .agg(_sum("total_incomplete", "total_waiting"), _sum("patients_within_18_weeks", "_within"),
              _sum("patients_waiting_over_104_weeks", "over_2_years")))
    return (g.select("specialty_group", "is_surgical", "period_date", "month_label", "total_waiting",
                     rounded_ratio_pct("_within", "total_waiting").alias("pct_within_18_weeks"),
                     "over_2_years")
            .orderBy("period_date", "specialty_group"))


def month_on_month(fact: DataFrame) -> DataFrame:
    """Q9: national list size with month-on-month change.

    Aggregate to one row per month first; the un-partitioned LAG window then
    sees only #months rows."""
    monthly = (fact.groupBy("period_date", "month_label")
               .agg(_sum("total_incomplete", "total_waiting"),
                    _sum("patients_within_18_weeks", "within_18_weeks"),
                    _sum("patients_waiting_over_104_weeks", "over_2_years")))
    prev = F.lag("total_waiting").over(Window.orderBy("period_date"))
    change = F.col("total_waiting") - prev
    return (monthly.select("month_label", "period_date", "total_waiting", change.alias("mom_change"),
                           F.round(F.try_divide(change.cast("double") * 100.0, prev.cast("double")), 2)
                           .alias("mom_pct_change"),
                           "within_18_weeks", "over_2_years")
            .orderBy("period_date"))


def trust_scorecard(fact: DataFrame, period: dt.date = LATEST_PERIOD, th: Thresholds = THRESHOLDS) -> DataFrame:
    """Q10: full one-month scorecard per trust with status text and the
    number of distinct specialties reported."""
    g = (fact.filter(F.col("period_date") == F.lit(period))
         .groupBy("provider_org_code", "provider_org_name", "provider_parent_name")
         .agg(_sum("total_incomplete", "total_waiting"),
              _sum("patients_within_18_weeks", "within_18_weeks"),
              _sum("patients_beyond_18_weeks", "beyond_18_weeks"),
              _sum("patients_waiting_52_plus_weeks", "over_1_year"),
              _sum("patients_waiting_over_104_weeks", "over_2_years"),
              F.countDistinct("treatment_function_code").cast("bigint").alias("specialties_reported")))
    ratio = safe_ratio("within_18_weeks", "total_waiting")
    return (g.select("provider_org_code", "provider_org_name", F.col("provider_parent_name").alias("icb"),
                     "total_waiting", "within_18_weeks", "beyond_18_weeks",
                     F.round(ratio, 1).alias("pct_within_18_weeks"), "over_1_year", "over_2_years",
                     ratio_status(ratio, SCORECARD_STATUS, th).alias("performance_status"),
                     "specialties_reported")
            .orderBy(F.col("pct_within_18_weeks").asc()))


def export_csv(report: DataFrame, path: str) -> None:
    """Write a report as CSV with a header (bounded, aggregated output)."""
    report.write.mode("overwrite").option("header", True).csv(path)
