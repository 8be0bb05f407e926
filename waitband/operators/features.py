"""Modelling features: entity-month panel, breach-prediction features,
submission completeness and anomaly scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import THRESHOLDS, Thresholds
from ..functions.metrics import safe_ratio
from .windows import lag_diff, lagged_rolling_mean, next_period_value

ENTITY = ("provider_org_code", "treatment_function_code")


def entity_month_panel(fact: DataFrame, entity=ENTITY, th: Thresholds = THRESHOLDS) -> DataFrame:
    """One row per entity (trust x specialty) per month: summed counts,
    weighted percentage and standard flag.  The fact grain also carries the
    commissioner; summing first gives each window partition one row per month.
    Where the fact marks revised rows, a month with any is marked."""
    marks = [F.max("_is_revised").alias("_is_revised")] if "_is_revised" in fact.columns else []
    g = fact.groupBy(*entity, "period_date").agg(
        F.sum("total_incomplete").cast("bigint").alias("total_incomplete"),
        F.sum("patients_within_18_weeks").cast("bigint").alias("patients_within_18_weeks"),
        F.sum("patients_waiting_52_plus_weeks").cast("bigint").alias("patients_waiting_52_plus_weeks"),
        F.max(F.col("is_surgical").cast("int")).cast("boolean").alias("is_surgical"), *marks)
    ratio = safe_ratio("patients_within_18_weeks", "total_incomplete")
    return g.select("*", F.round(ratio, 1).alias("pct_within_18_weeks"),
                    (ratio >= th.standard_pct).alias("meets_18_week_standard"))


def breach_features(panel: DataFrame, entity=ENTITY) -> DataFrame:
    """Lagged 3-month rolling pct, month-on-month list change, long-waiter
    ratio and the next-month targets (only when the next month exists)."""
    e = list(entity)
    return panel.select(
        "*",
        lagged_rolling_mean("pct_within_18_weeks", e, "period_date", 3).alias("rolling_3m_pct"),
        lag_diff("total_incomplete", e, "period_date").alias("mom_list_change"),
        F.try_divide(F.col("patients_waiting_52_plus_weeks").cast("double"),
                     F.col("total_incomplete").cast("double")).alias("long_waiter_ratio"),
        next_period_value("meets_18_week_standard", e, "period_date").alias("target_meets_next_month"),
        next_period_value("total_incomplete", e, "period_date").alias("target_total_next_month"),
    )


def _presence(rows: DataFrame, entity: list[str], period_col: str) -> DataFrame:
    """Per entity the set of its months (bounded by the number of months)."""
    return rows.select(*entity, period_col).distinct().groupBy(*entity).agg(F.collect_set(period_col).alias("__months"))


def _expected(seen: DataFrame, entity: list[str], period_col: str) -> DataFrame:
    """(entity, period, reported) over the overall reporting window.  The window
    comes from the small per-entity table itself, in the same job: its first and
    last month are one row, which is a proven bound for the broadcast."""
    ends = seen.agg(F.min(F.array_min("__months")).alias("__first"), F.max(F.array_max("__months")).alias("__last"))
    months = F.explode(F.sequence("__first", "__last", F.expr("interval 1 month"))).alias(period_col)
    one = seen.withColumn("__one", F.lit(1)).join(F.broadcast(ends.withColumn("__one", F.lit(1))), "__one")
    return one.select(*entity, "__months", months).select(*entity, period_col, F.array_contains("__months", F.col(period_col)).alias("reported"))


def submission_gaps(rows: DataFrame, entity=("provider_org_code",), period_col: str = "period_date") -> DataFrame:
    """(entity, period) pairs where an entity that reports at some point is
    missing from a month of the overall reporting window.  A missing row is
    no submission, never zero.

    The rows are read once: each entity's months are gathered into a set, the
    expected months are exploded beside it and those in the set drop out."""
    entity = [entity] if isinstance(entity, str) else list(entity)
    return _expected(_presence(rows, entity, period_col), entity, period_col).filter(~F.col("reported")).drop("reported")


def completeness_by_month(rows: DataFrame, entity=("provider_org_code",),
                          period_col: str = "period_date") -> DataFrame:
    entity = [entity] if isinstance(entity, str) else list(entity)
    n = lambda c, name: F.sum(c.cast("int")).cast("bigint").alias(name)
    return _expected(_presence(rows, entity, period_col), entity, period_col).groupBy(period_col).agg(
        n(F.col("reported"), "reporting"), n(~F.col("reported"), "missing"))


def performance_anomalies(panel: DataFrame, entity=ENTITY, z_threshold: float = 2.0) -> DataFrame:
    """z-score of each month's pct against the entity's *other* months: with the
    month itself in its baseline no score could pass (n - 1) / sqrt(n), 2.04 for
    six months.

    Mean and sample variance come from exact integer sums of tenths, so the
    score does not depend on summation order.  Fewer than three other months, or
    others that are all equal, give no score."""
    w = Window.partitionBy(*entity)
    t = F.round(F.col("pct_within_18_weeks") * 10).cast("bigint")
    df = panel.select("*", t.alias("__t"))
    own, own2 = F.coalesce("__t", F.lit(0)), F.coalesce(F.col("__t") * F.col("__t"), F.lit(0))
    n = (F.count("__t").over(w) - F.col("__t").isNotNull().cast("int")).cast("double")
    s = (F.sum("__t").over(w) - own).cast("double")
    s2 = (F.sum(F.col("__t") * F.col("__t")).over(w) - own2).cast("double")
    mean = F.try_divide(s, n)
    var = F.when(n >= 3, F.try_divide(s2 - s * s / n, n - 1.0))
    sd = F.when(var > 0, F.sqrt(var))
    z = F.try_divide(F.col("__t").cast("double") - mean, sd)
    out = df.select(*panel.columns, F.round(mean / 10.0, 4).alias("history_mean_pct"),
                    F.round(z, 4).alias("z_score"))
    return out.withColumn("is_anomaly", F.coalesce(F.abs("z_score") > z_threshold, F.lit(False)))


def feature_order(features: DataFrame) -> DataFrame:
    """Features in the order a training set is read in: month, provider, specialty."""
    return features.orderBy("period_date", *ENTITY)


def entity_series(panel: DataFrame, provider_org_code: str, treatment_function_code: str) -> DataFrame:
    """One trust x specialty time series (e.g. to inspect a forecast)."""
    return (panel.filter((F.col("provider_org_code") == provider_org_code) &
                         (F.col("treatment_function_code") == treatment_function_code))
            .orderBy("period_date"))
