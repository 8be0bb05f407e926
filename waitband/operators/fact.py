"""Mart: the performance fact table and its sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FACT_LABELS, THRESHOLDS, Thresholds
from ..functions.calendar import calendar_attrs
from ..functions.keys import surrogate_key
from ..functions.metrics import breach_severity, rag_status
from ..sources.seed import treatment_functions
from .pathways import CARRIED

KEY_COLUMNS = ("period_date", "provider_org_code", "commissioner_org_code", "treatment_function_code")
FACT_COLUMNS = (
    "rtt_performance_id", "period_date", "financial_year", "calendar_year", "calendar_month",
    "month_name", "month_label",
    "provider_parent_org_code", "provider_parent_name", "provider_org_code", "provider_org_name",
    "commissioner_parent_org_code", "commissioner_parent_name", "commissioner_org_code",
    "commissioner_org_name",
    "treatment_function_code", "treatment_function_name", "specialty_group", "is_surgical",
    "total_incomplete", "patients_within_18_weeks", "patients_beyond_18_weeks",
    "patients_waiting_52_plus_weeks", "patients_waiting_over_104_weeks",
    "pct_within_18_weeks", "meets_18_week_standard", "rag_status", "breach_severity",
    "_loaded_at", "_source",
)


def specialty_join(df: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """LEFT JOIN the specialty dimension on code; unmapped codes keep NULL
    group / surgical flag.

    The built-in seed is a fixed 24-row list, so it is broadcast explicitly.
    A caller-supplied seed is joined without a hint: Spark then broadcasts it
    only if its estimated size is under ``autoBroadcastJoinThreshold`` and
    falls back to a shuffle join otherwise.
    """
    if seed is None:
        dim = F.broadcast(treatment_functions(df.sparkSession)
                          .select("treatment_function_code", "specialty_group", "is_surgical"))
    else:
        dim = seed.select("treatment_function_code", "specialty_group", "is_surgical")
    return df.join(dim, "treatment_function_code", "left")


def fact_performance(int_df: DataFrame, seed: DataFrame | None = None,
                     th: Thresholds = THRESHOLDS) -> DataFrame:
    j = specialty_join(int_df, seed)
    cal = calendar_attrs("period_date")
    out = j.select(
        surrogate_key(*KEY_COLUMNS).alias("rtt_performance_id"),
        "period_date", "financial_year",
        *[v.alias(k) for k, v in cal.items()],
        "provider_parent_org_code", "provider_parent_name", "provider_org_code", "provider_org_name",
        "commissioner_parent_org_code", "commissioner_parent_name", "commissioner_org_code",
        "commissioner_org_name",
        "treatment_function_code", "treatment_function_name", "specialty_group", "is_surgical",
        "total_incomplete", "patients_within_18_weeks", "patients_beyond_18_weeks",
        "patients_waiting_52_plus_weeks", "patients_waiting_over_104_weeks",
        "pct_within_18_weeks", "meets_18_week_standard",
        rag_status("pct_within_18_weeks", th).alias("rag_status"),
        breach_severity("patients_waiting_over_104_weeks", "patients_waiting_52_plus_weeks",
                        "patients_beyond_18_weeks").alias("breach_severity"),
        "_loaded_at", "_source", *[c for c in CARRIED if c in int_df.columns],
    )
    return out


def write_fact(fact: DataFrame, path: str, cluster_by=("provider_parent_org_code", "treatment_function_code"),
               months_only: bool = False, labels: dict | None = None) -> None:
    """Sink partitioned by month, clustered within each month; a full refresh,
    or with ``months_only`` a replacement of the months present.

    Rows are range-partitioned on (month, board, specialty), so each file spans
    a narrow range of the cluster keys: readers skip whole files, and a month
    holding a third of all rows is split over many tasks.  The labels are kept
    as metadata of the key column, where every reader of the table finds them.
    """
    labels = FACT_LABELS if labels is None else labels
    keyed = fact.withMetadata("rtt_performance_id", {"labels": dict(labels)})
    (keyed.repartitionByRange("period_date", *cluster_by)
     .sortWithinPartitions("period_date", *cluster_by)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if months_only else "static")
     .partitionBy("period_date").parquet(path))


def table_labels(spark, path: str) -> dict:
    """The labels a fact table was written with."""
    return spark.read.parquet(path).schema["rtt_performance_id"].metadata.get("labels", {})
