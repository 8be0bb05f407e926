"""Intermediate model: incomplete pathways with standard-compliance metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BANDS, INCOMPLETE_PART_TYPE, SUMMARY_SPECIALTY, THRESHOLDS, BandSpec, Thresholds
from ..functions.metrics import band_sum, meets_standard, pct_within

DIMENSIONS = (
    "period_date", "financial_year",
    "provider_parent_org_code", "provider_parent_name", "provider_org_code", "provider_org_name",
    "commissioner_parent_org_code", "commissioner_parent_name", "commissioner_org_code",
    "commissioner_org_name", "treatment_function_code", "treatment_function_name",
)
#: Loader columns that go on to the mart where the rows have them.
CARRIED = ("_is_revised",)
METRICS = ("total_incomplete", "patients_within_18_weeks", "patients_beyond_18_weeks",
           "patients_waiting_52_plus_weeks", "patients_waiting_over_104_weeks",
           "pct_within_18_weeks", "meets_18_week_standard")


def incomplete_filter(stg: DataFrame, part_type: str = INCOMPLETE_PART_TYPE,
                      exclude_specialty: str = SUMMARY_SPECIALTY) -> DataFrame:
    """Incomplete pathways only, summary rows out (NULL specialty is dropped
    too, as ``!=`` is never true for NULL).  Plain column predicates so they
    push through the staging projection to the scan."""
    return stg.filter((F.col("rtt_part_type") == part_type) &
                      (F.col("treatment_function_code") != exclude_specialty))


def with_wait_metrics(df: DataFrame, th: Thresholds = THRESHOLDS, bands: BandSpec = BANDS,
                      total_col: str = "total_all") -> DataFrame:
    """Add within / beyond / 52+ / over-104 counts, pct and standard flag."""
    within = band_sum(0, th.within_weeks, bands)
    return (df
            .withColumn("patients_within_18_weeks", within)
            .withColumn("patients_beyond_18_weeks", band_sum(th.within_weeks, None, bands))
            .withColumn("patients_waiting_52_plus_weeks", band_sum(th.long_wait_weeks, None, bands))
            .withColumn("patients_waiting_over_104_weeks", F.col(bands.name(bands.n_bands)))
            .withColumn("pct_within_18_weeks", pct_within("patients_within_18_weeks", total_col))
            .withColumn("meets_18_week_standard", meets_standard("patients_within_18_weeks", total_col, th)))


def incomplete_pathways(stg: DataFrame, th: Thresholds = THRESHOLDS, bands: BandSpec = BANDS) -> DataFrame:
    m = with_wait_metrics(incomplete_filter(stg), th, bands)
    return m.select(
        *DIMENSIONS,
        F.col("total_all").alias("total_incomplete"),
        *METRICS[1:],
        "_loaded_at", "_source", *[c for c in CARRIED if c in m.columns],
    )
