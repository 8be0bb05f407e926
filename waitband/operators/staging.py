"""Staging: typed, renamed, null-normalised view over the raw extract.

One output row per input row; no filter, join or aggregation.  Counts may
arrive as strings (CSV), doubles (``12.0``) or integers; they are cast via
double with ``try_cast`` so dirty cells (``*`` suppression, blanks) become
NULL and then 0, instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (BANDS, NATIONAL_PARENT_CODE, NATIONAL_PARENT_NAME, SOURCE_LABEL,
                      UNKNOWN_COMMISSIONER_NAME, BandSpec)
from ..functions.calendar import financial_year, parse_period

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def count_sql(dtype: T.DataType, name: str) -> str:
    """SQL expression casting a raw count column to bigint by input type."""
    c = f"`{name}`"
    if isinstance(dtype, _NUMERIC):
        return f"cast({c} as bigint)"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"try_cast(nanvl({c}, null) as bigint)"
    if isinstance(dtype, T.DecimalType):
        return f"try_cast({c} as bigint)"
    # strings: '12', '12.0', ' 7 ', '*', ''
    return f"try_cast(try_cast(trim(cast({c} as string)) as double) as bigint)"


def to_count(df: DataFrame, name: str) -> Column:
    """Cast a raw count column to bigint according to its input type."""
    return F.expr(count_sql(df.schema[name].dataType, name))


def staging(raw: DataFrame, loaded_at=None, source: str = SOURCE_LABEL,
            bands: BandSpec = BANDS) -> DataFrame:
    """Rename 121 raw columns to snake_case, parse the period, derive the
    financial year, default commissioner attributes and zero-fill bands."""
    r = lambda n: F.col(f"`{n}`")
    loaded = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    period_date = parse_period(r("Period"))
    cols = [
        loaded.alias("_loaded_at"),
        F.lit(source).alias("_source"),
        r("Period").alias("period_raw"),
        period_date.alias("period_date"),
        financial_year(period_date).alias("financial_year"),
        r("Provider Parent Org Code").alias("provider_parent_org_code"),
        r("Provider Parent Name").alias("provider_parent_name"),
        r("Provider Org Code").alias("provider_org_code"),
        r("Provider Org Name").alias("provider_org_name"),
        F.coalesce(r("Commissioner Parent Org Code"), F.lit(NATIONAL_PARENT_CODE)).alias("commissioner_parent_org_code"),
        F.coalesce(r("Commissioner Parent Name"), F.lit(NATIONAL_PARENT_NAME)).alias("commissioner_parent_name"),
        r("Commissioner Org Code").alias("commissioner_org_code"),
        F.coalesce(r("Commissioner Org Name"), F.lit(UNKNOWN_COMMISSIONER_NAME)).alias("commissioner_org_name"),
        r("RTT Part Type").alias("rtt_part_type"),
        r("RTT Part Description").alias("rtt_part_description"),
        r("Treatment Function Code").alias("treatment_function_code"),
        r("Treatment Function Name").alias("treatment_function_name"),
        to_count(raw, "Total All").alias("total_all"),
        F.coalesce(to_count(raw, "Total"), F.lit(0).cast("bigint")).alias("total_pathways"),
        F.coalesce(to_count(raw, "Patients with unknown clock start date"),
                   F.lit(0).cast("bigint")).alias("patients_unknown_clock_start"),
    ]
    schema = {f.name: f.dataType for f in raw.schema.fields}
    cols += [F.expr(f"coalesce({count_sql(schema[bands.raw_name(i)], bands.raw_name(i))}, 0L) as {bands.name(i)}")
             for i in range(bands.count)]
    # audit columns added by the loader are carried through when present
    for audit in ("_month_code", "_is_revised", "_financial_year", "_source_file"):
        if audit in raw.columns:
            cols.append(F.col(audit))
    return raw.select(*cols)

