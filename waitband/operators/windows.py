"""Generic window operators (share of partition, period-on-period change,
lagged rolling means, calendar-gated leads).

They are meant to run on aggregated rows (one row per entity per period),
where each window partition holds at most #periods rows.  An un-partitioned
window (national series) moves all rows to one task, so call it only on
month-level aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_of_partition(df: DataFrame, value_col: str, partition_cols, alias: str = "pct_of_total",
                       digits: int = 1) -> DataFrame:
    w = Window.partitionBy(*partition_cols)
    share = F.col(value_col).cast("double") * 100.0 / F.sum(value_col).over(w).cast("double")
    return df.withColumn(alias, F.round(share, digits))


def period_change(df: DataFrame, value_col: str, order_col: str, partition_cols=(), digits: int = 2,
                  change_alias: str = "change", pct_alias: str = "pct_change") -> DataFrame:
    """``x - lag(x)`` and ``round((x - lag) * 100 / lag, digits)`` (NULL when lag is 0/NULL)."""
    w = Window.partitionBy(*partition_cols).orderBy(order_col) if partition_cols else Window.orderBy(order_col)
    prev = F.lag(value_col).over(w)
    change = F.col(value_col) - prev
    return df.select("*", change.alias(change_alias),
                     F.round(F.try_divide(change.cast("double") * 100.0, prev.cast("double")), digits).alias(pct_alias))


def lagged_rolling_mean(value_col: str, partition_cols, order_col: str, n: int = 3, tenths: bool = True) -> Column:
    """Mean of the ``n`` previous rows, NULL until ``n`` prior non-null rows
    exist (like ``shift(1).rolling(n).mean()``).  With ``tenths`` the values
    carry one decimal and are averaged as exact integer tenths."""
    w = Window.partitionBy(*partition_cols).orderBy(order_col).rowsBetween(-n, -1)
    v = F.col(value_col)
    if tenths:
        s = F.sum(F.round(v * 10).cast("bigint")).over(w).cast("double") / F.lit(10.0 * n)
    else:
        s = F.avg(v).over(w)
    return F.when(F.count(v).over(w) == n, s)


def lag_diff(value_col: str, partition_cols, order_col: str) -> Column:
    w = Window.partitionBy(*partition_cols).orderBy(order_col)
    return F.col(value_col) - F.lag(value_col).over(w)


def next_period_value(value_col: str, partition_cols, period_col: str, months: int = 1) -> Column:
    """Value of the next row only if it is exactly ``months`` later (gaps in
    submissions are not bridged)."""
    w = Window.partitionBy(*partition_cols).orderBy(period_col)
    nxt_p = F.lead(period_col).over(w)
    return F.when(nxt_p == F.add_months(F.col(period_col), months), F.lead(value_col).over(w))
