"""Banded-count metric expressions.

All sums are row-local column additions (no explode), so they stay inside
whole-stage codegen and Catalyst prunes the bands a query does not use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (BANDS, BREACH_LABELS, RAG_AMBER, RAG_GREEN, RAG_RED, RAG_UNKNOWN,
                      THRESHOLDS, BandSpec, Thresholds)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def band_sum(lo: int, hi: int | None = None, bands: BandSpec = BANDS) -> Column:
    """Sum of staging band columns ``lo <= i < hi`` (null-free after staging).

    Built as one SQL expression: a single round trip to the JVM instead of
    one per column (wide extracts otherwise spend seconds building plans)."""
    return F.expr(" + ".join(f"`{n}`" for n in bands.names_between(lo, hi)))


def safe_ratio(num, den) -> Column:
    """``num * 100 / den`` as double, NULL when ``den`` is 0 or NULL."""
    return F.try_divide(_c(num).cast("double") * F.lit(100.0), _c(den).cast("double"))


def rounded_ratio_pct(num, den, digits: int = 1) -> Column:
    return F.round(safe_ratio(num, den), digits)


def pct_within(within, total) -> Column:
    """Row percentage: NULL when total is 0, else round(within*100/total, 1)."""
    return F.when(_c(total) == 0, F.lit(None).cast("double")).otherwise(rounded_ratio_pct(within, total, 1))


def meets_standard(within, total, th: Thresholds = THRESHOLDS) -> Column:
    """Standard flag on the **unrounded** ratio (NULL when total is 0)."""
    return (F.when(_c(total) == 0, F.lit(None).cast("boolean"))
            .otherwise(safe_ratio(within, total) >= F.lit(th.standard_pct)))


def rag_status(pct, th: Thresholds = THRESHOLDS) -> Column:
    """Traffic light on the (rounded) row percentage; NULL -> Unknown."""
    p = _c(pct)
    return (F.when(p.isNull(), RAG_UNKNOWN).when(p >= th.standard_pct, RAG_GREEN)
            .when(p >= th.amber_pct, RAG_AMBER).otherwise(RAG_RED))


def ratio_status(ratio, labels=(RAG_GREEN, RAG_AMBER, RAG_RED), th: Thresholds = THRESHOLDS) -> Column:
    """Status from an unrounded ratio of sums; a NULL ratio falls to the last label."""
    r = _c(ratio)
    return F.when(r >= th.standard_pct, labels[0]).when(r >= th.amber_pct, labels[1]).otherwise(labels[2])


def breach_severity(over_104, plus_52, beyond_18) -> Column:
    return (F.when(_c(over_104) > 0, BREACH_LABELS[0]).when(_c(plus_52) > 0, BREACH_LABELS[1])
            .when(_c(beyond_18) > 0, BREACH_LABELS[2]).otherwise(BREACH_LABELS[3]))


def week_row_sum(columns, marker: str = "Weeks SUM") -> Column:
    """Per-row sum of every column whose name contains ``marker`` (raw
    names), each cast leniently and NULL counted as 0."""
    names = [c for c in columns if marker in c]
    if not names:
        return F.lit(None).cast("double")
    return F.expr(" + ".join(f"coalesce(try_cast(`{c}` as double), 0)" for c in names))
