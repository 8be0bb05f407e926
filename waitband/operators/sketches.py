"""Stored sketches that merge: waiting times (KLL) and distinct counts (HLL,
theta), one row per month and group, so that history and roll-ups are answered
from the sketches without reading the months again.

* ``wait_sketches`` keeps a KLL sketch of the week waited per group; any roll-up
  merges them (``roll_up_waits``) and reads medians and other quantiles.  A
  quantile's rank is off by at most ``rank_error(k)`` with 99 % probability; a
  group of fewer than ``k`` patients is exact.
* ``distinct_sketches`` keeps, per month, HLL sketches (counts over any set of
  months) and theta sketches (also what two months share) of entity columns.

A sketch table is partitioned by month and written with ``store``: a revised
month replaces its own sketches and no other month is touched or read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BANDS, BandSpec
from .distribution import aggregate_bands, band_long
from .load import month_overwrite

#: Size of the KLL sketches and log2 of that of the distinct sketches.
WAIT_K, DISTINCT_LG_K = 400, 12
#: Patients that one generated array stands for.
_CHUNK = 10_000


def rank_error(k: int = WAIT_K) -> float:
    """99 % bound of a quantile's rank error, as a share of all patients (the
    published fit for KLL sketches)."""
    return 2.296 / k ** 0.9021


def distinct_error(lg_k: int = DISTINCT_LG_K) -> float:
    """Three standard errors of a distinct count, as a share of it."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def wait_sketches(df: DataFrame, grain, bands: BandSpec = BANDS, k: int = WAIT_K) -> DataFrame:
    """(grain..., patients, wait_sketch): rows are summed to ``grain`` first; then
    each group's patients pass through its sketch one by one, from generators
    that hold ``_CHUNK`` of them at a time.  Groups without patients have no row."""
    grain = list(grain)
    counts = band_long(aggregate_bands(df, grain, bands), grain, bands).filter("patients > 0")
    parts = counts.select(*grain, "week", "patients", F.explode(F.sequence(F.lit(0), F.expr(f"(patients - 1) div {_CHUNK}"))).alias("__part"))
    size = F.least(F.lit(_CHUNK), F.col("patients") - F.col("__part") * _CHUNK)
    each = parts.select(*grain, "week", F.explode(F.sequence(F.lit(1).cast("bigint"), size)))
    return each.groupBy(*grain).agg(F.count(F.lit(1)).cast("bigint").alias("patients"), F.kll_sketch_agg_bigint("week", F.lit(k)).alias("wait_sketch"))


def distinct_sketches(df: DataFrame, grain, columns, lg_k: int = DISTINCT_LG_K) -> DataFrame:
    """(grain..., rows, and for each column its non-null rows, HLL and theta
    sketch): ``n_<c>``, ``hll_<c>``, ``theta_<c>``.  Nulls are not counted."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("rows")]
    for c in columns:
        aggs += [F.count(c).cast("bigint").alias(f"n_{c}"), F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"hll_{c}"),
                 F.theta_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"theta_{c}")]
    return df.groupBy(*grain).agg(*aggs)


def store(sketches: DataFrame, path: str, month_col: str = "period_date") -> None:
    """Replace the months that ``sketches`` holds; other months stay."""
    month_overwrite(sketches, path, month_col)


def roll_up_waits(sketches: DataFrame, by, quantiles: dict[str, float], k: int = WAIT_K) -> DataFrame:
    """(by..., patients, one week per named quantile) of stored wait sketches,
    merged to ``by`` (partial merges map-side)."""
    g = sketches.groupBy(*by) if by else sketches.groupBy()
    merged = g.agg(F.sum("patients").alias("patients"), F.kll_merge_agg_bigint("wait_sketch", F.lit(k)).alias("__s"))
    return merged.select(*by, "patients", *[F.kll_sketch_get_quantile_bigint("__s", F.lit(q)).alias(name) for name, q in quantiles.items()])


def roll_up_distinct(sketches: DataFrame, by, columns) -> DataFrame:
    """(by..., rows, for each column ``n_<c>`` and ``distinct_<c>``) over any set
    of stored months."""
    g = sketches.groupBy(*by) if by else sketches.groupBy()
    aggs = [F.sum("rows").cast("bigint").alias("rows")]
    for c in columns:
        aggs += [F.sum(f"n_{c}").cast("bigint").alias(f"n_{c}"), F.hll_sketch_estimate(F.hll_union_agg(f"hll_{c}")).cast("bigint").alias(f"distinct_{c}")]
    return g.agg(*aggs)


def month_overlap(sketches: DataFrame, column: str, month_col: str = "period_date") -> DataFrame:
    """Per month: values also seen in the month before (``stayed``), those not
    seen then (``came``) and those of then not seen now (``left``); NULL for a
    month without a month before.  A row per month enters the join."""
    theta = f"theta_{column}"
    months = sketches.groupBy(month_col).agg(F.theta_union_agg(theta).alias("__now"))
    before = months.select(F.add_months(month_col, 1).alias(month_col), F.col("__now").alias("__then"))
    n = lambda c: F.theta_sketch_estimate(c).cast("bigint")
    return months.join(before, month_col, "left").select(
        month_col, n(F.theta_intersection("__now", "__then")).alias("stayed"), n(F.theta_difference("__now", "__then")).alias("came"),
        n(F.theta_difference("__then", "__now")).alias("left"))


def band_quantile(q: float, n: Column | str = "n", bands: BandSpec = BANDS) -> Column:
    """Exact quantile of a row of bands: the first week up to which at least
    ``q`` of the row's patients wait; NULL without patients."""
    total = F.col(n) if isinstance(n, str) else n
    cells = F.array(*[F.struct(F.col(b).alias("p"), F.lit(i).alias("i")) for i, b in enumerate(bands.names())])
    start = F.struct(F.lit(0).cast("bigint").alias("cum"), F.lit(None).cast("int").alias("hit"))

    def step(acc, e):
        cum = acc["cum"] + e["p"]
        there = acc["hit"].isNull() & (total > 0) & (cum.cast("double") >= F.lit(q) * total.cast("double"))
        return F.struct(cum.alias("cum"), F.when(there, e["i"]).otherwise(acc["hit"]).alias("hit"))

    return F.aggregate(cells, start, step, lambda acc: acc["hit"]).cast("bigint")


def rank_within(week: Column | str, q: float, error: float, n: Column | str = "n", bands: BandSpec = BANDS) -> Column:
    """Is ``week`` a ``q`` quantile of the row's bands, give or take ``error`` of
    the patients in rank?"""
    w = F.col(week) if isinstance(week, str) else week
    total = (F.col(n) if isinstance(n, str) else n).cast("double")
    cells = F.array(*[F.col(b) for b in bands.names()])
    upto = lambda k: F.aggregate(F.slice(cells, 1, k), F.lit(0).cast("bigint"), lambda a, p: a + p).cast("double")
    i = w.cast("int")
    return (upto(i) <= F.lit(q + error) * total) & (upto(i + 1) >= F.lit(q - error) * total)
