"""Waiting-time distribution operators over the week bands.

* ``band_long`` unpivots the band columns into (keys, week, patients) rows.
  Aggregate to the wanted grain **before** unpivoting: the unpivot multiplies
  rows by the number of bands.
* ``distribution_stats`` gives, per grain row, the band total, the median
  wait (band midpoints), quartile shares and the Gini coefficient, from
  running sums over the bands of a row.  Sums use integers (midpoints doubled:
  2i+1), so results do not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BANDS, BandSpec


def aggregate_bands(df: DataFrame, grain, bands: BandSpec = BANDS) -> DataFrame:
    """Sum each band column to ``grain`` (partial aggregation map-side)."""
    return df.groupBy(*grain).agg(*[F.expr(f"cast(sum({n}) as bigint) as {n}") for n in bands.names()])


def band_long(df: DataFrame, keys, bands: BandSpec = BANDS, drop_zero: bool = False) -> DataFrame:
    """Wide bands -> rows (keys..., week, patients); week = band index."""
    stacked = ", ".join(f"{i}, {n}" for i, n in enumerate(bands.names()))
    out = df.select(*keys, F.expr(f"stack({bands.count}, {stacked}) as (week, patients)"))
    out = out.withColumn("week", F.col("week").cast("bigint")).withColumn("patients", F.col("patients").cast("bigint"))
    return out.filter(F.col("patients") != 0) if drop_zero else out


def quartile_shares(df: DataFrame, bands: BandSpec = BANDS, cuts=(26, 52, 78)) -> DataFrame:
    """Share of patients waiting in weeks [0,26), [26,52), [52,78), [78,..)
    (row-local band sums; NULL when the row has no patients)."""
    edges = [0, *cuts, None]
    tot = F.expr(" + ".join(bands.names()))
    cols = []
    for q, (lo, hi) in enumerate(zip(edges[:-1], edges[1:]), start=1):
        s = F.expr(" + ".join(bands.names_between(lo, hi)))
        cols.append(F.try_divide(s.cast("double"), tot.cast("double")).alias(f"share_q{q}"))
    return df.select("*", *cols)


#: Patients in a group up to which the Gini numerator (at most 210 n^2) surely fits 64 bits.
_SMALL = 100_000_000


#: Bands whose sums are carried together.
_BLOCK = 7


def _blocks(bands: BandSpec) -> list[list[int]]:
    return [list(range(lo, min(lo + _BLOCK, bands.count))) for lo in range(0, bands.count, _BLOCK)]


def _running(df: DataFrame, bands: BandSpec) -> DataFrame:
    """``df`` with, for each block of bands, patients (``__c<k>``) and doubled
    waiting time (``__w<k>``) of all bands before it, and both over all bands as
    the last pair.  Sums of blocks first, then sums of those: two narrow
    projections of plain additions instead of a fold over an array."""
    names, blocks = bands.names(), _blocks(bands)
    own = df.select("*", *[F.expr(" + ".join(names[i] for i in b)).alias(f"__s{k}") for k, b in enumerate(blocks)],
                    *[F.expr(" + ".join(f"{names[i]} * {2 * i + 1}" for i in b)).alias(f"__t{k}") for k, b in enumerate(blocks)])
    upto = lambda name, k: F.expr(" + ".join(f"{name}{j}" for j in range(k)) or "0L")
    return own.select(*df.columns, *[upto("__s", k).alias(f"__c{k}") for k in range(len(blocks) + 1)],
                      *[upto("__t", k).alias(f"__w{k}") for k in range(len(blocks) + 1)])


def _median_sql(bands: BandSpec) -> str:
    """First band up to which half of the patients (``n``) wait: the block by its
    running sum, then the band inside it."""
    names, blocks, whens = bands.names(), _blocks(bands), []
    for k, b in enumerate(blocks):
        inner = " ".join(f"when 2 * (__c{k} + {' + '.join(names[j] for j in b[:m + 1])}) >= n then {i}" for m, i in enumerate(b))
        whens.append(f"when 2 * __c{k + 1} >= n then case {inner} end")
    return f"case when n > 0 then case {' '.join(whens)} end end"


def _gini_sql(bands: BandSpec) -> str:
    """Sum over bands of p * (2 * waiting time before the band + p * (2i + 1))."""
    names, terms = bands.names(), []
    for k, b in enumerate(_blocks(bands)):
        for m, i in enumerate(b):
            before = " + ".join([f"__w{k}", *[f"{names[j]} * {2 * j + 1}" for j in b[:m]]])
            terms.append(f"{names[i]} * (2 * ({before}) + {names[i]} * {2 * i + 1})")
    return " + ".join(terms)


def _wide_gini_sql(bands: BandSpec) -> str:
    """The same in 38 digits, by a fold over the bands: slow, for groups of
    ``_SMALL`` patients and more."""
    return f"""aggregate(transform(array({", ".join(bands.names())}), (x, i) -> named_struct('p', x, 'i', i)),
 named_struct('cw', cast(0 as bigint), 'g', cast(0 as decimal(38,0))),
 (acc, e) -> named_struct('cw', acc.cw + e.p * (2 * e.i + 1),
   'g', cast(acc.g + cast(e.p as decimal(18,0)) * cast(2 * acc.cw + e.p * (2 * e.i + 1) as decimal(19,0)) as decimal(38,0))),
 acc -> cast(acc.g as double))"""


def distribution_stats(df: DataFrame, grain, bands: BandSpec = BANDS) -> DataFrame:
    """Per grain: band total, median wait (weeks, band midpoint), Gini of the
    wait distribution and quartile shares.

    ``df`` is aggregated to ``grain`` (partial sums map-side); everything
    after is row-local: running sums by blocks of bands, no unpivot, no window
    sort.  Gini on grouped data: G = 1 - sum_i f_i (S_{i-1} + S_i),
    f the patient share of band i and S the cumulative share of waiting time
    at band midpoints; with doubled midpoints (2i+1) all sums are exact
    integers and one division happens at the end.
    """
    grain = list(grain)
    agg = aggregate_bands(df, grain, bands)
    agg = agg.withColumn("n", F.expr(" + ".join(bands.names())))
    r = _running(agg, bands)
    last = len(_blocks(bands))
    shares = quartile_shares(r, bands)
    total, weight = F.col("n").cast("double"), F.col(f"__w{last}").cast("double")
    # the numerator is at most 210 n^2: where that may not fit 64 bits, 38 digits
    g = F.when(F.col("n") < _SMALL, F.expr(_gini_sql(bands)).cast("double")).otherwise(F.expr(_wide_gini_sql(bands)))
    return shares.select(
        *grain, "share_q1", "share_q2", "share_q3", "share_q4", "n",
        (F.expr(_median_sql(bands)).cast("double") + F.lit(0.5)).alias("median_wait_weeks"),
        F.when((F.col("n") > 0) & (F.col(f"__w{last}") > 0), F.lit(1.0) - g / (total * weight)).alias("wait_gini"),
    )
