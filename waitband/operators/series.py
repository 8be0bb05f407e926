"""Month series per entity: exact change-point detection and exponential
smoothing with rolling-origin error.

Each entity's months are gathered in one array (bounded by the number of
months), and a fold over it gives the answer inside the row: no Python, no window
sort, one shuffle for the grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import ENTITY

#: What a change must lower the sum of squared deviations by (percentage points squared).
PENALTY = 25.0
ALPHAS = tuple(a / 10 for a in range(1, 10))
#: Digits that totals are compared by, so that equal ones stay equal whatever the order of sums.
DIGITS = 6


def gathered(panel: DataFrame, value: str, entity=ENTITY, period_col: str = "period_date") -> DataFrame:
    """(entity..., periods, values): each entity's months in order, those without
    a value left out."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(period_col).alias("p"), F.col(value).cast("double").alias("v"))))
    g = panel.filter(F.col(value).isNotNull()).groupBy(*entity).agg(pairs.alias("__s"))
    return g.select(*entity, F.col("__s.p").alias("periods"), F.col("__s.v").alias("values"))


def _segment_starts(values: Column, penalty: float, least: int) -> Column:
    """Where the segments of the best cut begin, from 0, rising.

    Dynamic programming: the best cut of the first t months ends with a segment
    [s, t) for the s that lowers best(s) + deviation(s, t) + penalty most (ties:
    the smallest s); a segment has ``least`` months or more.  Deviations come from
    running sums, which the fold carries along with the best totals."""
    zero = F.lit(0.0)
    start = F.struct(F.array(zero).alias("sum"), F.array(zero).alias("square"), F.array(F.lit(-penalty)).alias("best"),
                     F.array(F.array().cast("array<int>")).alias("cuts"))

    def step(a: Column, v: Column) -> Column:
        t = F.size(a["sum"])  # months read with this one
        total = F.element_at(a["sum"], -1) + v
        square = F.element_at(a["square"], -1) + v * v

        def ending_from(s: Column) -> Column:
            n = (t - s).cast("double")
            x = total - F.get(a["sum"], s)
            cost = square - F.get(a["square"], s) - x * x / n
            best = F.get(a["best"], s) + cost + F.lit(penalty)
            return F.struct(F.when(best.isNotNull(), F.round(best, DIGITS)).alias("key"), s.alias("s"), best.alias("best"))

        found = F.filter(F.transform(F.sequence(F.lit(0), F.greatest(t - least, F.lit(0))), ending_from), lambda e: e["key"].isNotNull())
        won = F.when(t >= least, F.get(F.array_sort(found), F.lit(0)))
        cuts = F.when(won.isNotNull(), F.concat(F.get(a["cuts"], won["s"]), F.array(won["s"])))
        return F.struct(F.concat(a["sum"], F.array(total)).alias("sum"), F.concat(a["square"], F.array(square)).alias("square"),
                        F.concat(a["best"], F.array(won["best"])).alias("best"), F.concat(a["cuts"], F.array(cuts)).alias("cuts"))

    return F.aggregate(values, start, step, lambda a: F.element_at(a["cuts"], -1))


def change_points(panel: DataFrame, value: str = "pct_within_18_weeks", penalty: float = PENALTY, least: int = 2, entity=ENTITY,
                  period_col: str = "period_date") -> DataFrame:
    """A row per level shift: the month it begins, the means of the segments
    before and after it, and their difference.  The cut of a series is the one
    that least deviates from its segments' means, each change costing
    ``penalty``; it is exact, not greedy."""
    rows = gathered(panel, value, entity, period_col)
    rows = rows.filter(F.size("values") >= 2 * least).withColumn("starts", _segment_starts(F.col("values"), penalty, least))
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("values")))
    mean = lambda s, e: F.aggregate(F.slice("values", s + 1, e - s), F.lit(0.0), lambda a, v: a + v) / (e - s).cast("double")
    parts = F.zip_with("starts", ends, lambda s, e: F.struct(s.alias("s"), mean(s, e).alias("m")))
    rows = rows.withColumn("parts", parts).select(*entity, "periods", "parts", F.explode(F.sequence(F.lit(1), F.size("parts"))).alias("k"))
    here, before = F.get("parts", F.col("k") - 1), F.get("parts", F.col("k") - 2)
    return rows.filter("k > 1").select(
        *entity, F.get("periods", here["s"]).alias(period_col), F.round(before["m"], 4).alias("mean_before"), F.round(here["m"], 4).alias("mean_after"),
        F.round(here["m"] - before["m"], 4).alias("shift"))


def smoothing_forecast(panel: DataFrame, value: str = "total_incomplete", alphas=ALPHAS, horizon: int = 3, least: int = 4, entity=ENTITY,
                       period_col: str = "period_date") -> DataFrame:
    """Exponential smoothing per entity: for each ``alpha`` every month but the
    first is forecast from those before it (rolling origin), and the alpha with
    the least mean absolute error (ties: the smallest) forecasts the next
    ``horizon`` months.  Series of fewer than ``least`` months are left out."""
    rows = gathered(panel, value, entity, period_col).filter(F.size("values") >= least)

    def tried(alpha: Column) -> Column:
        start = F.struct(F.get("values", F.lit(0)).alias("level"), F.lit(0.0).alias("off"))
        rest = F.slice("values", 2, F.size("values"))
        end = F.aggregate(rest, start, lambda a, v: F.struct((a["level"] + alpha * (v - a["level"])).alias("level"), (a["off"] + F.abs(v - a["level"])).alias("off")))
        mae = end["off"] / (F.size("values") - 1).cast("double")
        return F.named_struct(F.lit("mae"), F.round(mae, DIGITS), F.lit("alpha"), alpha, F.lit("level"), F.round(end["level"], DIGITS))

    best = F.array_min(F.transform(F.array(*[F.lit(a) for a in alphas]), tried))
    rows = rows.select(*entity, F.element_at("periods", -1).alias("__last"), best.alias("b"), F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    return rows.select(*entity, F.add_months("__last", F.col("h")).alias(period_col), F.col("b.alpha").alias("alpha"), F.col("b.mae").alias("mae"),
                       F.col("b.level").alias("forecast"))
