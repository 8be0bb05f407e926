"""Queries served from state that is kept per month (sketches, suite states,
maintained roll-ups): every month is published, then a revised January that
leaves one commissioner out, and the answers come from the state alone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BANDS, raw_columns
from ..functions.calendar import month_code, parse_period
from ..operators import features as FE
from ..operators import load as LD
from ..operators import models as MD
from ..operators import quality as DQ
from ..operators import rollup as RU
from ..operators import scd2 as SCD
from ..operators import series as SE
from ..operators import sketches as SK
from ..operators.distribution import aggregate_bands
from ..operators.fact import fact_performance
from ..operators.pathways import incomplete_pathways
from ..operators.staging import staging
from ..session import freed_shuffles, scratch_path, unsorted_write
from ..sources.tables import table
from ..streaming import completeness as CO
from . import pipeline as P
from . import published as Q

REVISED, REVISED_DATE, LEFT_OUT = "RTT-January-2026", dt.date(2026, 1, 1), "C40"
QUANTILES = {"median_week": 0.5, "p92_week": 0.92}


def revised_raw(spark: SparkSession, d: str) -> DataFrame:
    """The raw extract after the revision."""
    gone = (F.col("Period") == REVISED) & (F.col("Commissioner Org Code") == LEFT_OUT)
    return P.raw(spark, d).filter(~F.coalesce(gone, F.lit(False)))


def revised_january(spark: SparkSession, d: str) -> DataFrame:
    return revised_raw(spark, d).filter(F.col("Period") == REVISED)


def _part2(raw: DataFrame) -> DataFrame:
    return staging(raw, loaded_at=P.loaded_at_literal()).filter(F.col("rtt_part_type") == "Part_2")


def _fact(raw: DataFrame) -> DataFrame:
    return fact_performance(incomplete_pathways(staging(raw, loaded_at=P.loaded_at_literal())))


LEVELS = {
    "national": ["period_date"],
    "board": ["period_date", "provider_parent_org_code"],
    "specialty": ["period_date", "treatment_function_code"],
    "board_history": ["provider_parent_org_code"],
    "history": [],
}


def wait_sketch_rollups(spark: SparkSession, d: str) -> DataFrame:
    """Median and 92nd percentile wait of five roll-ups, each from the stored
    sketches of (month, provider, specialty), beside the exact weeks; the flags
    say whether the sketch's week is within the error bound in rank."""
    grain = ["period_date", "provider_parent_org_code", "provider_org_code", "treatment_function_code"]
    path = scratch_path(spark, "wait-sketches")
    SK.store(SK.wait_sketches(_part2(P.raw(spark, d)), grain), path)
    SK.store(SK.wait_sketches(_part2(revised_january(spark, d)), grain), path)
    stored = spark.read.parquet(path)
    rows = _part2(revised_raw(spark, d))
    # the exact band sums once, at the finest level that all others add up from
    exact_path = scratch_path(spark, "exact-bands")
    aggregate_bands(rows, ["period_date", "provider_parent_org_code", "treatment_function_code"]).write.parquet(exact_path)
    fine = spark.read.parquet(exact_path)
    out = []
    for level, by in LEVELS.items():
        told = SK.roll_up_waits(stored, by, QUANTILES)
        n = F.expr(" + ".join(BANDS.names()))
        exact = aggregate_bands(fine, by).withColumn("n", n).filter("n > 0").select(*[F.col(b).alias(f"__{b}") for b in by], "n", *BANDS.names())
        on = [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by] or [F.col("patients") >= 0]
        j = exact.join(told, on) if by else exact.join(F.broadcast(told), on)  # one row each
        key = next((b for b in by if b != "period_date"), None)
        out.append(j.select(
            F.lit(level).alias("level"), (F.col("period_date") if "period_date" in by else F.lit(None).cast("date")).alias("period_date"),
            (F.col(key) if key else F.lit(None).cast("string")).alias("entity"), F.col("n").alias("patients"), (F.col("patients") == F.col("n")).alias("all_seen"),
            *[c for name, q in QUANTILES.items() for c in (SK.band_quantile(q).alias(f"exact_{name}"),
                                                           SK.rank_within(name, q, 2 * SK.rank_error()).alias(f"{name}_in_bound"))]))
    first, *rest = out
    for r in rest:
        first = first.unionByName(r)
    return first


ENTITIES = ["provider_org_code", "provider_parent_org_code", "treatment_function_code"]


def _entity_sketches(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "entity-sketches")
    SK.store(SK.distinct_sketches(_fact(P.raw(spark, d)), ["period_date"], ENTITIES), path)
    SK.store(SK.distinct_sketches(_fact(revised_january(spark, d)), ["period_date"], ENTITIES), path)
    return spark.read.parquet(path)


def profile_from_sketches(spark: SparkSession, d: str) -> DataFrame:
    """Rows and distinct entities per month and over the whole history from the
    stored sketches, with the exact counts beside and whether each is in bound."""
    stored = _entity_sketches(spark, d)
    fact = _fact(revised_raw(spark, d)).select("period_date", *ENTITIES)
    seen = fact.groupBy("period_date", *ENTITIES).agg(F.count(F.lit(1)).alias("__n"))
    out = []
    for by in (["period_date"], []):
        told = SK.roll_up_distinct(stored, by, ENTITIES)
        aggs = [F.sum("__n").cast("bigint").alias("__rows"), *[F.countDistinct(c).cast("bigint").alias(f"exact_{c}") for c in ENTITIES]]
        exact = (seen.groupBy(*by) if by else seen.groupBy()).agg(*aggs)
        exact = exact.withColumnRenamed("period_date", "__period") if by else exact
        j = exact.join(told, F.col("period_date") == F.col("__period")) if by else exact.join(F.broadcast(told), F.col("rows") >= 0)  # one row each
        ok = lambda c: (F.abs(F.col(f"distinct_{c}") - F.col(f"exact_{c}")) <= F.lit(SK.distinct_error()) * F.col(f"exact_{c}")).alias(f"{c}_in_bound")
        out.append(j.select((F.col("period_date") if by else F.lit(None).cast("date")).alias("period_date"), "rows",
                            (F.col("rows") == F.col("__rows")).alias("rows_exact"), *[f"exact_{c}" for c in ENTITIES], *[ok(c) for c in ENTITIES]))
    return out[0].unionByName(out[1])


def providers_across_months(spark: SparkSession, d: str) -> DataFrame:
    """Provider x specialty pairs that stayed, came and left from month to month:
    theta sketches intersected and subtracted, with the exact numbers beside."""
    pair = F.concat_ws("|", "provider_org_code", "treatment_function_code").alias("pair")
    path = scratch_path(spark, "pair-sketches")
    for raw in (P.raw(spark, d), revised_january(spark, d)):
        SK.store(SK.distinct_sketches(_fact(raw).select("period_date", pair), ["period_date"], ["pair"]), path)
    told = SK.month_overlap(spark.read.parquet(path), "pair")
    seen = _fact(revised_raw(spark, d)).select("period_date", pair).distinct()
    before = seen.select(F.add_months("period_date", 1).alias("period_date"), "pair").join(
        seen.select("period_date").distinct(), "period_date", "left_semi")
    both = seen.withColumn("now", F.lit(1)).join(before.withColumn("then", F.lit(1)), ["period_date", "pair"], "full")
    count = lambda c, name: F.sum(c.cast("int")).cast("bigint").alias(name)
    now, then = F.col("now").isNotNull(), F.col("then").isNotNull()
    exact = both.groupBy("period_date").agg(count(now & then, "exact_stayed"), count(now & ~then, "exact_came"), count(~now & then, "exact_left"))
    bound = F.lit(SK.distinct_error()) * (F.col("exact_stayed") + F.col("exact_came") + F.col("exact_left"))
    ok = [(F.abs(F.col(c) - F.col(f"exact_{c}")) <= bound).alias(f"{c}_in_bound") for c in ("stayed", "came", "left")]
    return told.filter("stayed is not null").join(exact, "period_date").select("period_date", "exact_stayed", "exact_came", "exact_left", *ok)


def _suite_states(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, list]:
    rules, path = DQ.raw_extract_rules(), scratch_path(spark, "suite-states")
    raw = P.raw(spark, d)
    for rows in (raw, revised_january(spark, d)):
        keyed = rows.withColumn("_state_month", F.col("Period"))
        DQ.store_states(DQ.suite_states(keyed, rules, by=["_state_month"]), path, "_state_month")
    return spark.read.parquet(path), raw, rules


def dq_suite_from_states(spark: SparkSession, d: str) -> DataFrame:
    """The whole history's suite after a late revision, from the months' states."""
    states, raw, rules = _suite_states(spark, d)
    return DQ.fold_states(states, raw, rules)


def dq_suite_from_states_by_month(spark: SparkSession, d: str) -> DataFrame:
    states, raw, rules = _suite_states(spark, d)
    return DQ.fold_states(states, raw, rules, by=["_state_month"]).withColumnRenamed("_state_month", "Period")


def _rolled_up(spark: SparkSession, d: str) -> str:
    """All months published, January revised, and the first month withdrawn and
    published again."""
    base = scratch_path(spark, "rollup")
    fact = _fact(P.raw(spark, d))
    months = [dt.date(2025, m, 1) for m in range(8, 13)] + [REVISED_DATE]
    RU.publish(spark, base, fact, months)
    RU.publish(spark, base, _fact(revised_january(spark, d)), [REVISED_DATE])
    RU.publish(spark, base, fact.limit(0), months[:1])
    RU.publish(spark, base, fact.filter(F.col("period_date") == months[0]), months[:1])
    return base


def _landed_in_parts(spark: SparkSession, d: str) -> str:
    """Every month in three parts over two runs (a third of January is late), then
    January once more as a complete revision, whose first part had come early."""
    base = scratch_path(spark, "parts")
    where = (f"{base}/landing", f"{base}/table", f"{base}/checkpoint")
    keyed = P.raw(spark, d).withColumn("_month_code", month_code(parse_period(F.col("Period"))))
    base_rows = scratch_path(spark, "parts-rows")
    with unsorted_write(spark), freed_shuffles(spark):
        keyed.withColumn("__part", F.pmod(F.xxhash64("Provider Org Code"), F.lit(3)).cast("int") + 1).write.partitionBy("__part").parquet(base_rows)
    rows = spark.read.parquet(base_rows)
    months = [r[0] for r in rows.select("_month_code").distinct().collect()]  # six
    part = lambda df, k: df.filter(F.col("__part") == k).drop("__part")
    revised = rows.filter((F.col("_month_code") == "Jan26") & ~F.coalesce(F.col("Commissioner Org Code") == LEFT_OUT, F.lit(False)))
    CO.land_part(part(rows, 1), where[0], 1, 1, 3, months=months)
    CO.land_part(part(rows, 2), where[0], 1, 2, 3, months=months)
    CO.land_part(part(revised, 1), where[0], 2, 1, 3, months=["Jan26"])
    CO.publish_available(spark, *where, P.loaded_at_literal())
    CO.land_part(part(rows, 3), where[0], 1, 3, 3, months=months)
    CO.publish_available(spark, *where, P.loaded_at_literal())
    CO.land_part(part(revised, 3), where[0], 2, 3, 3, months=["Jan26"])
    CO.land_part(part(revised, 2), where[0], 2, 2, 3, months=["Jan26"])
    CO.publish_available(spark, *where, P.loaded_at_literal())
    return where[1]


def stateful_publication(spark: SparkSession, d: str) -> DataFrame:
    """All rows of the published table, every source column as landed."""
    cols = [F.col(f"`{c}`") for c in raw_columns()]
    return spark.read.parquet(_landed_in_parts(spark, d)).select(*cols, "_month_code", "_is_revised")


def asof_latest_order(spark: SparkSession, d: str) -> DataFrame:
    """Each line's latest order of the same customer at its ship date; a third of
    all customers count as one, a hot key with thousands of versions."""
    hot = lambda c: F.when(F.col(c) % 3 == 0, F.lit(0)).otherwise(F.col(c)).cast("bigint").alias("customer")
    day = lambda c: F.to_date(c)
    orders = table(spark, d, "orders").select("o_orderkey", hot("o_custkey"), day("o_orderdate").alias("valid_from"))
    versions = orders.groupBy("customer", "valid_from").agg(F.min("o_orderkey").alias("order_key"))
    versions = versions.withColumn("valid_to", F.lit(None).cast("date"))
    lines = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), day("l_shipdate").alias("shipped"))
    facts = lines.join(orders.select("o_orderkey", "customer"), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    return SCD.asof_sorted(facts, versions, "customer", "shipped", ["order_key"])


def asof_provider_sorted(spark: SparkSession, d: str) -> DataFrame:
    """The providers' names at each fact's month, by the sorted pass."""
    attrs = ["provider_org_name", "provider_parent_org_code", "provider_parent_name"]
    history = SCD.scd2_from_history(P.stg(spark, d), "provider_org_code", attrs)
    fact = P.fact(spark, d).select("rtt_performance_id", "period_date", "provider_org_code", "provider_org_name")
    return SCD.asof_sorted(fact, history, "provider_org_code", "period_date", attrs[:2])


def breach_training_unrevised(spark: SparkSession, d: str) -> DataFrame:
    """The training rows where October's publication was a revision: the flag goes
    from the loaded rows through every layer, and October is left out."""
    raw = P.raw(spark, d).withColumn("_is_revised", F.col("Period") == "RTT-October-2025")
    return MD.breach_training_rows(FE.breach_features(FE.entity_month_panel(_fact(raw))))


def raw_csv_typed(spark: SparkSession, d: str) -> DataFrame:
    """The extract written as CSV, read back as text and typed by staging: every
    row and column."""
    path = scratch_path(spark, "raw-csv")
    P.raw(spark, d).write.option("header", True).csv(path)
    return staging(LD.read_raw_csv(spark, path), loaded_at=P.loaded_at_literal())


QUERIES = {
    "breach_training_unrevised": breach_training_unrevised,
    "raw_csv_typed": raw_csv_typed,
    "change_points": lambda spark, d: SE.change_points(FE.entity_month_panel(P.fact(spark, d))),
    "smoothing_forecast": lambda spark, d: SE.smoothing_forecast(FE.entity_month_panel(P.fact(spark, d))),
    "asof_latest_order": asof_latest_order,
    "asof_provider_sorted": asof_provider_sorted,
    "stateful_publication": stateful_publication,
    "wait_sketch_rollups": wait_sketch_rollups,
    "profile_from_sketches": profile_from_sketches,
    "providers_across_months": providers_across_months,
    "dq_suite_from_states": dq_suite_from_states,
    "dq_suite_from_states_by_month": dq_suite_from_states_by_month,
    "rollup_national_monthly": lambda spark, d: Q.national_monthly(RU.month_sums(spark, _rolled_up(spark, d))),
    "rollup_icb_monthly": lambda spark, d: Q.icb_monthly(RU.month_sums(spark, _rolled_up(spark, d))),
    "rollup_surgical_vs_medical": lambda spark, d: Q.surgical_vs_medical(RU.month_sums(spark, _rolled_up(spark, d))),
    "rollup_specialty_perf": lambda spark, d: RU.specialty_report(RU.totals(spark, _rolled_up(spark, d))),
}
