"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per
operator / published query, each reading the base tables end to end."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import calendar_ops as CAL
from ..operators import load as LD
from ..operators import distribution as DI
from ..operators import features as FE
from ..operators import models as MD
from ..operators import quality as DQ
from ..operators import windows as WN
from ..operators import scd2 as SCD
from ..session import scratch_path
from ..config import CORE_SPECIALTIES, raw_columns
from ..functions.calendar import month_code, parse_period
from ..operators.fact import fact_performance
from ..operators.pathways import incomplete_pathways
from ..operators.staging import staging
from ..functions.metrics import week_row_sum
from ..operators import archive_load as AL
from ..sources import archives as AR
from ..sources import pages as PG
from ..streaming import ingest as ING
from ..sources.extract import SPECIALTY_CODES
from ..sources.tables import table
from ..operators.fact import KEY_COLUMNS
from . import fixtures as FX
from . import history as HI
from . import pipeline as P
from . import published as Q


def _fact(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(P.fact(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


QUERIES = {
    "fact_performance": lambda spark, d: P.fact(spark, d),
    "int_incomplete": lambda spark, d: P.intermediate(spark, d),
    "national_monthly": _fact(Q.national_monthly),
    "trust_league": _fact(Q.trust_league),
    "specialty_perf": _fact(Q.specialty_performance),
    "icb_monthly": _fact(Q.icb_monthly),
    "over_2_years": _fact(Q.over_two_years),
    "trust_trend": _fact(Q.trust_trend),
    "rag_distribution": _fact(Q.rag_distribution),
    "surgical_vs_medical": _fact(Q.surgical_vs_medical),
    "month_on_month": _fact(Q.month_on_month),
    "trust_scorecard": _fact(Q.trust_scorecard),
}


QUERIES.update({
    "dq_raw_suite": lambda spark, d: DQ.run_suite(P.raw(spark, d), DQ.raw_extract_rules()),
    "dq_suite_by_month": lambda spark, d: DQ.run_suite(P.raw(spark, d), DQ.raw_extract_rules(), by=["Period"]),
    "dq_gate": lambda spark, d: DQ.gate(DQ.run_suite(P.raw(spark, d), DQ.raw_extract_rules())),
    "dq_gate_by_month": lambda spark, d: DQ.gate(
        DQ.run_suite(P.raw(spark, d), DQ.raw_extract_rules(), by=["Period"]), by=["Period"]),
    "dq_staging_suite": lambda spark, d: DQ.run_suite(P.stg(spark, d), DQ.staging_rules()),
    "dq_key_unique": lambda spark, d: DQ.key_uniqueness(P.fact(spark, d), KEY_COLUMNS),
})


def _orders_bounds(spark, d):
    return table(spark, d, "orders").agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))


def _loaded_months(spark, d):
    return P.stg(spark, d).select("period_date")


def _backfill_plan(spark, d):
    spine = CAL.spine_last_n(spark.range(1).select(F.lit(P.AS_OF.date()).alias("as_of")), 24)
    return CAL.backfill_plan(spine, _loaded_months(spark, d))


def _double_load(spark, d):
    """Load every month, then reload January: the table must hold each
    month once."""
    raw = P.raw(spark, d)
    path = scratch_path(spark, "month-load")
    LD.load_months(raw, path, P.loaded_at_literal(), source_file="fixture", rebalance=False)
    LD.load_months(raw, path, P.loaded_at_literal(), months=["Jan26"], source_file="fixture", rebalance=False)
    src = LD.with_audit(raw, P.loaded_at_literal(), source_file="fixture")
    return LD.load_reconcile(src, spark.read.parquet(path))


QUERIES.update({
    "month_spine_orders": lambda spark, d: CAL.spine_between(_orders_bounds(spark, d)),
    "month_spine_lastn": lambda spark, d: CAL.spine_last_n(
        table(spark, d, "orders").agg(F.max("o_orderdate").alias("as_of")), 6),
    "backfill_plan": _backfill_plan,
    "backfill_summary": lambda spark, d: CAL.backfill_summary(_backfill_plan(spark, d)),
    "freshness_events": lambda spark, d: CAL.source_freshness(
        table(spark, d, "events"), "ts", dt.date(2024, 3, 1)),
    "month_overwrite_idempotent": _double_load,
    "load_summary": lambda spark, d: LD.load_summary(_double_load(spark, d)),
})


PROVIDER_KEY = "provider_org_code"
PROVIDER_ATTRS = ["provider_org_name", "provider_parent_org_code", "provider_parent_name"]


def _provider_history(spark, d):
    return SCD.scd2_from_history(P.stg(spark, d), PROVIDER_KEY, PROVIDER_ATTRS)


def _scd2_two_steps(spark, d):
    stg = P.stg(spark, d)
    early = SCD.latest_per_key(stg.filter(F.col("period_date") <= F.lit(dt.date(2025, 11, 1))),
                               PROVIDER_KEY, PROVIDER_ATTRS)
    snap1 = SCD.scd2_check(None, early, PROVIDER_KEY, PROVIDER_ATTRS, dt.date(2025, 12, 1))
    latest = SCD.latest_per_key(stg, PROVIDER_KEY, PROVIDER_ATTRS)
    return SCD.scd2_check(snap1, latest, PROVIDER_KEY, PROVIDER_ATTRS, dt.date(2026, 2, 1))


def _asof_provider(spark, d):
    fact = P.fact(spark, d).select("rtt_performance_id", "period_date", "provider_org_code", "provider_org_name")
    return SCD.asof_join(fact, _provider_history(spark, d), PROVIDER_KEY, "period_date",
                         ["provider_org_name", "provider_parent_org_code"])


QUERIES.update({
    "scd2_from_history": _provider_history,
    "scd2_current": lambda spark, d: SCD.current_versions(_provider_history(spark, d)),
    "scd2_check": _scd2_two_steps,
    "asof_provider_name": _asof_provider,
})


def _panel(spark, d):
    return FE.entity_month_panel(P.fact(spark, d))


def _orders_month(spark, d):
    return table(spark, d, "orders").select(F.trunc(F.to_date("o_orderdate"), "month").alias("order_month"),
                                            "o_orderstatus")


def _stg_part2(spark, d):
    return P.stg(spark, d).filter(F.col("rtt_part_type") == "Part_2")


QUERIES.update({
    "pct_of_partition_orders": lambda spark, d: WN.share_of_partition(
        _orders_month(spark, d).groupBy("order_month", "o_orderstatus").agg(F.count(F.lit(1)).alias("orders")),
        "orders", ["order_month"]),
    "lag_change_orders": lambda spark, d: WN.period_change(
        _orders_month(spark, d).groupBy("order_month").agg(F.count(F.lit(1)).alias("orders")),
        "orders", "order_month", change_alias="mom_change", pct_alias="mom_pct_change"),
    "breach_features": lambda spark, d: FE.breach_features(_panel(spark, d)),
    "perf_anomalies": lambda spark, d: FE.performance_anomalies(_panel(spark, d)),
    "submission_gaps": lambda spark, d: FE.submission_gaps(P.fact(spark, d), FE.ENTITY),
    "completeness_by_month": lambda spark, d: FE.completeness_by_month(P.fact(spark, d), FE.ENTITY),
    "band_long_national": lambda spark, d: DI.band_long(DI.aggregate_bands(_stg_part2(spark, d), ["period_date"]),
                                                        ["period_date"]),
    "wait_distribution": lambda spark, d: DI.distribution_stats(
        _stg_part2(spark, d), ["period_date", "provider_org_code", "treatment_function_code"]),
})


#: Anchors as they turn up on release pages, one of them per page.
RELEASE_ANCHORS = (
    '<a href="https://files.example.org/rtt/Full-CSV-Aug25.zip">Full CSV data file Aug25 (ZIP, 3M)</a>',
    "<A CLASS='x' HREF='/data/Full-CSV-Sep25-revised.zip'><b>FULL CSV</b> DATA FILE Sep25</A >",
    "<a class=x href=//cdn.example.com/get?id=7&amp;v=2>Full CSV data file Oct25</a>",
    '<a\nhref = "../files/./Full-CSV-Nov25.zip#top">Full CSV data file Nov25 &amp; notes</a>',
    '<a href="mailto:rtt@example.org">Full CSV data file help</a>',
)


def _release_pages(spark, d):
    """The pages with one more anchor each, its kind by page number."""
    kinds = F.array(*[F.lit(a) for a in RELEASE_ANCHORS])
    extra = F.get(kinds, F.pmod("page_id", F.lit(len(RELEASE_ANCHORS))).cast("int"))
    return table(spark, d, "pages").withColumn("html", F.concat(F.coalesce("html", F.lit("")), extra))


QUERIES.update({
    "release_links": lambda spark, d: PG.release_links(_release_pages(spark, d)).drop("anchor_pos"),
    "publication_status": lambda spark, d: CAL.publication_status(
        CAL.spine_last_n(spark.range(1).select(F.lit(P.AS_OF.date()).alias("as_of")), 6), PG.release_links(_release_pages(spark, d))),
})


def _raw_with_month(spark, d):
    raw = P.raw(spark, d)
    return raw.withColumn("_month_code", month_code(parse_period(F.col("Period"))))


def _national_from_raw_strings(spark, raw_strings):
    return Q.national_monthly(fact_performance(incomplete_pathways(
        staging(raw_strings, loaded_at=P.loaded_at_literal()))))


def _make_archives(spark, d):
    base = scratch_path(spark, "archives")
    FX.write_zip_archives(_raw_with_month(spark, d), f"{base}/rtt", "_month_code", f"{base}/csv", compression="gzip")
    return f"{base}/rtt"


def _mixed_archives(spark, d):
    """Every month's original, a revised January without one commissioner, and
    three files that can not be loaded."""
    folder = _make_archives(spark, d)
    raw = _raw_with_month(spark, d).filter((F.col("_month_code") == "Jan26") & (F.col("Commissioner Org Code") != "C40"))
    FX.write_zip_archives(raw, folder, "_month_code", scratch_path(spark, "archives-csv"), name="{month}_revised.zip", compression="gzip")
    FX.add_bad_archives(folder, ("Dec25", "Nov25", "Oct25"))
    return folder


def _zip_scan(spark, d):
    return _national_from_raw_strings(spark, AR.zip_csv_scan(spark, _make_archives(spark, d), raw_columns()))


def _file_manifest(spark, d):
    m = AR.file_plausibility(AR.file_manifest(spark, _mixed_archives(spark, d)), min_bytes=1_000)
    return AR.revised_flags(m).select(
        "filename", "month_code", "financial_year", "raw_path", "is_zip", F.size("csv_files_inside_zip").cast("bigint").alias("csv_files"),
        "error_message", "success", "is_revised")


def _pick_month_file(spark, d):
    return AL.chosen_files(spark, _mixed_archives(spark, d), min_bytes=1_000).filter("chosen").select("month_code", "filename", "is_revised")


def _archive_audit(spark, d):
    return AL.load_archives(spark, _mixed_archives(spark, d), scratch_path(spark, "archive-table"), P.loaded_at_literal(), min_bytes=1_000)


def _archive_load_audit(spark, d):
    return _archive_audit(spark, d).select(
        "month_code", "financial_year", "filename", "is_revised", "chosen", "rows_loaded", "rows_expected", "rows_quarantined", "success", "error_message")


def _archive_load_summary(spark, d):
    """Revised files and failures over the chosen files."""
    return LD.load_summary(_archive_audit(spark, d).filter("chosen"), "month_code")


def _load_quarantine(spark, d):
    """The dirty extract, landed as if the files of providers ending in 0 all
    said January: rows of other months and without a month are held back."""
    raw = P.dirty(spark, d)
    named = F.when(F.col("Provider Org Code").endswith("0"), F.lit("Jan26"))
    return LD.load_months(raw, scratch_path(spark, "quarantine-load"), P.loaded_at_literal(), source_file="fixture", month=named)


def _ingest_target(spark, d, revise: bool):
    base = scratch_path(spark, "ingest")
    landing, target, ckpt = f"{base}/landing", f"{base}/table", f"{base}/checkpoint"
    raw = _raw_with_month(spark, d)
    ING.land_csv(raw, landing, 1, rebalance=False)  # a task of the extract holds one month
    ING.ingest_available(spark, landing, target, ckpt, P.loaded_at_literal(), max_files_per_trigger=4)
    if revise:
        # the revised January publication omits one commissioner's rows
        rev = raw.filter((F.col("_month_code") == "Jan26") & (F.col("Commissioner Org Code") != "C40"))
        ING.land_csv(rev, landing, 2, rebalance=False)
        ING.ingest_available(spark, landing, target, ckpt, P.loaded_at_literal(), max_files_per_trigger=4)
    return spark.read.parquet(target)


def _ingest(spark, d, revise: bool):
    return _national_from_raw_strings(spark, _ingest_target(spark, d, revise))


def _revision_flags(spark, d):
    version = F.regexp_extract("_source_file", r"_landing_version=([0-9]+)/", 1)
    return _ingest_target(spark, d, True).groupBy("_month_code", "_financial_year", "_is_revised", version.alias("landing_version")).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"))


def _run_pipeline_months(spark, d):
    """A run over all months of which one (November) has rows without a provider
    code: it is blocked, the others load.  One row per month."""
    raw = P.raw(spark, d)
    lost = (F.col("Period") == "RTT-November-2025") & (F.col("RTT Part Type") == "Part_2")
    raw = raw.withColumn("Provider Org Code", F.when(~lost, F.col("Provider Org Code")))
    done = P.run_pipeline(raw, scratch_path(spark, "run"), source_file="fixture", rebalance=False)
    blocked = spark.createDataFrame([(m, "blocked") for m in done["months_blocked"]], "_month_code string, status string")
    facts = spark.read.parquet(done["fact"]).groupBy(month_code(F.col("period_date")).alias("_month_code")).agg(
        F.count(F.lit(1)).cast("bigint").alias("fact_rows"))
    audit = LD.this_run(spark.read.parquet(done["load_audit"]), P.loaded_at_literal()).join(facts, "_month_code", "left").withColumn("status", F.lit("loaded"))
    return audit.unionByName(blocked, allowMissingColumns=True)


def _staging_rows(spark, d):
    return staging(P.dirty(spark, d), loaded_at=P.loaded_at_literal())


QUERIES.update({
    "zip_csv_scan": _zip_scan,
    "zip_csv_rows": lambda spark, d: AR.zip_csv_scan(spark, _make_archives(spark, d), raw_columns()).drop("_source_file", "_scan_error"),
    "file_manifest": _file_manifest,
    "pick_month_file": _pick_month_file,
    "archive_load_audit": _archive_load_audit,
    "archive_load_summary": _archive_load_summary,
    "incremental_ingest": lambda spark, d: _ingest(spark, d, False),
    "late_revision_replace": lambda spark, d: _ingest(spark, d, True),
    "late_revision_flags": _revision_flags,
    "load_quarantine": _load_quarantine,
    "run_pipeline_months": _run_pipeline_months,
    "staging_rows": _staging_rows,
    "fact_performance_dirty": lambda spark, d: fact_performance(incomplete_pathways(_staging_rows(spark, d))),
    "dq_suite_text_raw": lambda spark, d: DQ.run_suite(P.dirty(spark, d), DQ.raw_extract_rules()),
    "dq_failing_values": lambda spark, d: DQ.failing_values(P.dirty(spark, d), DQ.raw_extract_rules() + [
        DQ.ValuesInSet("known_specialties", column="Treatment Function Code", values=SPECIALTY_CODES),
        DQ.RequiredValues("apostrophes_present", column="Treatment Function Code", values=("King's", "Queen's"))]),
    "backfill_success": lambda spark, d: CAL.backfill_success(_backfill_results(spark, d)),
})


def _backfill_results(spark, d):
    """The plan with download results: months on the shelf by order month, of
    which those with fewer orders than average failed."""
    sizes = table(spark, d, "orders").groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("period_date")).agg(
        F.count(F.lit(1)).alias("file_size_bytes"))
    mean = sizes.agg(F.avg("file_size_bytes").alias("mean"))
    rows = sizes.join(F.broadcast(mean), F.col("file_size_bytes") >= 0)
    short = F.col("file_size_bytes") < F.col("mean")
    return CAL.backfill_summary(rows.select(
        "period_date", month_code(F.col("period_date")).alias("month_code"), F.when(short, "failed").otherwise("success").alias("status"),
        "file_size_bytes", (F.month("period_date") % 2 == 0).alias("is_revised"), F.when(short, "too small").alias("error_message")))


QUERIES["backfill_results"] = lambda spark, d: _backfill_results(spark, d).withColumn("failures", F.array_join(F.sort_array("failures"), "; "))


def _clusters(spark, d):
    out, _ = MD.trust_clusters(_panel(spark, d))
    return out


def _breach_model(spark, d):
    pred, _ = MD.breach_model(FE.breach_features(_panel(spark, d)))
    return pred


def _breach_metrics(spark, d):
    """The model's metrics as rows."""
    _, metrics = MD.breach_model(FE.breach_features(_panel(spark, d)))
    return spark.createDataFrame([(k, None if v is None else float(v)) for k, v in metrics.items()], "metric string, value double")


QUERIES.update({
    "trend_forecast": lambda spark, d: MD.trend_forecast(_panel(spark, d)),
    "trust_clusters": _clusters,
    "trust_features": lambda spark, d: MD.trust_features(_panel(spark, d)),
    "cluster_scores": lambda spark, d: MD.compare_clusters(_panel(spark, d))[1],
    "breach_model": _breach_model,
    "breach_training_rows": lambda spark, d: MD.breach_training_rows(FE.breach_features(_panel(spark, d))),
    "breach_metrics": _breach_metrics,
    "feature_order": lambda spark, d: FE.feature_order(FE.breach_features(_panel(spark, d))),
    "trust_specialty_series": lambda spark, d: FE.entity_series(_panel(spark, d), "P00001", "C_110"),
})


def _scorecard_from_table(spark, d):
    """Materialise the layers, then run the one-month scorecard on the written
    fact table: the period filter prunes to one partition folder."""
    paths = P.materialise(P.raw(spark, d), scratch_path(spark, "layers"))
    return Q.trust_scorecard(spark.read.parquet(paths["fact"]))


def _scorecard_export(spark, d):
    """The scorecard written as CSV and read back."""
    path = scratch_path(spark, "scorecard-csv")
    report = Q.trust_scorecard(P.fact(spark, d))
    Q.export_csv(report, path)
    return spark.read.option("header", True).schema(report.schema).csv(path)


QUERIES.update({
    "fact_profile": lambda spark, d: DQ.profile(P.fact(spark, d)),
    "unexpected_part_types": lambda spark, d: DQ.unexpected_values(
        P.raw(spark, d).withColumnRenamed("RTT Part Type", "part_type"), "part_type", ["Part_1A", "Part_2"]),
    "missing_core_specialties": lambda spark, d: DQ.missing_values(
        P.fact(spark, d), "treatment_function_code", list(CORE_SPECIALTIES), by=["period_date"]),
    "scorecard_from_table": _scorecard_from_table,
    "scorecard_export": _scorecard_export,
    "week_row_sums": lambda spark, d: P.raw(spark, d).select("Period", week_row_sum(raw_columns()).alias("n")).groupBy("Period").agg(
        F.sum("n").cast("bigint").alias("patients"), F.max("n").cast("bigint").alias("largest_row")),
})


def _supplier_scd2(spark, d):
    """Generic SCD2 on another table: snapshot 1 is the supplier table; in
    the next snapshot suppliers with a negative balance have closed (hard
    delete) and those with a balance over 9,000 moved to the next nation."""
    sup = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    attrs = ["s_name", "s_nationkey"]
    snap1 = SCD.scd2_check(None, sup.drop("s_acctbal"), "s_suppkey", attrs, dt.date(2024, 1, 1))
    nxt = (sup.filter(F.col("s_acctbal") >= 0)
           .withColumn("s_nationkey", F.when(F.col("s_acctbal") > 9000, (F.col("s_nationkey") + 1) % 25)
                       .otherwise(F.col("s_nationkey")))
           .drop("s_acctbal"))
    return SCD.scd2_check(snap1, nxt, "s_suppkey", attrs, dt.date(2024, 2, 1))


QUERIES["scd2_supplier"] = _supplier_scd2


QUERIES.update(HI.QUERIES)


def queries() -> dict:
    return dict(QUERIES)
