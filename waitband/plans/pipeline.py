"""Preset: the monthly pipeline wired from the generic operators.

raw extract -> staging -> incomplete pathways -> fact.  Everything is lazy;
Catalyst prunes the band columns a report does not use and pushes the
pathway/specialty filter below the staging projection.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fact import fact_performance
from ..operators.pathways import incomplete_pathways
from ..operators.staging import staging
from ..session import freed_shuffles, unsorted_write
from ..sources.extract import dirty_extract, raw_extract

# Fixed load time used by the catalogue so results are reproducible.
AS_OF = dt.datetime(2026, 2, 15, 6, 0, 0)


def loaded_at_literal(ts: dt.datetime = AS_OF):
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_extract(spark, sf_dir)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_extract(spark, sf_dir)


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging(raw(spark, sf_dir), loaded_at=loaded_at_literal())


def intermediate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incomplete_pathways(stg(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_performance(intermediate(spark, sf_dir))


def materialise(raw_df: DataFrame, out_dir: str, loaded_at=None, months: list | None = None) -> dict[str, str]:
    """Staging stays a lazy view; intermediate and mart are written tables,
    partitioned by month.  ``months`` (period dates) rebuilds only those
    partitions; without it both tables are rebuilt in full.  Returns the paths."""
    from ..operators.fact import write_fact
    stg_df = staging(raw_df, loaded_at=loaded_at if loaded_at is not None else loaded_at_literal())
    if months is not None:
        stg_df = stg_df.filter(F.col("period_date").isin(months))
    int_path, fact_path = f"{out_dir}/int_incomplete_pathways", f"{out_dir}/fact_performance"
    mode = "static" if months is None else "dynamic"
    with unsorted_write(raw_df.sparkSession):
        (incomplete_pathways(stg_df).hint("rebalance", "period_date").write.mode("overwrite")
         .option("partitionOverwriteMode", mode).partitionBy("period_date").parquet(int_path))
    int_df = raw_df.sparkSession.read.parquet(int_path)
    if months is not None:
        int_df = int_df.filter(F.col("period_date").isin(months))
    write_fact(fact_performance(int_df), fact_path, months_only=months is not None)
    return {"int": int_path, "fact": fact_path}


def run_pipeline(raw_df: DataFrame, out_dir: str, loaded_at=None, rules=None, block_on_error: bool = True,
                 source_file=None, month=None, is_revised=False, rebalance: bool = True) -> dict:
    """The monthly run in one application: DQ suite per month -> gate ->
    idempotent load of the months that pass -> intermediate and fact partitions
    of those months -> SCD2 provider history and snapshot.  Every step writes a
    table under ``out_dir`` (a shared folder), so a failed run restarts from
    written state.  Results of the suite and the load audit are kept per run
    (``_run_at``, from ``loaded_at``); a repeated run replaces its own rows.

    ``month`` is the month code that the file names (text or column); without
    it a row's own period decides.  Rows without a month, or whose period is of
    another one, are held back in ``quarantine`` and never gate a month.
    ``rebalance`` as in ``load_months``.

    Returns the table paths and the months loaded / blocked."""
    from ..functions.calendar import month_code, parse_period
    from ..operators import quality as DQ
    from ..operators.load import append_run, load_months, this_run
    from ..operators.scd2 import scd2_from_history, write_snapshot

    spark = raw_df.sparkSession
    ts = loaded_at if loaded_at is not None else loaded_at_literal()
    rules = rules if rules is not None else DQ.raw_extract_rules()
    own = month_code(parse_period(F.col("Period")))
    named = own if month is None else F.coalesce(F.lit(month) if isinstance(month, str) else month, own)
    keyed = raw_df.withColumn("_dq_month", named)
    dq_path, raw_path, held_path = f"{out_dir}/dq_results", f"{out_dir}/raw", f"{out_dir}/quarantine"
    # the rules see the raw columns only (the month key is a grouping column)
    with freed_shuffles(spark):
        append_run(DQ.run_suite(keyed, rules, by=["_dq_month"]), dq_path, ts)
    gates = DQ.gate(this_run(spark.read.parquet(dq_path), ts), by=["_dq_month"]).filter("_dq_month is not null").collect()   # one row per month
    passed = sorted(r["_dq_month"] for r in gates if r["passed"] or not block_on_error)
    blocked = sorted(r["_dq_month"] for r in gates if not (r["passed"] or not block_on_error))
    out = {"dq_results": dq_path, "months_loaded": passed, "months_blocked": blocked}
    if not passed:
        return out
    audit = load_months(raw_df, raw_path, ts, months=passed, source_file=source_file, is_revised=is_revised, month=month,
                        quarantine_path=held_path, rebalance=rebalance)
    append_run(audit, f"{out_dir}/load_audit", ts)
    landed = spark.read.parquet(raw_path)
    periods = [dt.datetime.strptime(f"01{m}", "%d%b%y").date() for m in passed]
    out.update(materialise(landed, out_dir, ts, months=periods))
    stg_df = staging(landed, loaded_at=ts)
    attrs = ["provider_org_name", "provider_parent_org_code", "provider_parent_name"]
    hist = scd2_from_history(stg_df, "provider_org_code", attrs)
    hist.write.mode("overwrite").parquet(f"{out_dir}/dim_provider")
    snap = write_snapshot(spark, f"{out_dir}/snap_dim_provider", stg_df, "provider_org_code", attrs, max(periods))
    out.update({"raw": raw_path, "quarantine": held_path, "load_audit": f"{out_dir}/load_audit", "dim_provider": f"{out_dir}/dim_provider",
                "snap_dim_provider": snap})
    return out
