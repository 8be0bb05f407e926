"""From a folder of archives to the month-partitioned raw table.

Manifest -> plausibility -> revision flags -> one file per month -> scan of the
chosen files -> audit columns (month from the path) -> quarantine -> month
overwrite.  Every file gets an audit row, chosen or not; a file that fails, or
breaks while it is read, costs its own month and nothing else: a month whose
file broke half-way is not loaded, and the table keeps what it had.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FILE_MAX_BYTES, FILE_MIN_BYTES, PIPELINE_VERSION, raw_columns
from ..session import scratch_path
from ..sources.archives import file_manifest, file_plausibility, pick_month_file, revised_flags, zip_csv_scan
from .load import month_overwrite, replace_quarantine, split_quarantine, with_audit

NOT_CHOSEN, NO_MONTH, NO_FILE = "Superseded by another file of the month", "No month in the path", "No file for the month"


def chosen_files(spark: SparkSession, folder: str, min_bytes: int = FILE_MIN_BYTES, max_bytes: int = FILE_MAX_BYTES) -> DataFrame:
    """The manifest of every archive with checks, revision flag and ``chosen``."""
    files = revised_flags(file_plausibility(file_manifest(spark, folder), min_bytes, max_bytes))
    pick = pick_month_file(files).select(F.col("path").alias("p"), F.lit(True).alias("chosen"))
    return files.join(pick, files["path"] == F.col("p"), "left").drop("p").withColumn("chosen", F.coalesce("chosen", F.lit(False)))


def load_archives(spark: SparkSession, folder: str, table_path: str, loaded_at, columns: list[str] | None = None,
                  min_bytes: int = FILE_MIN_BYTES, max_bytes: int = FILE_MAX_BYTES, months: list[str] | None = None) -> DataFrame:
    """Load the chosen archives below ``folder`` into ``table_path`` (rows held
    back go to ``<table_path>_quarantine``, in place of those of the same months)
    and return the audit: a row per file, and a failed one for each month of
    ``months`` that has no sound file."""
    listed = scratch_path(spark, "archive-manifest")
    files = chosen_files(spark, folder, min_bytes, max_bytes)
    if months:
        wanted = F.lower(F.col("month_code")).isin([m.lower() for m in months])
        files = files.withColumn("chosen", F.col("chosen") & F.coalesce(wanted, F.lit(False)))
    files.write.parquet(listed)
    files = spark.read.parquet(listed)
    # one path per month: as many values as months in the folder
    picked = files.filter("chosen").select("path", "month_code").collect()
    paths = [r["path"] for r in picked]
    read = None
    if paths:
        landed = scratch_path(spark, "archive-rows")
        zip_csv_scan(spark, paths, columns or raw_columns()).write.parquet(landed)
        scan = spark.read.parquet(landed)
        read = scan.groupBy(F.col("_source_file").alias("f")).agg(
            F.count(F.when(F.col("_scan_error").isNull(), 1)).cast("bigint").alias("rows_read"), F.max("_scan_error").alias("scan_error"))
        flags = files.filter("chosen").select("path", "month_code", "is_revised").join(
            read.filter("scan_error is null").select("f"), F.col("path") == F.col("f"), "left_semi")
        # a row per month: small, but left to Spark's own size rule
        sound = scan.filter("_scan_error is null").drop("_scan_error", "_csv_member").join(flags, F.col("_source_file") == F.col("path"))
        audited = with_audit(sound, loaded_at, F.col("_source_file"), F.col("is_revised"), PIPELINE_VERSION, month=F.col("month_code"))
        good, held = split_quarantine(audited.drop("path", "month_code", "is_revised"))
        month_overwrite(good, table_path)
        # a month whose file broke keeps its table rows, and the rows held back with them
        whole = {r["f"] for r in read.filter("scan_error is null").select("f").collect()}
        replace_quarantine(held, f"{table_path}_quarantine", [r["month_code"] for r in picked if r["path"] in whole], flags.select("path"))
        kept = held.groupBy(F.col("_source_file").alias("q")).agg(F.count(F.lit(1)).cast("bigint").alias("rows_held"))
        # declared, not inferred: where no chosen file was sound the table may hold no file yet
        loaded = spark.read.schema("_source_file string").parquet(table_path).groupBy(F.col("_source_file").alias("t")).agg(F.count(F.lit(1)).cast("bigint").alias("rows_in_table"))
        read = read.join(kept, F.col("f") == F.col("q"), "left").join(loaded, F.col("f") == F.col("t"), "left").drop("q", "t")
    else:
        read = spark.createDataFrame([], "f string, rows_read bigint, scan_error string, rows_held bigint, rows_in_table bigint")
    zero = F.lit(0).cast("bigint")
    j = files.join(read, F.col("path") == F.col("f"), "left")
    held_, table_rows = F.coalesce("rows_held", zero), F.coalesce("rows_in_table", zero)
    expected = F.coalesce(F.col("rows_read") - held_, zero)
    error = F.coalesce(F.when(~F.col("success"), F.col("error_message")), F.col("scan_error"),
                       F.when(F.col("chosen") & (expected != table_rows), "Row count differs"))
    note = F.when(error.isNull() & ~F.col("chosen"), F.when(F.col("month_code").isNull(), NO_MONTH).otherwise(NOT_CHOSEN))
    out = j.select(
        "month_code", "financial_year", F.col("path").alias("source_file"), "filename", "is_revised", "chosen",
        F.when(error.isNull() & F.col("chosen"), table_rows).otherwise(zero).alias("rows_loaded"), expected.alias("rows_expected"),
        held_.alias("rows_quarantined"), F.lit(loaded_at).alias("load_timestamp"), F.lit(table_path).alias("target_table"),
        (error.isNull() & F.col("chosen")).alias("success"), F.coalesce(error, note).alias("error_message"),
        F.slice("csv_files_inside_zip", 2, F.greatest(F.size("csv_files_inside_zip"), F.lit(1))).alias("csv_members_ignored"))
    if not months:
        return out
    asked = spark.createDataFrame([(m,) for m in dict.fromkeys(months)], "month_code string")
    have = files.filter("chosen").select(F.lower("month_code").alias("m"))
    absent = asked.join(have, F.lower("month_code") == F.col("m"), "left_anti").select(
        "month_code", zero.alias("rows_loaded"), zero.alias("rows_expected"), zero.alias("rows_quarantined"), F.lit(False).alias("chosen"),
        F.lit(loaded_at).alias("load_timestamp"), F.lit(table_path).alias("target_table"), F.lit(False).alias("success"),
        F.lit(NO_FILE).alias("error_message"))
    return out.unionByName(absent, allowMissingColumns=True)
