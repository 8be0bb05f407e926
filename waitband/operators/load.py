"""Idempotent month loads: audit columns, quarantine, dynamic partition
overwrite, reconciliation and load summaries.

A month is the unit of replacement.  ``month_overwrite`` writes with
``partitionOverwriteMode=dynamic`` so only the months present in the frame
are replaced: reruns never duplicate rows and other months are untouched.
Which month a row belongs to is said by its file or folder; where a file does
not say, by the row's period.  A row whose period is of another month, or does
not parse, would replace a month it knows nothing of: it goes to a quarantine
table with the reason, never to the null partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PIPELINE_VERSION, raw_columns
from ..functions.calendar import financial_year, month_code, parse_period, year_of_month
from ..session import freed_shuffles, scratch_path, unsorted_write

STRAY, UNPARSED = "period of another month", "period does not parse"
AUDIT_COLUMNS = ("_pipeline_loaded_at", "_source_file", "_financial_year", "_month_code", "_is_revised", "_pipeline_version")


def with_audit(raw: DataFrame, loaded_at, source_file=None, is_revised=False,
               version: str = PIPELINE_VERSION, period_col: str = "Period", month: Column | str | None = None) -> DataFrame:
    """Add the six loader audit columns.  ``month`` is the month code the file
    or folder names (column or text); where it is NULL, and without it, month
    and financial year come from each row's period, so many files load in one
    distributed pass."""
    d = parse_period(F.col(f"`{period_col}`"))
    if source_file is None:
        src = F.input_file_name()
    elif isinstance(source_file, str):
        src = F.lit(source_file)
    else:
        src = source_file
    rev = F.lit(is_revised) if isinstance(is_revised, bool) else is_revised
    named = F.lit(None).cast("string") if month is None else F.lit(month) if isinstance(month, str) else month
    own = [c for c in raw.columns if c not in AUDIT_COLUMNS]
    return raw.select(
        *[F.col(f"`{c}`") for c in own],
        F.lit(loaded_at).alias("_pipeline_loaded_at"),
        src.alias("_source_file"),
        F.coalesce(year_of_month(named), financial_year(d)).alias("_financial_year"),
        F.coalesce(named, month_code(d)).alias("_month_code"),
        rev.alias("_is_revised"),
        F.lit(version).alias("_pipeline_version"),
    )


def quarantine_reason(period_col: str = "Period", month_col: str = "_month_code") -> Column:
    """Why a row may not be loaded into its month; NULL if it may."""
    own = month_code(parse_period(F.col(f"`{period_col}`")))
    return F.when(own.isNull(), UNPARSED).when(F.lower(own) != F.lower(F.col(month_col)), STRAY)


def split_quarantine(audited: DataFrame, period_col: str = "Period") -> tuple[DataFrame, DataFrame]:
    """(rows to load, rows held back with ``_quarantine_reason``)."""
    marked = audited.withColumn("_quarantine_reason", quarantine_reason(period_col))
    good = marked.filter(F.col("_quarantine_reason").isNull()).drop("_quarantine_reason")
    return good, marked.filter(F.col("_quarantine_reason").isNotNull())


def month_overwrite(df: DataFrame, path: str, month_col: str = "_month_code",
                    cluster_cols: tuple = (), rebalance: bool = True) -> None:
    """Replace exactly the months present in ``df`` under ``path``.

    The rebalance hint shuffles by month and lets AQE split a hot month and
    merge small ones, so files come out near the advisory size whatever the
    input's partitioning.  ``rebalance=False`` keeps the input partitioning (one
    file per task and month), for frames whose tasks hold one month each.  A
    month absent from ``df`` is left untouched (dynamic overwrite never deletes
    by omission)."""
    out = df.hint("rebalance", month_col) if rebalance else df
    if cluster_cols:
        (out.sortWithinPartitions(month_col, *cluster_cols)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(month_col).parquet(path))
        return
    # a task holds few months: a file for each, no sort of the wide rows
    with unsorted_write(df.sparkSession), freed_shuffles(df.sparkSession):
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month_col).parquet(path)


def load_reconcile(source: DataFrame, target: DataFrame, month_col: str = "_month_code") -> DataFrame:
    """Rows per month in source vs target; a mismatch is reported, not raised."""
    s = source.groupBy(month_col).agg(F.count(F.lit(1)).cast("bigint").alias("rows_expected"))
    t = target.groupBy(month_col).agg(F.count(F.lit(1)).cast("bigint").alias("rows_loaded"))
    return _reconciled(s, t, month_col)


def _reconciled(s: DataFrame, t: DataFrame, month_col: str) -> DataFrame:
    j = s.join(t, month_col, "full")
    e = F.coalesce("rows_expected", F.lit(0).cast("bigint"))
    lo = F.coalesce("rows_loaded", F.lit(0).cast("bigint"))
    return j.select(month_col, e.alias("rows_expected"), lo.alias("rows_loaded"), (e == lo).alias("success"))


def load_summary(audit: DataFrame, month_col: str = "_month_code") -> DataFrame:
    """Files (months) attempted, succeeded, failed and rows loaded; with the
    per-file audit also revised files and the failed ones with their errors."""
    own = set(audit.columns)
    failed = ~F.col("success")
    more = []
    if "is_revised" in own:
        more.append(F.sum(F.col("is_revised").cast("int")).cast("bigint").alias("revised"))
    if "error_message" in own:
        more.append(F.concat_ws("; ", F.sort_array(F.collect_list(F.when(failed, F.concat_ws(
            ": ", F.coalesce(F.col(month_col), F.lit("unknown month")), F.coalesce("error_message", F.lit("row count differs"))))))).alias("failures"))
    return audit.agg(
        F.count(F.lit(1)).cast("bigint").alias("months"),
        F.sum(F.col("success").cast("int")).cast("bigint").alias("succeeded"),
        F.sum(failed.cast("int")).cast("bigint").alias("failed"),
        F.sum("rows_loaded").cast("bigint").alias("total_rows"),
        *more,
    )


def _folder(spark, path: str):
    """Hadoop path class and the file system that ``path`` is in."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


QUARANTINE_PARTITIONS = ("_month_code", "_source_file")
_NO_MONTH = "_month_code=__HIVE_DEFAULT_PARTITION__"


def replace_quarantine(held: DataFrame, path: str, months: list[str], files: DataFrame) -> None:
    """Rows held back, in a table partitioned by month and source file.

    A load answers for its own months and files: what earlier loads held back of
    ``months`` goes, whether or not this load holds rows of them, and so do rows
    without a month that came from ``files`` (one column).  Rows of all other
    months and files stay."""
    spark = held.sparkSession
    hpath, fs = _folder(spark, path)
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for m in months:
        fs.delete(hpath(f"{path}/_month_code={escape.escapePathName(m)}"), True)
    loose = hpath(f"{path}/{_NO_MONTH}")
    if fs.exists(loose):
        # files that left rows without a month: as many values as folders here
        names = [s.getPath().getName() for s in fs.listStatus(loose)]
        known = spark.createDataFrame([(escape.unescapePathName(n.split("=", 1)[1]), n) for n in names if "=" in n], "file string, folder string")
        own = files.toDF("f").distinct()
        for (folder,) in known.join(own, known["file"] == own["f"], "left_semi").select("folder").collect():
            fs.delete(hpath(f"{path}/{_NO_MONTH}/{folder}"), True)
    with unsorted_write(spark):
        held.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*QUARANTINE_PARTITIONS).parquet(path)


def load_months(raw: DataFrame, path: str, loaded_at, months: list[str] | None = None,
                source_file=None, is_revised=False, month: Column | str | None = None,
                quarantine_path: str | None = None, rebalance: bool = True) -> DataFrame:
    """Audit -> quarantine -> optional month filter -> month overwrite -> reconcile.

    The source is evaluated once: its marked rows are landed in the shared
    scratch folder, already apart by month, and the table, the quarantine and the
    counts are taken from there.  ``rebalance=False`` as in ``month_overwrite``.  Rows held back replace those of the same months
    and files in the quarantine table, if given; other months keep theirs.

    Returns the per-month audit rows: expected rows, rows in the written table
    and the rows held back, of which those without any month stand in a row of
    their own (month NULL).  A month that was asked for and has no row fails with
    a row of zeros."""
    a = with_audit(raw, loaded_at, source_file, is_revised, month=month)
    if months:
        wanted = F.lower(F.col("_month_code")).isin([m.lower() for m in months])
        a = a.filter(wanted | F.col("_month_code").isNull())
    spark = a.sparkSession
    marked = a.withColumn("_quarantine_reason", quarantine_reason())
    marked = marked.withColumn("_held", F.col("_quarantine_reason").isNotNull())
    landed = scratch_path(spark, "month-rows")
    with unsorted_write(spark), freed_shuffles(spark):
        (marked.hint("rebalance", "_month_code") if rebalance else marked).write.partitionBy("_held", "_month_code").parquet(landed)
    marked = spark.read.schema(marked.schema).parquet(landed)
    good, held = marked.filter("not _held").drop("_held", "_quarantine_reason"), marked.filter("_held").drop("_held")
    month_overwrite(good, path, rebalance=False)  # the landed files hold one month each
    counts = marked.groupBy("_month_code").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows_read"), F.sum(F.col("_held").cast("int")).cast("bigint").alias("rows_quarantined"))
    if quarantine_path:
        # months of one load: a handful
        loaded_months = [r[0] for r in counts.filter("_month_code is not null").select("_month_code").collect()]
        replace_quarantine(held, quarantine_path, loaded_months, marked.select("_source_file"))
    t = spark.read.parquet(path).groupBy("_month_code").agg(F.count(F.lit(1)).cast("bigint").alias("rows_loaded"))
    e = F.col("rows_read") - F.col("rows_quarantined")
    zero = F.lit(0).cast("bigint")
    loaded = F.when(e > 0, F.coalesce("rows_loaded", zero)).otherwise(zero)
    # months with nothing to load keep what the table has: that is not this load's count
    audit = counts.join(t, "_month_code", "left").select(
        "_month_code", e.alias("rows_expected"), loaded.alias("rows_loaded"), (e == loaded).alias("success"), "rows_quarantined")
    if not months:
        return audit
    found = counts.select(F.lower("_month_code").alias("m"))
    asked = spark.createDataFrame([(m,) for m in dict.fromkeys(months)], "_month_code string")
    absent = asked.join(found, F.lower("_month_code") == F.col("m"), "left_anti")
    return audit.unionByName(absent.select("_month_code", zero.alias("rows_expected"), zero.alias("rows_loaded"), F.lit(False).alias("success"),
                                           zero.alias("rows_quarantined")))


def run_name(run_at) -> Column:
    """The run that started at ``run_at``, as text that no reader takes for a number."""
    return F.date_format(F.lit(run_at).cast("timestamp_ntz"), "yyyyMMdd'T'HHmmss")


def append_run(rows: DataFrame, path: str, run_at, run_col: str = "_run_at") -> None:
    """Keep ``rows`` of one run beside those of all earlier runs; a run that is
    repeated replaces its own."""
    (rows.withColumn(run_col, run_name(run_at))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run_col).parquet(path))


def this_run(kept: DataFrame, run_at, run_col: str = "_run_at") -> DataFrame:
    """The rows of one run of a table kept by ``append_run``."""
    return kept.filter(F.col(run_col) == run_name(run_at)).drop(run_col)


def exclude_revised(df: DataFrame, flag_col: str = "_is_revised") -> DataFrame:
    """Drop rows of revised publications (e.g. before model training)."""
    return df.filter(~F.coalesce(F.col(flag_col), F.lit(False)))


def read_raw_csv(spark, path: str, columns: list[str] | None = None) -> DataFrame:
    """Raw monthly CSV with a header, every column read as a string against a
    declared schema (no inference pass); staging casts the counts.  Only an
    empty cell is NULL, as in the archive reader."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns or raw_columns()])
    return spark.read.option("header", True).option("enforceSchema", False).option("nullValue", "").schema(schema).csv(path)
