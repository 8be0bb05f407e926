"""A maintained roll-up: sums per group and month, and over all months, kept up
to date as months are published and revised.

``publish`` takes the rows of the months that changed, and nothing else.  It
sums them to the groups, *retracts* what the roll-up held for those months from
the totals and adds the new sums; groups that no row is left in go.  Sums of
whole numbers can be taken back exactly, so the totals equal a full rebuild at
any time.

Each step writes a version folder: ``<base>/v=<n>/months`` (the changed months,
partitioned by month), ``<base>/v=<n>/totals`` and, last, a ``_COMMITTED`` marker.
Readers take the highest committed version's totals and, for every month, the
newest committed version that holds it; a step that broke off leaves nothing
that counts and is simply run again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .load import _folder

#: Sums that the published reports are made of; tenths make the unweighted mean of rounded percentages exact.
MEASURES = {
    "total_incomplete": "total_incomplete",
    "patients_within_18_weeks": "patients_within_18_weeks",
    "patients_beyond_18_weeks": "patients_beyond_18_weeks",
    "patients_waiting_52_plus_weeks": "patients_waiting_52_plus_weeks",
    "patients_waiting_over_104_weeks": "patients_waiting_over_104_weeks",
    "pct_tenths": "cast(round(pct_within_18_weeks * 10) as bigint)",
    "pct_rows": "cast(pct_within_18_weeks is not null as bigint)",
}
DIMENSIONS = ("month_label", "provider_parent_name", "provider_parent_org_code", "treatment_function_name", "specialty_group", "is_surgical")
#: Rows of a group: what says that a group is empty.
ROWS = "rollup_rows"
MARKER = "_COMMITTED"


def _sums(names) -> list[Column]:
    return [F.sum(n).cast("bigint").alias(n) for n in names]


def partial_sums(rows: DataFrame, dims, measures: dict[str, str] = MEASURES, month_col: str = "period_date") -> DataFrame:
    """(month, dims..., measures..., rows): partial aggregation map-side."""
    own = rows.select(month_col, *dims, *[F.expr(e).cast("bigint").alias(n) for n, e in measures.items()], F.lit(1).cast("bigint").alias(ROWS))
    return own.groupBy(month_col, *dims).agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in [*measures, ROWS]])


def versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the committed versions, rising."""
    hpath, fs = _folder(spark, base)
    found = fs.globStatus(hpath(f"{base}/v=*/{MARKER}")) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def month_folders(spark: SparkSession, base: str, month_col: str = "period_date") -> dict[str, str]:
    """Month -> folder of the newest committed version that holds it (a path per
    month of the history)."""
    hpath, fs = _folder(spark, base)
    newest = {}
    for v in versions(spark, base):
        for s in fs.globStatus(hpath(f"{base}/v={v}/months/{month_col}=*")) or []:
            newest[s.getPath().getName().split("=", 1)[1]] = f"{base}/v={v}"
    return newest


def month_sums(spark: SparkSession, base: str, months: list[str] | None = None, month_col: str = "period_date") -> DataFrame | None:
    """The current sums per month and group, of all months or the given ones."""
    by_folder: dict[str, list[str]] = {}
    for m, folder in month_folders(spark, base, month_col).items():
        if months is None or m in months:
            by_folder.setdefault(folder, []).append(f"{folder}/months/{month_col}={m}")
    # a month that was emptied keeps a folder with a row that stands for nothing
    parts = [spark.read.option("basePath", f"{f}/months").parquet(*paths) for f, paths in sorted(by_folder.items())]
    return reduce(DataFrame.unionByName, parts).filter(F.col(ROWS) > 0) if parts else None


def totals(spark: SparkSession, base: str) -> DataFrame:
    """The current sums per group over all months."""
    return spark.read.parquet(f"{base}/v={versions(spark, base)[-1]}/totals")


def publish(spark: SparkSession, base: str, rows: DataFrame, months: list, dims=DIMENSIONS, total_dims=None,
            measures: dict[str, str] = MEASURES, month_col: str = "period_date") -> int:
    """Take ``rows``, all there is now of ``months`` (dates), into the roll-up; a
    month of the list without rows is emptied.  ``total_dims`` (by default
    ``dims`` but the month's label) are the groups of the totals.  Returns the
    version."""
    total_dims = list(total_dims) if total_dims is not None else [d for d in dims if d != "month_label"]
    names = [*measures, ROWS]
    done = versions(spark, base)
    folder = f"{base}/v={done[-1] + 1 if done else 1}"
    hpath, fs = _folder(spark, base)
    fs.delete(hpath(folder), True)  # of a step that broke off

    held = month_sums(spark, base, [str(m) for m in months], month_col)
    new = partial_sums(rows.filter(F.col(month_col).isin(months)), dims, measures, month_col)
    listed = spark.createDataFrame([(m,) for m in months], f"{month_col} date")
    # one row of zeros per month, so that a month without rows has its folder
    zero = listed.select(month_col, *[F.lit(None).cast(new.schema[d].dataType).alias(d) for d in dims], *[F.lit(0).cast("bigint").alias(n) for n in names])
    new.unionByName(zero).hint("rebalance", month_col).write.mode("overwrite").partitionBy(month_col).parquet(f"{folder}/months")
    added = spark.read.parquet(f"{folder}/months").filter(F.col(ROWS) > 0).select(*total_dims, *names)
    parts = [added]
    if done:
        parts.append(totals(spark, base).select(*total_dims, *names))
    if held is not None:
        parts.append(held.select(*total_dims, *[(-F.col(n)).alias(n) for n in names]))
    summed = reduce(DataFrame.unionByName, parts).groupBy(*total_dims).agg(*_sums(names)).filter(F.col(ROWS) > 0)
    summed.write.mode("overwrite").parquet(f"{folder}/totals")
    fs.create(hpath(f"{folder}/{MARKER}"), True).close()
    return int(folder.rsplit("=", 1)[1])


def specialty_report(total: DataFrame) -> DataFrame:
    """The all-months report by specialty, from the totals alone."""
    g = total.groupBy("treatment_function_name", "specialty_group", "is_surgical").agg(*_sums([*MEASURES]))
    mean = F.try_divide(F.col("pct_tenths").cast("double"), F.col("pct_rows").cast("double") * F.lit(10.0))
    return g.select("treatment_function_name", "specialty_group", "is_surgical", F.round(mean, 1).alias("avg_pct_within_18_weeks"),
                    F.col("total_incomplete").alias("total_waiting_all_months"),
                    F.col("patients_waiting_over_104_weeks").alias("total_over_2_years")).orderBy(F.col("avg_pct_within_18_weeks").asc())
