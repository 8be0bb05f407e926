"""ZIP/CSV archives and file manifests.

Reading: ``binaryFile`` lists the archives, then ``mapInArrow`` opens each by
its name inside a task and streams the first CSV member through pyarrow's CSV
reader as Arrow batches of strings, so a task holds a block of an archive, never
the whole.  That needs a mounted folder; from other storage ``binaryFile`` also
loads the bytes, and a task holds one archive at a time.  ZIP is not splittable:
an archive is one task's work.  An archive that can not be read gives one row
with the error, so it fails alone.

Manifests: size, modification time, MD5 of the bytes, ZIP magic, CSV member
names and the year/month encoded in the path, all in the task that reads the
file, piece by piece where it is mounted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FILE_MAX_BYTES, FILE_MIN_BYTES
from ..functions.calendar import month_of_path, raw_path, year_of_month

ZIP_MAGIC = bytes([0x50, 0x4B, 0x03, 0x04])


# Task-side functions are closures that reference only the standard
# library and pyarrow, so executors do not need this package installed.

def _listed(spark: SparkSession, path: str | list[str], glob: str) -> tuple[DataFrame, bool]:
    """(a row per archive, are they on a mounted folder).  Archives elsewhere come
    with their bytes as ``content``; those of a mounted folder are opened by name."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    first = path if isinstance(path, str) else path[0]
    return files, jvm.org.apache.hadoop.fs.Path(first).getFileSystem(conf).getUri().getScheme() == "file"


def _archive_opener(mounted: bool):
    """How a task opens the archive of a listed row."""
    def opened(path: str, content):
        import io
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb") if mounted else io.BytesIO(content)
    return opened


def _unzip_fn(columns: list[str], block_size: int, mounted: bool):
    opened = _archive_opener(mounted)

    def fn(batches):
        import zipfile
        import zlib

        import pyarrow as pa
        import pyarrow.csv as pcsv
        extra = ["_source_file", "_csv_member", "_scan_error"]
        out_schema = pa.schema([pa.field(c, pa.string()) for c in [*columns, *extra]])
        # only an empty cell is NULL: "NA" or "null" is text
        convert = pcsv.ConvertOptions(column_types={c: pa.string() for c in columns}, strings_can_be_null=True, null_values=[""])
        broken = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, pa.ArrowInvalid)

        def failed(path, member, why):
            row = [None] * len(columns) + [path, member, why]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in row], schema=out_schema)

        for b in batches:
            for i, path in enumerate(b.column("path").to_pylist()):
                member = None
                try:
                    with opened(path, None if mounted else b.column("content")[i].as_py()) as raw, zipfile.ZipFile(raw) as z:
                        members = sorted(n for n in z.namelist() if n.lower().endswith(".csv"))
                        if not members:
                            yield failed(path, None, "No CSV file inside archive")
                            continue
                        member = members[0]  # deterministic choice; the load audit names the others
                        with z.open(member) as f:
                            # every task has its core; threads would hold parsed blocks for each core
                            blocks = pcsv.open_csv(f, read_options=pcsv.ReadOptions(block_size=block_size, use_threads=False),
                                                   convert_options=convert)
                            for rb in blocks:
                                n, names = rb.num_rows, rb.schema.names
                                arrays = [rb.column(names.index(c)).cast(pa.string()) if c in names
                                          else pa.nulls(n, pa.string()) for c in columns]
                                arrays += [pa.array([v] * n, pa.string()) for v in (path, member, None)]
                                yield pa.RecordBatch.from_arrays(arrays, schema=out_schema)
                except broken as e:
                    yield failed(path, member, f"{type(e).__name__}: {e}")
    return fn


def zip_csv_scan(spark: SparkSession, path: str | list[str], columns: list[str], glob: str = "*.zip",
                 block_size: int = 1 << 20) -> DataFrame:
    """All declared ``columns`` as strings (missing ones NULL) plus
    ``_source_file``, ``_csv_member`` and ``_scan_error``, of every archive below
    ``path`` or of the given files.  An archive that can not be read (to its
    end) gives a row that holds just its name and the error.  A CSV row must fit
    into ``block_size`` bytes; the reader takes some 32 blocks ahead."""
    files, mounted = _listed(spark, path, glob)
    files = files.select("path", *([] if mounted else ["content"]))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_source_file", "_csv_member", "_scan_error"]])
    return files.mapInArrow(_unzip_fn(list(columns), block_size, mounted), schema)


def _probe_fn(mounted: bool):
    opened = _archive_opener(mounted)

    def fn(batches):
        import hashlib
        import zipfile

        import pyarrow as pa

        def probe(path, content):
            with opened(path, content) as f:
                md5, head = hashlib.md5(), f.read(4)
                md5.update(head)
                while piece := f.read(1 << 20):
                    md5.update(piece)
                f.seek(0)
                try:
                    with zipfile.ZipFile(f) as z:
                        members = sorted(n for n in z.namelist() if n.lower().endswith(".csv"))
                except zipfile.BadZipFile:
                    members = []
            return md5.hexdigest(), head, members

        for b in batches:
            found = [probe(p, None if mounted else b.column("content")[i].as_py()) for i, p in enumerate(b.column("path").to_pylist())]
            md5s, heads, members = ([r[k] for r in found] for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [b.column("path"), b.column("modificationTime"), b.column("length"), pa.array(md5s, pa.string()), pa.array(heads, pa.binary()),
                 pa.array(members, pa.list_(pa.string()))],
                names=["path", "modificationTime", "length", "md5_checksum", "head", "csv_files_inside_zip"])
    return fn


def file_manifest(spark: SparkSession, path: str, glob: str = "*.zip",
                  year_regex: str = r"/([0-9]{4}-[0-9]{2})/", source_url: str | None = None, taken_at=None) -> DataFrame:
    """One row per file: name, size, modification time, MD5, ZIP magic, CSV
    members, the month that its path names, the financial year (of the path or
    else of the month), where it belongs in the raw layout, and, if given, the
    URL prefix it came from and when it was taken."""
    files, mounted = _listed(spark, path, glob)
    files = files.select("path", "modificationTime", "length", *([] if mounted else ["content"])).mapInArrow(
        _probe_fn(mounted), "path string, modificationTime timestamp, length long, md5_checksum string, head binary, csv_files_inside_zip array<string>")
    name = F.element_at(F.split("path", "/"), -1)
    month = month_of_path(F.col("path"))
    rows = files.select(
        "path",
        name.alias("filename"),
        F.col("length").alias("file_size_bytes"),
        "modificationTime",
        "md5_checksum",
        (F.col("head") == F.lit(ZIP_MAGIC)).alias("is_zip"),
        "csv_files_inside_zip",
        F.coalesce(F.nullif(F.regexp_extract("path", year_regex, 1), F.lit("")), year_of_month(month)).alias("financial_year"),
        month.alias("month_code"),
    )
    url = F.lit(None).cast("string") if source_url is None else F.concat(F.lit(source_url), "filename")
    return rows.select("*", raw_path("financial_year", "month_code", "filename").alias("raw_path"),
                       url.alias("source_url"), F.lit(taken_at).cast("timestamp").alias("taken_at"))


def file_plausibility(manifest: DataFrame, min_bytes: int = FILE_MIN_BYTES,
                      max_bytes: int = FILE_MAX_BYTES) -> DataFrame:
    """First failing reason per file (NULL when plausible) and a success flag.

    When the manifest carries ``expected_md5`` / ``expected_size`` (from the
    download record), the file must match them too."""
    size = F.col("file_size_bytes")
    err = F.when(size.isNull(), "File not found")
    if "expected_size" in manifest.columns:
        err = err.when(F.col("expected_size").isNotNull() & (size != F.col("expected_size")),
                       F.format_string("Size changed: %d bytes, expected %d", size, F.col("expected_size")))
    if "expected_md5" in manifest.columns:
        err = err.when(F.col("expected_md5").isNotNull() & (F.col("md5_checksum") != F.col("expected_md5")),
                       "Checksum mismatch")
    err = (err.when(size < min_bytes, F.format_string("File too small: %d bytes", size))
           .when(size > max_bytes, F.format_string("File too large: %d bytes", size))
           .when(~F.col("is_zip"), "Not a valid ZIP file")
           .when(F.size("csv_files_inside_zip") == 0, "No CSV file inside archive"))
    return manifest.select("*", err.alias("error_message"), err.isNull().alias("success"))


def revised_flags(manifest: DataFrame, month_col: str = "month_code") -> DataFrame:
    """A file is a revision when its name says so, or when an earlier sound file
    of the same month had a different checksum.  The window holds the files
    of one month (a handful)."""
    sound = F.col("success") if "success" in manifest.columns else F.lit(True)
    w = Window.partitionBy(month_col).orderBy("modificationTime", "path")
    prev = F.last(F.when(sound, F.col("md5_checksum")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    by_name = F.lower("filename").contains("revised")
    return manifest.select("*", (by_name | F.coalesce(prev != F.col("md5_checksum"), F.lit(False))).alias("is_revised"))


def pick_month_file(manifest: DataFrame, month_col: str = "month_code") -> DataFrame:
    """One file per month: revisions first, then the newest, then by path.
    Files that failed their checks, or whose path names no month, are no choice."""
    if "success" in manifest.columns:
        manifest = manifest.filter("success")
    manifest = manifest.filter(F.col(month_col).isNotNull())
    w = Window.partitionBy(month_col).orderBy(F.col("is_revised").desc(), F.col("modificationTime").desc(),
                                              F.col("path"))
    return manifest.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
