"""Archive folders for the catalogue's queries and the tests, made from the
derived extract.  The writer puts ZIP files on a mounted shared folder with
plain file calls inside tasks; it is no part of the library's sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import freed_shuffles, unsorted_write


def _zip_fn(staging_dir: str, out_dir: str, name: str, folders: list[str]):
    """One archive per folder ``__m=<month>`` of CSV files, named by its place in
    ``folders``; the files, plain or gzipped, pass through in pieces, the header
    comes once."""
    def fn(batches):
        import gzip
        import shutil
        import zipfile

        import pyarrow as pa
        for b in batches:
            done = []
            for i in b.column("id").to_pylist():
                source = os.path.join(staging_dir, folders[i])
                month = folders[i].split("=", 1)[1]
                folder = os.path.join(out_dir, month)
                os.makedirs(folder, exist_ok=True)
                target = os.path.join(folder, name.format(month=month))
                with zipfile.ZipFile(target, "w", compression=zipfile.ZIP_DEFLATED) as z, z.open(f"{month}.csv", "w", force_zip64=True) as out:
                    for k, part in enumerate(sorted(p for p in os.listdir(source) if p.endswith((".csv", ".csv.gz")))):
                        with (gzip.open if part.endswith(".gz") else open)(os.path.join(source, part), "rb") as f:
                            if k:
                                f.readline()
                            shutil.copyfileobj(f, out, 1 << 20)
                done.append(target)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["archive"])
    return fn


def local_folder(path: str) -> str:
    """``path`` as a plain folder name; only mounted storage will do."""
    if "://" in path and not path.startswith("file:"):
        raise ValueError(f"archives are written with Python file calls and need a mounted shared folder, not {path.split('://')[0]}:// storage")
    return "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path


def write_zip_archives(df: DataFrame, out_dir: str, month_col: str, staging_dir: str, name: str = "{month}_full.zip",
                       compression: str | None = None) -> None:
    """One ZIP with one CSV per month under ``out_dir/<month>/``.  Every task
    writes its rows as CSV by month (``compression="gzip"``: gzipped, a tenth of the
    disk); then a task per month packs the month's files."""
    target, staged = local_folder(out_dir), local_folder(staging_dir)
    spark = df.sparkSession
    with unsorted_write(spark), freed_shuffles(spark):
        (df.withColumn("__m", F.col(f"`{month_col}`")).drop(month_col).write.mode("overwrite")
         .option("header", True).option("compression", compression or "none").partitionBy("__m").csv(staging_dir))
    folders = sorted(f for f in os.listdir(staged) if f.startswith("__m="))  # months of one extract: a handful
    if folders:
        (spark.range(0, len(folders), 1, len(folders)).mapInArrow(_zip_fn(staged, target, name, folders), "archive string")
         .write.format("noop").mode("overwrite").save())


def add_bad_archives(out_dir: str, months: tuple[str, str, str]) -> None:
    """Beside the good files: no ZIP at all, a ZIP without CSV, and a "revised"
    ZIP whose data is damaged behind a sound directory."""
    import io
    import zipfile
    folder = local_folder(out_dir)
    a, b, c = (os.path.join(folder, m) for m in months)
    with open(os.path.join(a, f"{months[0]}_revised_no.zip"), "wb") as f:
        f.write(b"x" * 20_000)
    with zipfile.ZipFile(os.path.join(b, f"{months[1]}_revised_readme.zip"), "w") as z:
        z.writestr("readme.txt", "y" * 30_000)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_STORED) as z:
        z.writestr("a.csv", "Period\n" + "RTT-January-2026\n" * 3_000)
    data = bytearray(buf.getvalue())
    data[20_000:20_010] = b"0123456789"
    with open(os.path.join(c, f"{months[2]}_revised_torn.zip"), "wb") as f:
        f.write(bytes(data))
