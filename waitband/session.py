"""Session helpers.

Library code never creates its own session: every operator takes the
caller's DataFrames.  ``local_session`` is for tests, the bench and examples.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter for this workload at any scale:
#  * AQE re-plans shuffles at runtime (coalesces small partitions, splits
#    skewed join partitions).
#  * codegen.maxFields: raw extracts are 121 columns wide; at the default of
#    100 a full-width stage falls out of whole-stage codegen.
#  * UTC session zone so date arithmetic is reproducible.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.maxFields": "200",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "waitband", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("WAITBAND_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only a local session
    may go without: it gets a folder under the system temp dir.  On a cluster
    such a folder would be another one on each machine, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = os.path.join(tempfile.gettempdir(), "waitband-checkpoints")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


#: Scratch folders of this process, in the order they were handed out.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder.

    Used for written intermediate tables (lineage cuts, landed files).  It is
    derived from ``spark.checkpoint.dir`` so every executor sees it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/waitband/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process was given; for the end of a job,
    when no result that reads them is needed any more.  Returns how many."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


#: Files that a task of a partitioned write keeps open before it sorts the rest.
OPEN_WRITERS = 16
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _during(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def unsorted_write(spark: SparkSession, writers: int = OPEN_WRITERS) -> Iterator[None]:
    """Partitioned writes started inside keep a file open per partition value,
    up to ``writers`` in a task, instead of sorting all rows of the task by it:
    rows of 121 columns take about 1 KB each in a sort, however small the task's
    input was.  With more values in a task the rest is sorted as usual."""
    with _during(spark, _WRITERS, str(writers)):
        yield


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes started inside delete their shuffle files as they end, instead of when
    the driver happens to collect its garbage, so that steps do not add up on disk."""
    with _during(spark, _FREED, "true"):
        yield


#: What a task takes of gzipped CSV, which unpacks to some ten times as much.
PACKED_BYTES = "16m"
_SPLIT = "spark.sql.files.maxPartitionBytes"


@contextmanager
def packed_reads(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside read few gzipped files in a task: tasks are cut by the
    bytes on disk, and by those alone a task would unpack millions of rows."""
    with _during(spark, _SPLIT, PACKED_BYTES):
        yield


#: Rows of an Arrow batch between executor and Python where rows hold whole texts.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Jobs started inside pass at most ``rows`` rows a batch to Python; a batch
    stands in the executor and in its worker, for every task at a time."""
    set_rows = int(spark.conf.get(_BATCH))
    with _during(spark, _BATCH, str(min(rows, set_rows) if set_rows > 0 else rows)):
        yield
