"""Month publication by stateful streaming: a month is published once all parts
of a version have landed, whenever and in whatever order they come.

A landing writes its data files first and then a *notice* per part, a line of
JSON in ``<landing>/_notices``: month, version, part, how many parts the version
has, and where the part's rows are.  A file stream reads the notices, and a
stateful operator keyed by month holds in the state store (RocksDB) which parts
of which version are there and which version is published.  When a version's
last part arrives and no later version is published, one row leaves the operator:
month, version and the parts' folders.  A sink rebuilds exactly those months from
exactly those folders, with a dynamic partition overwrite.

State outlives restarts through the checkpoint, so parts may arrive over several
runs; a repeated notice changes nothing; a version below the published one is
ignored; the state of a version goes when a later one is published.  A replayed
batch rebuilds the same months from the same folders.  A month that has waited
longer than ``patience`` for its parts leaves a ``stalled`` row (timers; in runs
that stay up).

State is a few rows per month: one per part of the versions still open.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..config import raw_columns
from ..operators.load import _folder, month_overwrite, replace_quarantine, split_quarantine, with_audit
from ..session import _during, freed_shuffles, packed_reads, unsorted_write

NOTICE = "_month_code string, version int, part int, parts int, folder string"
EVENT = "_month_code string, status string, version int, folders array<string>"
STORE = "spark.sql.streaming.stateStore.providerClass"
#: Tasks of the stateful step.  Its keys are months and its rows notices, so it does
#: not grow with the data; each task has a store and a Python worker of its own.
STATE_TASKS = 8
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class MonthParts(StatefulProcessor):
    """State per month: the parts seen of each open version, and the version
    published."""

    def __init__(self, patience_ms: int | None = None):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        key = T.StructType([T.StructField("version", T.IntegerType()), T.StructField("part", T.IntegerType())])
        value = T.StructType([T.StructField("parts", T.IntegerType()), T.StructField("folder", T.StringType())])
        self.parts = handle.getMapState("parts", key, value)
        self.published = handle.getValueState("published", T.StructType([T.StructField("version", T.IntegerType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd
        done = self.published.get()[0] if self.published.exists() else 0
        touched = set()
        for batch in rows:
            for version, part, parts, folder in zip(batch["version"], batch["part"], batch["parts"], batch["folder"]):
                if version > done and not self.parts.containsKey((int(version), int(part))):
                    self.parts.updateValue((int(version), int(part)), (int(parts), str(folder)))
                    touched.add(int(version))
        events = []
        for version in sorted(touched, reverse=True):  # the latest complete version is the one that counts
            held = {k[1]: v for k, v in self.parts.iterator() if k[0] == version}
            if len(held) >= max(v[0] for v in held.values()):
                self.published.update((version,))
                for k in [k for k, _ in self.parts.iterator() if k[0] <= version]:
                    self.parts.removeKey(tuple(k))
                events.append((key[0], "complete", version, [held[p][1] for p in sorted(held)]))
                break
        self._wait(timerValues)
        yield pd.DataFrame(events, columns=["_month_code", "status", "version", "folders"])

    def _wait(self, timerValues) -> None:
        """One timer while parts are missing, none otherwise."""
        if self.patience_ms is None:
            return
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if any(True for _ in self.parts.iterator()):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pandas as pd
        waiting = sorted({k[0] for k, _ in self.parts.iterator()})
        self._wait(timerValues)
        yield pd.DataFrame([(key[0], "stalled", v, []) for v in waiting], columns=["_month_code", "status", "version", "folders"])

    def close(self) -> None:
        pass


def land_part(df: DataFrame, landing: str, version: int, part: int, parts: int, month_col: str = "_month_code", months: list[str] | None = None) -> None:
    """Land one part of a version of the months in ``df``: the rows as gzipped CSV,
    then a notice per month.  ``months`` names the months where ``df`` may hold no row of
    one (an empty part still counts)."""
    spark = df.sparkSession
    root = f"{landing}/version={version}/part={part}"
    with unsorted_write(spark), freed_shuffles(spark):
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True).option("compression", "gzip")
         .partitionBy(month_col).csv(root))
    if months is None:
        months = [r[0] for r in df.select(month_col).distinct().collect()]  # months of one landing: a handful
    hpath, fs = _folder(spark, landing)
    for m in months:
        line = {"_month_code": m, "version": version, "part": part, "parts": parts, "folder": f"{root}/{month_col}={m}"}
        # written beside and renamed, so that the stream never reads half a notice
        name = f"{m}-{version}-{part}.json"
        out = fs.create(hpath(f"{landing}/_notices_tmp/{name}"), True)
        out.write(bytearray(json.dumps(line).encode()))
        out.close()
        fs.mkdirs(hpath(f"{landing}/notices"))
        fs.delete(hpath(f"{landing}/notices/{name}"), False)
        fs.rename(hpath(f"{landing}/_notices_tmp/{name}"), hpath(f"{landing}/notices/{name}"))


def complete_months(notices: DataFrame, patience_ms: int | None = None) -> DataFrame:
    """EVENT rows of a stream of notices."""
    return notices.groupBy("_month_code").transformWithStateInPandas(
        statefulProcessor=MonthParts(patience_ms), outputStructType=EVENT, outputMode="Update", timeMode="ProcessingTime" if patience_ms else "None")


def publish_months(spark: SparkSession, events: list, target: str, loaded_at, columns: list[str] | None = None) -> None:
    """Replace each event's month in ``target`` by the rows of its folders; rows of
    other months are held back beside it."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns or raw_columns()])
    hpath, fs = _folder(spark, target)
    folders = [f for e in events for f in e["folders"] if fs.exists(hpath(f))]  # an empty part has none
    if not folders:
        return
    rows = spark.read.schema(schema).option("header", True).option("nullValue", "").csv(folders).withColumn("_src", F.input_file_name())
    month = F.regexp_extract("_src", r"_month_code=([^/]+)/", 1)
    version = F.regexp_extract("_src", r"/version=([0-9]+)/", 1).cast("int")
    audited = with_audit(rows, loaded_at, source_file=F.col("_src"), is_revised=version > 1, month=month).drop("_src")
    good, held = split_quarantine(audited)
    with packed_reads(spark):
        month_overwrite(good, target, rebalance=False)  # a folder holds one month
        replace_quarantine(held, f"{target}_quarantine", [e["_month_code"] for e in events], held.select("_source_file"))


def start_publication(spark: SparkSession, landing: str, target: str, checkpoint: str, loaded_at, columns: list[str] | None = None,
                      patience_ms: int | None = None, available_now: bool = True, events_path: str | None = None,
                      max_files_per_trigger: int | None = None):
    """Start the query; returns the ``StreamingQuery``.  With ``events_path`` every
    event is also kept there (a folder per batch, replaced when it is replayed)."""
    hpath, fs = _folder(spark, landing)
    fs.mkdirs(hpath(f"{landing}/notices"))
    reader = spark.readStream.schema(NOTICE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = complete_months(reader.json(f"{landing}/notices"), patience_ms)

    def on_batch(batch: DataFrame, epoch: int) -> None:
        found = [r.asDict() for r in batch.collect()]  # at most a row per month with news
        done = [r for r in found if r["status"] == "complete"]
        if done:
            publish_months(batch.sparkSession, done, target, loaded_at, columns)
        if events_path and found:
            batch.sparkSession.createDataFrame([(r["_month_code"], r["status"], r["version"], len(r["folders"])) for r in found],
                                               "_month_code string, status string, version int, parts int").write.mode("overwrite").parquet(
                f"{events_path}/batch={epoch}")

    tasks = min(STATE_TASKS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # map state and timers need that store; the query keeps what it starts with, a checkpoint what it began with
    with _during(spark, STORE, ROCKSDB), _during(spark, "spark.sql.shuffle.partitions", str(tasks)):
        w = events.writeStream.outputMode("update").foreachBatch(on_batch).option("checkpointLocation", checkpoint)
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")).start()


def publish_available(spark: SparkSession, *args, **options) -> None:
    """Take in every notice there is, then stop (scheduled runs)."""
    q = start_publication(spark, *args, **options)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
