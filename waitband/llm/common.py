"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes of text that one Arrow batch of rows is cut into before a task works on it.
BLOCK_BYTES = 8 << 20


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared scratch folder and read it
    back.  The files are replicated by the shared store, so a lost executor
    costs nothing that was written."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row, however often the
    body names it or a lambda inside it runs."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def narrow(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` with just ``columns`` (name -> SQL type), cast; whatever else it
    carries can not clash with the names an operator adds."""
    return df.select(*[df[c].cast(t).alias(c) for c, t in columns.items()])


def text_blocks(texts: list, limit: int = BLOCK_BYTES):
    """Index ranges of ``texts`` holding about ``limit`` characters each; one
    text longer than that makes a block by itself."""
    start = held = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


#: What a Python worker keeps between the tasks of one operator.
_KEPT: dict = {}


def kept(name: str, make: Callable):
    """A worker's large tables, made once and held until it works on something else."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def drop_others(keep: str) -> None:
    if keep not in _KEPT:
        _KEPT.clear()


def give_back() -> None:
    """Freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def tidy(run: Callable[[Iterator], Iterator], keep: str = "") -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow.  Workers outlive tasks and operators: what another
    operator kept goes before the task, and freed memory goes back to the system
    after it, so that the stages of a long job do not add up."""
    def tidied(batches):
        # functions of this module, so that the worker's own table is meant and not a copy sent along
        drop_others(keep)
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied
