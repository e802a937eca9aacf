"""What Python workers keep and are sent: small batches, and memory given back after a task."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What this worker keeps from task to task, by name, and how to drop it. A worker serves one operator after
#: another, and keeps the store of one at a time.
STORES: dict[str, Callable[[], None]] = {}

#: Bytes of a batch that is sent to a worker; a single row may be longer.
BATCH = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of this session by bytes: 10,000 long texts at once, in both processes, are too many."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def release() -> None:
    """Give free memory back to the system; reused workers would hold the most any task needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it keeps what it likes


def only(keeps: str | None) -> None:
    """Drop every store but one."""
    others = [name for name in STORES if name != keeps]
    for name in others:
        STORES.pop(name)()
    if others:
        release()


def mapped(rows: DataFrame, work: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema,
           keeps: str | None = None) -> DataFrame:
    """``rows.mapInArrow(work, schema)``; stores other than ``keeps`` are dropped before a task, and the
    worker's free memory is given back after it."""
    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(keeps)
        yield from work(batches)
        release()

    return rows.mapInArrow(of, schema)


def column_of(kind: str, work: Callable[[Iterable[pa.Array]], Iterator[pa.Array]], column: str) -> Column:
    """A column made of one other by arrays; no other column is sent to the workers."""
    def of(arrays: Iterable[pa.Array]) -> Iterator[pa.Array]:
        only(None)
        yield from work(arrays)
        release()

    of.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(of, kind)(F.col(column))
