"""What several of these operators need: readable ids, stored intermediate tables, Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import stored, stored_alone
from riskloom.sources.tables import read_table

BATCH_ROWS = 1024
BATCH_BYTES = 2 << 20

__all__ = [
    "fold", "give_back", "read_table", "release_heap", "slices", "small_batches", "stored", "stored_alone", "text_rows", "tidy",
]


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES`` (one row at least):
    texts may be long, and both the JVM and Python hold a batch outside the heap."""
    rows, size = (f"spark.sql.execution.arrow.{k}" for k in ("maxRecordsPerBatch", "maxBytesPerBatch"))
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    if spark.conf.get(size, None) is None:  # unless the session sets its own
        spark.conf.set(size, BATCH_BYTES)


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the text (null: empty) under fixed names, whatever other columns there are."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def fold(parts: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id falls in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts, F.lit(0))


@functools.cache
def _libc() -> ctypes.CDLL | None:
    """The C library, told once to serve large blocks from the system and keep few arenas, so
    that freed arrays leave the process; None where it is another one."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 1 << 18)  # M_MMAP_THRESHOLD, which then no longer grows
        libc.mallopt(-8, 2)  # M_ARENA_MAX
        pa.set_memory_pool(pa.system_memory_pool())
    except (OSError, AttributeError):
        return None
    return libc


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks, beside the
    executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if (libc := _libc()) is not None:
        libc.malloc_trim(0)


def release_heap(spark: SparkSession) -> None:
    """Have every executor collect its garbage now. A JVM keeps the heap it once grew to, while
    Python workers need memory beside it; after a collection it returns what is free. One task
    for each core, so between large steps only."""
    cores = spark.sparkContext.defaultParallelism
    collect = F.call_function("java_method", F.lit("java.lang.System"), F.lit("gc"))
    spark.range(0, cores, 1, cores).select(collect).write.format("noop").mode("overwrite").save()


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that gives its memory back at its end."""

    @functools.wraps(work)
    def run(batches: Iterator) -> Iterator:
        _libc()
        yield from work(batches)
        give_back()

    return run


def slices(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text each (one row at least)."""
    for batch in batches:
        size = max(1, batch.nbytes)
        rows = max(1, int(batch.num_rows * min(1.0, most / size)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
