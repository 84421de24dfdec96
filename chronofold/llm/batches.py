"""Bounds on the batches that Spark hands to Python."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 16 * 1024 * 1024
BATCH_ROWS = 2_000


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small for the rest of the session, so that long texts do not add up.

    A batch ends at the first of both limits; a single row may exceed them.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, and at the end of a task its freed memory back to the system: Python workers live on, idle, in
    the memory of their executor."""

    def then_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return then_release


def valid_text(column: str = "text") -> Column:
    """The column as text; bytes that are no UTF-8, which Python could not read, stand as U+FFFD."""
    return F.make_valid_utf8(F.col(column).cast("string"))
