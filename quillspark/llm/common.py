"""Shared helpers: batch bounds, inputs."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quillspark.storage import materialize, scratch, table

__all__ = ["BATCH_ROWS", "WORD", "bounded", "map_arrow", "materialize", "pieces", "scratch", "table"]

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of text that become Python objects at a time.
BATCH_ROWS = 256
_ROWS, _DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def bounded(spark: SparkSession) -> None:
    """Small Arrow batches for texts where the session has Spark's default; a value of its own stays as it is.

    Spark's own batches are of up to 64 MB, and executors keep buffers of that size for every Python stage.
    """
    if spark.conf.get(_ROWS) == _DEFAULT:
        spark.conf.set(_ROWS, str(BATCH_ROWS))


def _give_back() -> None:
    """Returns freed memory to the system: workers wait for further tasks beside those that work."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:  # another C library
            return


def pieces(batches: Iterable[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Runs of at most `rows` rows, none empty. Spark cuts its batches by bytes; Python objects take several times as many."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    _give_back()


def map_arrow(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    bounded(df.sparkSession)
    return df.mapInArrow(lambda batches: map(f, pieces(batches)), schema)
