"""Helpers that several operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tellurion.session import run_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def staged(frame: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write a frame to a new folder of the shared checkpoint folder and read it back.

    ``batch_rows`` bounds the Arrow batches of this write, which both the JVM and
    the Python worker hold whole; the session's own number stays as it was.
    """
    spark = frame.sparkSession
    path = f"{run_folder(spark, name)}/rows"
    before = spark.conf.get(BATCH_ROWS)
    try:
        if batch_rows and (int(before) <= 0 or int(before) > batch_rows):
            spark.conf.set(BATCH_ROWS, batch_rows)
        frame.write.parquet(path)
    finally:
        spark.conf.set(BATCH_ROWS, before)
    return spark.read.schema(frame.schema).parquet(path)


#: Tables that a Python worker keeps between tasks, by the operator that fills them.
KEPT: dict[str, Callable[[], None]] = {}


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keep: str = ""):
    """A map over batches that starts without the tables of other operators.

    Python workers serve one stage after another; what earlier operators keep
    would add up. When a task ends, it gives free memory back.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for operator, clear in KEPT.items():
            if operator != keep:
                clear()
        trim()
        yield from run(batches)
        trim()

    return task


def trim() -> None:
    """Give freed memory of this Python worker back."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def parallel(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column, and the offsets of its rows (nulls: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column over one buffer, cut at the offsets (in bytes)."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)],
    ).cast(pa.binary())


def chunks(sizes: np.ndarray, most: int):
    """Ranges of rows whose sizes add up to about ``most``, each of one row at least."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield start, stop
        start = stop


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every range, one range after another."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])


