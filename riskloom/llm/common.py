"""Helpers shared by the operators: task counts from counted bytes, checked broadcasts, Arrow columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = "[^\\x20\\x09-\\x0D]+"
BROADCAST_ROWS = 100_000


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def n_words(column: str = "text") -> Column:
    """Number of maximal runs of characters other than ASCII white space; 0 for null."""
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def parts_for(amount: float, each: float, least: int = 12) -> int:
    """So many tasks that each gets about ``each`` of the ``amount``."""
    return max(least, int(-(-amount // each)))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts, from one scan of that column."""
    return docs.select(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only where the counted rows stay under the bound; else the planner decides."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, rows: int = 500):
    """A batch in short runs of rows, so that few texts are Python objects at a time."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string or binary column without copying; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind, size = (np.int64, 8) if wide else (np.int32, 4)
    _, at, data = column.buffers()
    if at is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(at, kind, len(column) + 1, column.offset * size).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, most: int):
    """Cut rows into runs of at most ``most`` bytes (a longer row is a run of its own)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def binary_column(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column from an array and row offsets counted in its items."""
    raw = np.ascontiguousarray(values)
    at = (np.asarray(offsets, np.int64) * raw.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)])
