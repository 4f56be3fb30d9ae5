"""Count, range, mean and deviation of any number of numeric columns from one scan.

Every task keeps five arrays with one entry per column and sends one row per column; the rows of a column are
merged by the usual update of mean and squared deviations, so nothing cancels. The plan does not grow with the
columns, which hundreds of SQL aggregates do not survive.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.session import shared_folder

_FIELDS = ["present", "low", "high", "mean", "m2"]
_SCHEMA = "c int, present long, low double, high double, mean double, m2 double"


@dataclass(frozen=True)
class Moments:
    present: int
    low: float | None
    high: float | None
    mean: float | None
    deviation: float | None  # of the population


def merged(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Moments of two disjoint sets of rows."""
    n = a[0] + b[0]
    with np.errstate(invalid="ignore", divide="ignore"):
        share = np.where(n > 0, b[0] / np.maximum(n, 1), 0.0)
        gap = np.where((a[0] > 0) & (b[0] > 0), b[3] - a[3], 0.0)
    mean = np.where(a[0] > 0, a[3] + gap * share, b[3])
    return n, np.fmin(a[1], b[1]), np.fmax(a[2], b[2]), mean, a[4] + b[4] + gap * gap * a[0] * share


def _of(x: np.ndarray) -> tuple[np.ndarray, ...]:
    present = ~np.isnan(x)
    n = present.sum(0)
    mean = np.where(present, x, 0.0).sum(0) / np.maximum(n, 1)
    mean = mean + np.where(present, x - mean, 0.0).sum(0) / np.maximum(n, 1)
    low, high = np.where(present, x, np.inf).min(0), np.where(present, x, -np.inf).max(0)
    return n, np.where(n > 0, low, np.nan), np.where(n > 0, high, np.nan), np.clip(mean, low, high), (np.where(present, x - mean, 0.0) ** 2).sum(0)


def matrix(batch: pa.RecordBatch, fills: np.ndarray | None = None) -> np.ndarray:
    """A batch of double columns, or of one array column, as rows x columns; missing values are NaN, or what ``fills`` has for them."""
    if batch.num_columns and pa.types.is_list(batch.schema.field(0).type):
        flat = batch.column(0).flatten()
        x = flat.to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        return x if fills is None or not flat.null_count else np.where(flat.is_null().to_numpy(zero_copy_only=False).reshape(x.shape), fills, x)
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])


@dataclass(frozen=True)
class Numbers:
    """Numeric columns as one array column, missing values filled as ``fills`` says."""

    table: DataFrame
    columns: Sequence[str]
    fills: Mapping[str, float] = field(default_factory=dict)

    def filled(self, values: Mapping[str, float]) -> Numbers:
        return replace(self, fills=values)

    def vector(self) -> np.ndarray | None:
        return np.array([self.fills.get(c, np.nan) for c in self.columns]) if self.fills else None


def columns_of(df: DataFrame, cs: Sequence[str]) -> Numbers:
    """The columns side by side, read anew by every pass."""
    return Numbers(df.selectExpr(*[f"cast(`{c}` as double) AS c{i}" for i, c in enumerate(cs)]), list(cs))


def kept_numbers(df: DataFrame, cs: Sequence[str]) -> Numbers:
    """The columns written once as one array, for several decisions over them: planning a pass over hundreds
    of columns and compiling its projections takes longer than the pass."""
    path = shared_folder(df.sparkSession)
    df.selectExpr("array(" + ", ".join(f"cast(`{c}` as double)" for c in cs) + ") AS x").write.parquet(path)
    return Numbers(df.sparkSession.read.parquet(path), list(cs))


def column_moments(df: DataFrame, cs: Sequence[str], numbers: Numbers | None = None) -> dict[str, Moments]:
    """Moments of numeric columns; NaN counts as missing. One row per column reaches the driver. ``numbers`` are the
    kept columns, where there are any."""
    cs = list(cs)
    if not cs:
        return {}
    numbers = numbers or columns_of(df, cs)
    fills = numbers.vector()

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = _of(matrix(batch, fills))
                total = part if total is None else merged(total, part)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total[0])), pa.int32()), pa.array(total[0].astype(np.int64)), *[pa.array(t.astype(float)) for t in total[1:]]], names=["c", *_FIELDS])

    def combine(group: pa.Table) -> pa.Table:
        rows = list(zip(*(group[f].to_numpy() for f in _FIELDS), strict=True))
        total = tuple(np.array(v) for v in rows[0])
        for r in rows[1:]:
            total = merged(total, tuple(np.array(v) for v in r))
        return pa.table({"c": group["c"].slice(0, 1), "present": pa.array([int(total[0])], pa.int64()), **{f: pa.array([float(t)]) for f, t in zip(_FIELDS[1:], total[1:], strict=True)}})

    found = {r["c"]: r for r in numbers.table.mapInArrow(run, _SCHEMA).groupBy("c").applyInArrow(combine, _SCHEMA).collect()}
    out = {}
    for i, c in enumerate(cs):
        r = found.get(i)
        if r is None or not r["present"]:
            out[c] = Moments(0, None, None, None, None)
        else:
            out[c] = Moments(r["present"], r["low"], r["high"], r["mean"], 0.0 if r["low"] == r["high"] else float(np.sqrt(r["m2"] / r["present"])))
    return out
