"""Hundreds of statistics per key, folded over rows that are dealt and sorted by key.

Hundreds of SQL aggregates become generated code too long to be compiled, and a plan of that width takes seconds.
Here each Arrow batch is cut at the changes of key, and a statistic is one reduction over the whole batch. The key a
batch ends in stays open as one number and one count per statistic, so no key is held however long it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_WHOLE = {T.ByteType: np.int8, T.ShortType: np.int16, T.IntegerType: np.int32, T.LongType: np.int64}
_REAL = {T.FloatType: np.float32, T.DoubleType: np.float64}
_NUMBERS = _WHOLE | _REAL
KEYS = (*_WHOLE, T.StringType)


@dataclass(frozen=True)
class Wanted:
    """One output column: a statistic of a column over the rows where the boolean column ``where`` holds (all rows if None)."""

    name: str
    stat: str
    column: str
    where: str | None = None


def foldable(df: DataFrame, keys: Sequence[str], wanted: Sequence[Wanted]) -> bool:
    """Whether keys and values have kinds whose order and sums are the same here as in SQL."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return all(isinstance(kinds[k], KEYS) for k in keys) and all(type(kinds[w.column]) in _NUMBERS for w in wanted)


def _kind(kind: T.DataType, stat: str) -> T.DataType:
    if stat == "mean":
        return T.DoubleType()
    if stat == "count":
        return T.LongType()
    if stat == "sum":
        return T.LongType() if type(kind) in _WHOLE else T.DoubleType()
    return kind


def sorted_fold(rows: DataFrame, keys: Sequence[str], wanted: Sequence[Wanted]) -> DataFrame:
    """One row per key, with the missing-value rules of ``aggregate.statistic``. The rows of a key must lie in one task, one
    after the other; first and last follow their order there."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    keys, wanted = list(keys), list(wanted)
    used = list(dict.fromkeys([*keys, *(w.column for w in wanted), *(w.where for w in wanted if w.where)]))
    made = [_kind(kinds[w.column], w.stat) for w in wanted]
    dtypes = [_NUMBERS[type(k)] for k in made]

    def run(batches):
        fold = _Fold(keys, wanted, dtypes)
        for batch in batches:
            if batch.num_rows:
                yield from fold.step(batch)
        yield from fold.rest()

    schema = T.StructType([T.StructField(k, kinds[k]) for k in keys] + [T.StructField(w.name, k) for w, k in zip(wanted, made, strict=True)])
    return rows.selectExpr(*[f"`{c}`" for c in used]).mapInArrow(run, schema)


class _Batch:
    """Columns, conditions and their counts of one batch, each read once however many statistics use them."""

    def __init__(self, batch: pa.RecordBatch, at: np.ndarray) -> None:
        self.batch, self.at, self.n, self.kept = batch, at, batch.num_rows, {}

    def _once(self, key: tuple, make):
        if key not in self.kept:
            self.kept[key] = make()
        return self.kept[key]

    def _read(self, column: str) -> tuple[np.ndarray, np.ndarray | None]:
        x = self.batch.column(column)
        if not x.null_count:
            return x.to_numpy(zero_copy_only=False), None
        return pc.fill_null(x, 0).to_numpy(zero_copy_only=False), x.is_valid().to_numpy(zero_copy_only=False)

    def inside(self, where: str | None) -> np.ndarray | None:
        return None if where is None else self._once(("in", where), lambda: pc.fill_null(self.batch.column(where), False).to_numpy(zero_copy_only=False))

    def counted(self, rows: np.ndarray | None) -> np.ndarray:
        return np.diff(np.append(self.at, self.n)) if rows is None else np.add.reduceat(rows, self.at, dtype=np.int64)

    def rows_inside(self, where: str | None) -> np.ndarray:
        return self._once(("rows", where), lambda: self.counted(self.inside(where)))

    def values(self, column: str, where: str | None):
        """Values, which of them are present and inside (None: all), and how many a key has of those."""

        def make():
            x, present = self._once(("x", column), lambda: self._read(column))
            inside = self.inside(where)
            some = present if inside is None else inside if present is None else present & inside
            return x, some, self.counted(some)

        return self._once(("values", column, where), make)

    def reduced(self, w: Wanted) -> tuple[np.ndarray, np.ndarray]:
        """Per key how many rows a statistic rests on, and its value."""
        x, some, n = self.values(w.column, w.where)
        whole = x.dtype.kind == "i"
        if w.stat == "count":
            return n, n
        if w.stat in ("sum", "mean"):
            dtype = np.int64 if whole and w.stat == "sum" else np.float64
            total = self._once((dtype, w.column, w.where), lambda: _total(x if some is None else np.where(some, x, 0), self.at, dtype))
            return (self.rows_inside(w.where) if w.stat == "sum" else n), total
        if w.stat in ("min", "max"):
            # a NaN is the largest value: it wins every maximum, and a minimum only where there is nothing else
            none = {"min": np.iinfo(x.dtype).max, "max": np.iinfo(x.dtype).min} if whole else {"min": np.nan, "max": -np.inf}
            filled = x if some is None else np.where(some, x, x.dtype.type(none[w.stat]))
            found = (np.fmin if w.stat == "min" else np.maximum).reduceat(filled, self.at)
            zero = filled == 0
            if not whole and (zero & np.signbit(filled)).any():
                # of equal zeros the first one stays, as in SQL
                found = np.where(found == 0, filled[np.minimum.reduceat(np.where(zero, np.arange(self.n), self.n - 1), self.at)], found)
            return n, found
        place = np.arange(self.n)
        if w.stat == "first":
            found = np.minimum.reduceat(place if some is None else np.where(some, place, self.n - 1), self.at)
        else:
            found = np.maximum.reduceat(place if some is None else np.where(some, place, 0), self.at)
        return n, x[found]


def _total(x: np.ndarray, at: np.ndarray, dtype: type) -> np.ndarray:
    """Sums per key; whole numbers that pass the range of a long are an error, as in SQL."""
    if dtype is np.int64 and max(-float(x.min()), float(x.max())) * len(x) >= 2.0**62:
        sums = [sum(part.tolist()) for part in np.split(x, at[1:])]
        if not all(-(2**63) <= s < 2**63 for s in sums):
            raise OverflowError("a sum passes the range of a long")
        return np.array(sums, np.int64)
    # a sum starts from zero, so it is no negative zero
    return np.add.reduceat(x, at, dtype=dtype) + dtype(0)


def _joined(stat: str, n0, x0, n, x):
    """A statistic over the earlier rows of a key and its later ones."""
    if stat == "sum" and isinstance(x, np.int64) and not -(2**63) <= int(x0) + int(x) < 2**63:
        raise OverflowError("a sum passes the range of a long")
    if stat in ("count", "sum", "mean"):
        return n0 + n, x0 + x
    if not n0 or not n:
        return (n0, x0) if n0 else (n, x)
    if stat in ("min", "max") and x0 == x:
        return n0 + n, x0
    return n0 + n, {"min": np.fmin, "max": np.maximum, "first": lambda a, b: a, "last": lambda a, b: b}[stat](x0, x)


class _Fold:
    """Statistics of sorted rows, batch after batch; ``open`` is the key the last row belongs to, with its statistics so far."""

    def __init__(self, keys: Sequence[str], wanted: Sequence[Wanted], dtypes: Sequence[type]) -> None:
        self.keys, self.wanted, self.dtypes = keys, wanted, dtypes
        self.open: tuple[list, list] | None = None

    def _out(self, keys: list[pa.Array], found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        out = []
        for w, dtype, (n, x) in zip(self.wanted, self.dtypes, found, strict=True):
            if w.stat == "mean":
                x = x / np.maximum(n, 1)
            never = w.stat == "count" or (w.stat == "sum" and w.where is None)
            out.append(pa.array(x.astype(dtype, copy=False), mask=None if never else n == 0))
        return pa.RecordBatch.from_arrays([*keys, *out], names=[*self.keys, *(w.name for w in self.wanted)])

    def step(self, batch: pa.RecordBatch):
        starts = np.zeros(batch.num_rows, bool)
        starts[0] = True
        for k in self.keys:
            c = batch.column(k)
            starts[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(starts)
        keys = [batch.column(k).take(pa.array(at)) for k in self.keys]
        of = _Batch(batch, at)
        found = [of.reduced(w) for w in self.wanted]
        if self.open is not None:
            if [k[0].as_py() for k in keys] == [k[0].as_py() for k in self.open[0]]:
                merged = []
                for w, (n0, x0), (n, x) in zip(self.wanted, self.open[1], found, strict=True):
                    n, x = n.copy(), x.copy()
                    n[0], x[0] = _joined(w.stat, n0[0], x0[0], n[0], x[0])
                    merged.append((n, x))
                found = merged
            else:
                yield self._out(*self.open)
        if len(at) > 1:
            yield self._out([k.slice(0, len(k) - 1) for k in keys], [(n[:-1], x[:-1]) for n, x in found])
        self.open = [k.slice(len(k) - 1) for k in keys], [(n[-1:], x[-1:]) for n, x in found]

    def rest(self):
        if self.open is not None:
            yield self._out(*self.open)
