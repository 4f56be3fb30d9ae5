"""Ordered features: exponentially weighted means, small-table ranks and running shares.

The weighted mean follows adjusted weights: with decay ``r = 1 - alpha`` the value of row ``t`` is
``sum(x_i r^(t-i)) / sum(r^(t-i))`` over the non-missing rows up to ``t``. A missing row ages the
weights and repeats the last value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.columns import all_present
from riskloom.operators.aggregate import KeyCounts, key_counts, small_enough
from riskloom.session import checkpointed, task_count

HOT_KEY_ROWS = 1_000_000
ROWS_PER_TASK = 1_000_000
# rows of a task that folds whole keys: at least, while cores are idle, and at most
FEW_SORTED, MANY_SORTED = 50_000, 250_000


def _targets(columns: Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    return dict(columns) if isinstance(columns, Mapping) else {f"EXP_{c}": c for c in columns}


def ewm_mean(
    df: DataFrame,
    columns: Sequence[str] | Mapping[str, str],
    keys: Sequence[str],
    order: Sequence[str],
    alpha: float,
    hot_rows: int | None = HOT_KEY_ROWS,
    position: str | None = None,
    by_key: bool = False,
    seen: KeyCounts | None = None,
) -> DataFrame:
    """Exponentially weighted mean per key, added as ``EXP_<column>`` (or the given names).

    ``position`` names an extra column with the row's place in its key, from 0; later first/last aggregates
    can use this one number instead of the order columns.

    Rows are dealt by key and sorted once, and the means are folded over the sorted rows as they stream past in
    Arrow batches, many keys at a time; no key is held. Keys with more than ``hot_rows`` rows, found by a count
    of the key columns alone, are cut by range over many tasks instead. ``hot_rows=None`` skips the count.
    The same count gives the number of tasks. With ``by_key`` the result is dealt by key over as many tasks, for wide
    aggregates by key, whose memory then depends on the rows of a task and not on the size of the table; a table
    with hot keys is left to partial aggregates. ``seen`` is the count, where it has been made.
    """
    if not order:
        raise ValueError("an exponentially weighted mean needs an explicit order with a unique tie-break")
    targets = _targets(columns)
    rows = df.filter(all_present(keys))
    if hot_rows is None:
        return _ewm_sorted(rows, targets, keys, order, alpha, position)
    seen = seen or key_counts(rows, keys)
    tasks = task_count(seen.rows, df.sparkSession.sparkContext.defaultParallelism, FEW_SORTED, MANY_SORTED)
    if seen.most <= hot_rows:
        out = _ewm_sorted(rows, targets, keys, order, alpha, position, tasks)
        return out.repartition(tasks, *keys) if by_key and tasks > 1 else out
    hot = rows.groupBy(*keys).count().filter(F.col("count") > hot_rows).select(*keys)
    marked = F.broadcast(hot) if small_enough(hot) else hot
    cold = _ewm_sorted(rows.join(marked, list(keys), "left_anti"), targets, keys, order, alpha, position, tasks)
    wide = _ewm_ranged(rows.join(marked, list(keys), "left_semi"), targets, keys, order, alpha, position)
    return cold.unionByName(wide)


def ewm_mean_global(
    df: DataFrame,
    columns: Sequence[str] | Mapping[str, str],
    order: Sequence[str],
    alpha: float,
    position: str | None = None,
) -> DataFrame:
    """The same mean over the whole table in one global order."""
    return _ewm_ranged(df, _targets(columns), [], order, alpha, position)


def _ewm_scan(x: np.ndarray, starts: np.ndarray, decay: float, carry: tuple[np.ndarray, np.ndarray] | None):
    """Weighted means of consecutive rows; ``starts`` marks the first row of each key and ``carry``
    is the (mean, weight) reached before row 0. The recurrence is solved by doubling."""
    n = len(x)
    valid = ~np.isnan(x)
    num = np.where(valid, x, 0.0)
    den = valid.astype(float)
    factor = np.where(starts, 0.0, decay)
    if carry is not None and not starts[0]:
        mean, weight = carry
        num[0] += decay * np.nan_to_num(mean) * weight
        den[0] += decay * weight
    factor[0] = 0.0
    step = 1
    while step < n and factor.any():
        num[step:] += factor[step:, None] * num[:-step].copy()
        den[step:] += factor[step:, None] * den[:-step].copy()
        factor[step:] *= factor[:-step].copy()
        factor[:step] = 0.0
        step *= 2
    with np.errstate(invalid="ignore", divide="ignore"):
        fresh = np.where(valid, num / den, np.nan)
    at = np.arange(n)[:, None]
    source = np.maximum.accumulate(np.where(valid | starts[:, None], at, 0), axis=0)
    held = np.take_along_axis(fresh, source, axis=0)
    if carry is not None and not starts[0]:
        first_key = np.cumsum(starts) == 0
        held = np.where(first_key[:, None] & np.isnan(held), carry[0], held)
    return held, (held[-1], den[-1])


class _Fold:
    """Weighted means and places of sorted rows, batch after batch. The state is what the last row left:
    its key, mean and weight per column, and the rows of its key so far."""

    def __init__(self, keys: Sequence[str], sources: Sequence[str], decay: float, state=None) -> None:
        self.keys, self.sources, self.decay = list(keys), list(sources), decay
        self.key, self.reached, self.rows = state if state else (None, None, 0)

    def _starts(self, batch: pa.RecordBatch) -> np.ndarray:
        starts = np.zeros(batch.num_rows, bool)
        for name in self.keys:
            column = batch.column(name)
            starts[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        first = [batch.column(name)[0].as_py() for name in self.keys]
        starts[0] = self.key is None or first != self.key
        self.key = [batch.column(name)[-1].as_py() for name in self.keys]
        return starts

    def step(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Means (rows x columns) and places of one batch."""
        starts = self._starts(batch)
        x = np.column_stack([pc.cast(batch.column(c), pa.float64(), safe=False).to_numpy(zero_copy_only=False) for c in self.sources])
        held, self.reached = _ewm_scan(x, starts, self.decay, self.reached)
        at = np.arange(len(starts))
        since = np.maximum.accumulate(np.where(starts, at, -1))
        place = np.where(since >= 0, at - since, at + self.rows)
        self.rows = int(place[-1]) + 1
        return held, place


def _folded(kept: Sequence[str], targets: Mapping[str, str], position: str | None):
    """One output batch: the kept columns as they came, the means, and the place."""

    def out(batch: pa.RecordBatch, held: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        made = [pa.array(held[:, i], mask=np.isnan(held[:, i])) for i in range(held.shape[1])]
        made += [pa.array(place.astype(np.int64))] if position else []
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=[*kept, *targets, *([position] if position else [])])

    return out


def _folded_schema(df: DataFrame, targets: Mapping[str, str], position: str | None) -> T.StructType:
    added = [T.StructField(t, T.DoubleType()) for t in targets] + ([T.StructField(position, T.LongType())] if position else [])
    return T.StructType([*df.schema.fields, *added])


def _ewm_sorted(
    df: DataFrame, targets: Mapping[str, str], keys: Sequence[str], order: Sequence[str], alpha: float, position: str | None,
    tasks: int = 1,
) -> DataFrame:
    """One exchange by key and one sort; every key is folded inside one task without being held. More than one of
    ``tasks`` fixes their number."""
    decay, sources, kept, names = 1.0 - alpha, list(targets.values()), list(df.columns), list(keys)
    out = _folded(kept, targets, position)

    def run(batches):
        fold = _Fold(names, sources, decay)
        for batch in batches:
            if batch.num_rows:
                yield out(batch, *fold.step(batch))

    dealt = (df.repartition(tasks, *keys) if tasks > 1 else df.repartition(*keys)).sortWithinPartitions(*[F.asc_nulls_last(c) for c in [*keys, *order]])
    return dealt.mapInArrow(run, _folded_schema(df, targets, position))


def _ewm_ranged(
    df: DataFrame, targets: Mapping[str, str], keys: Sequence[str], order: Sequence[str], alpha: float, position: str | None
) -> DataFrame:
    """Range-partitioned form for a global order or for keys too long for one task.

    Rows are range-partitioned by key and order (so one key spreads over tasks, as many as the counted rows
    need) and checkpointed, which fixes the partitions. One pass over keys and values reduces every partition to
    the state it ends in, one row per partition; the states are chained on the driver, and a second pass applies them.
    """
    decay, sources, kept, names = 1.0 - alpha, list(dict.fromkeys(targets.values())), list(df.columns), list(keys)
    columns = list(targets.values())
    sort = [F.asc_nulls_last(c) for c in [*keys, *order]]
    parts = max(2, -(-df.count() // ROWS_PER_TASK))
    ranged = checkpointed(df.repartitionByRange(parts, *sort).sortWithinPartitions(*sort).withColumn("__part", F.spark_partition_id()))

    def ends(batches):
        part, first, fold = None, None, _Fold(names, columns, decay)
        for batch in batches:
            if batch.num_rows:
                if part is None:
                    part, first = batch.column("__part")[0].as_py(), repr([batch.column(c)[0].as_py() for c in names])
                fold.step(batch)
        if part is not None:
            last = repr(fold.key)
            mean, weight = fold.reached
            yield pa.RecordBatch.from_pylist([{"part": part, "first": first, "last": last, "rows": fold.rows, "mean": [None if np.isnan(m) else float(m) for m in mean], "weight": [float(w) for w in weight]}], schema=ends_schema)

    ends_schema = pa.schema([("part", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("rows", pa.int64()), ("mean", pa.list_(pa.float64())), ("weight", pa.list_(pa.float64()))])
    text = "part int, first string, last string, rows long, mean array<double>, weight array<double>"
    narrow = ranged.select("__part", *names, *[c for c in sources if c not in set(names)])
    carries, carried = {}, None
    for row in sorted(narrow.mapInArrow(ends, text).collect()):  # one row per partition
        mean = np.array([np.nan if m is None else m for m in row["mean"]], dtype=float)
        weight, rows = np.array(row["weight"], dtype=float), row["rows"]
        if carried is not None:
            carries[row["part"]] = carried
            # only a partition that holds nothing but the carried key passes that state on
            if row["first"] == carried[0] == row["last"]:
                aged = carried[2] * decay**rows
                total = weight + aged
                with np.errstate(invalid="ignore", divide="ignore"):
                    both = (np.nan_to_num(mean) * weight + np.nan_to_num(carried[1]) * aged) / total
                mean = np.where(total > 0, both, np.where(np.isnan(mean), carried[1], mean))
                weight, rows = total, rows + carried[3]
        carried = (row["last"], mean, weight, rows)

    out = _folded(kept, targets, position)

    def apply(batches):
        fold = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if fold is None:
                found = carries.get(batch.column("__part")[0].as_py())
                first = [batch.column(c)[0].as_py() for c in names]
                # a state of another key starts afresh
                state = (first, (found[1], found[2]), found[3]) if found is not None and found[0] == repr(first) else None
                fold = _Fold(names, columns, decay, state)
            yield out(batch, *fold.step(batch))

    return ranged.mapInArrow(apply, _folded_schema(df, targets, position))


# -- tables with one row per feature, level or threshold ------------------------------------------


def rank_by(df: DataFrame, value: str, tie: str, name: str = "ranking") -> DataFrame:
    """Zero-based position in a descending sort; for tables with one row per feature."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(F.desc_nulls_last(value), F.asc(tie))) - 1)


def cumulative_share(df: DataFrame, value: str, tie: str) -> DataFrame:
    """Value normalised to sum 1 and cumulated from the largest on; one row per feature."""
    ranked = Window.orderBy(F.desc_nulls_last(value), F.asc(tie))
    total = F.sum(value).over(Window.partitionBy(F.lit(0)))
    return df.withColumn("share", F.try_divide(F.col(value), total)).withColumns(
        {
            "position": F.row_number().over(ranked),
            "cumulative": F.sum("share").over(ranked.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )


def needed_for_share(df: DataFrame, value: str, tie: str, threshold: float = 0.9) -> DataFrame:
    """How many of the largest entries are needed to pass a cumulative share."""
    return cumulative_share(df, value, tie).filter(F.col("cumulative") > threshold).agg(F.min("position").alias("needed"))


def minmax_scale(df: DataFrame, value: str, name: str) -> DataFrame:
    everything = Window.partitionBy(F.lit(0))
    low, high = F.min(value).over(everything), F.max(value).over(everything)
    return df.withColumn(name, F.try_divide(F.col(value) - low, high - low))
