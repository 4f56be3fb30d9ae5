"""Exact order statistics of many columns at once, whatever the number of rows or columns.

One form for every table. A row sample (``SAMPLE_ROWS`` expected, all rows of a smaller table) gives each wanted
rank a bracket of values wide enough for the sampling error. One scan then counts, per column and rank, the values
below the bracket and lists those inside it as (rank, value, count) cells, pre-counted per task. Cells are summed,
cut by range of (rank, value) so that a column with most cells spreads over tasks, and ranked from the totals of
the ranges. The counts prove the result; a rank that fell outside its bracket is looked for again in a wider one.

Only the brackets and the results reach the driver: two numbers per wanted quantile.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.moments import Numbers, columns_of, matrix
from riskloom.session import checkpointed

SAMPLE_ROWS = 200_000
# standard deviations of the sampled rank that a bracket reaches to either side
REACH = 5.0
_INF = float("inf")
_FLUSH = 1 << 21


def _valid(x: np.ndarray) -> np.ndarray:
    """Sorted present values; NaN counts as missing."""
    return np.sort(x[~np.isnan(x)])


def _sampled(numbers: DataFrame, rate: float, d: int) -> DataFrame:
    """Values of the sampled rows in long form: one row per task, batch and column."""
    rows = numbers if rate >= 1.0 else numbers.sample(rate, seed=17)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                xs = [_valid(x) for x in matrix(batch).T]
                yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(xs, pa.list_(pa.float64()))], names=["c", "xs"])

    return rows.mapInArrow(run, "c int, xs array<double>")


def _by_column(sampled: DataFrame, d: int) -> DataFrame:
    """Sampled values dealt by column over a fixed number of tasks; by their bytes all columns may be one task's work."""
    return sampled.repartition(min(d, 4 * sampled.sparkSession.sparkContext.defaultParallelism), "c")


def _brackets(numbers: DataFrame, d: int, probs: Sequence[float], rate: float, reach: float) -> dict[tuple[int, int], tuple[float, float]]:
    """For every (column, quantile) the sampled values around its rank."""

    def run(group: pa.Table) -> pa.Table:
        x = np.sort(pc.list_flatten(group["xs"]).to_numpy())
        m, low, high = len(x), [], []
        for p in probs:
            spread = 0.0 if rate >= 1.0 else reach * math.sqrt(max(m * p * (1 - p), 1.0)) + 1
            a, b = math.floor(p * (m - 1) - spread), math.ceil(p * (m - 1) + spread)
            low.append(x[a] if 0 <= a < m else -_INF)
            high.append(x[b] if 0 <= b < m else _INF)
        return pa.table({"c": pa.array([group["c"][0].as_py()] * len(probs), pa.int32()), "p": pa.array(range(len(probs)), pa.int32()), "low": low, "high": high})

    found = _by_column(_sampled(numbers, rate, d), d).groupBy("c").applyInArrow(run, "c int, p int, low double, high double").collect()
    return {(r["c"], r["p"]): (r["low"], r["high"]) for r in found}


def _cells(numbers: DataFrame, brackets: dict[int, tuple[int, float, float]]) -> DataFrame:
    """Rows (w, kind, x, n) summed per task: present values (0) and values below (1) of each wanted rank, and its cells (2)."""
    by_column: dict[int, list[tuple[int, float, float]]] = {}
    for w, (c, low, high) in brackets.items():
        by_column.setdefault(c, []).append((w, low, high))

    def run(batches):
        present, below = dict.fromkeys(brackets, 0), dict.fromkeys(brackets, 0)
        held, size = {}, 0

        def out(rows):
            w, kind, x, n = rows
            return pa.RecordBatch.from_arrays([pa.array(w, pa.int32()), pa.array(kind, pa.int32()), pa.array(x, pa.float64()), pa.array(n, pa.int64())], names=["w", "kind", "x", "n"])

        def cells():
            for w, parts in held.items():
                x, at = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
                n = np.bincount(at, np.concatenate([k for _, k in parts]).astype(float)).astype(np.int64)
                yield out(([w] * len(x), [2] * len(x), x, n))

        for batch in batches:
            if not batch.num_rows:
                continue
            xs = matrix(batch)
            for c, wanted in by_column.items():
                x = _valid(xs[:, c])
                for w, low, high in wanted:
                    i, j = np.searchsorted(x, low, "left"), np.searchsorted(x, high, "right")
                    present[w] += len(x)
                    below[w] += int(i)
                    if j > i:
                        v, n = np.unique(x[i:j], return_counts=True)
                        held.setdefault(w, []).append((v, n))
                        size += len(v)
            if size >= _FLUSH:
                yield from cells()
                held, size = {}, 0
        yield from cells()
        some = [w for w in present if present[w]]
        if some:
            yield out((some * 2, [0] * len(some) + [1] * len(some), [0.0] * 2 * len(some), [present[w] for w in some] + [below[w] for w in some]))

    return numbers.mapInArrow(run, "w int, kind int, x double, n long").groupBy("w", "kind", "x").agg(F.sum("n").alias("n"))


def _select(cells: DataFrame, probs: Sequence[float], prob_of: str) -> DataFrame:
    """Per wanted rank its value at the rank below and above, and whether both lay inside the bracket.

    ``prob_of`` is the index of a cell's quantile as an expression of ``w``.
    """
    p = F.expr(f"element_at(array({', '.join(f'{float(q)!r}D' for q in probs)}), {prob_of} + 1)")
    ranged = checkpointed(cells.repartitionByRange("w", "kind", "x").withColumn("part", F.spark_partition_id()))
    heads = ranged.where("kind < 2").groupBy("w").agg(*[F.sum(F.when(F.col("kind") == k, F.col("n"))).alias(n) for k, n in ((0, "present"), (1, "below"))])
    at = p * (F.col("present") - 1)
    heads = heads.select("w", "below", at.alias("at"), F.floor(at).alias("lo"), F.ceil(at).alias("hi"))
    inside = ranged.where("kind = 2")
    totals = inside.groupBy("w", "part").agg(F.sum("n").alias("t"))
    earlier = Window.partitionBy("w").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("w", "part", "t", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("off")).join(heads, "w")
    starts = starts.withColumn("off", F.col("off") + F.col("below"))
    # only ranges that hold a wanted rank are ranked inside
    starts = starts.where(((F.col("lo") >= F.col("off")) & (F.col("lo") < F.col("off") + F.col("t"))) | ((F.col("hi") >= F.col("off")) & (F.col("hi") < F.col("off") + F.col("t"))))
    upto = Window.partitionBy("w", "part").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.join(starts, ["w", "part"]).withColumn("end", F.col("off") + F.sum("n").over(upto))

    def value(rank: str):
        return F.max(F.when((F.col(rank) < F.col("end")) & (F.col(rank) >= F.col("end") - F.col("n")), F.col("x"))).alias(rank)

    found = ranked.groupBy("w").agg(value("lo"), value("hi"))
    return heads.select("w", "at").join(found, "w", "left")


def exact_quantiles(
    df: DataFrame, cs: Sequence[str], probs: Sequence[float], sample_rows: int = SAMPLE_ROWS, numbers: Numbers | None = None
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of numeric columns; None where a column has no value. ``numbers`` are the kept columns, where there are any."""
    cs, probs = list(cs), [float(p) for p in probs]
    if not cs or not probs:
        return {c: [] for c in cs}
    numbers = (numbers or columns_of(df, cs)).table
    rows = df.count()
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in cs}
    if not rows:
        return out
    rate = min(1.0, sample_rows / rows)
    k, reach = len(probs), REACH
    near = _brackets(numbers, len(cs), probs, rate, reach)
    wanted = {c * k + p: (c, *near.get((c, p), (-_INF, _INF))) for c in range(len(cs)) for p in range(k)}
    while wanted:
        missed = {}
        # a column without values has no row here
        for r in _select(_cells(numbers, wanted), probs, f"w % {k}").collect():
            w = r["w"]
            if r["lo"] is None or r["hi"] is None:
                missed[w] = (wanted[w][0], -_INF, _INF)
            else:
                out[cs[w // k]][w % k] = r["lo"] + (r["hi"] - r["lo"]) * (r["at"] - math.floor(r["at"])) if r["hi"] != r["lo"] else r["lo"]
        wanted = missed
    return out
