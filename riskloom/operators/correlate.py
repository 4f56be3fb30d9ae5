"""Association between columns: Pearson matrices, correlation pruning, chi-squared and Phi-K."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import numeric_columns
from riskloom.operators.moments import Numbers, column_moments, columns_of, matrix
from riskloom.session import checkpointed

NARROW = 20
# columns of a block, and lanes of the first addition
BLOCK, LANES = 128, 32
_BLOCK_SCHEMA = "i int, j int, lane int, sums binary"
_BLOCK_ARROW = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("lane", pa.int32()), ("sums", pa.binary())])


def correlation_matrix(df: DataFrame, cs: Sequence[str], narrow: int = NARROW, numbers: Numbers | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlation, long format (a, b, r) with a before b in column order. ``numbers`` are the
    kept columns, where there are any."""
    cs = list(cs)
    return _corr_pairs(df, cs) if len(cs) <= narrow else _corr_gram(df, cs, numbers=numbers)


def _corr_pairs(df: DataFrame, cs: list[str]) -> DataFrame:
    pairs = [(i, j) for i in range(len(cs)) for j in range(i + 1, len(cs))]
    numbers = df.selectExpr(*[f"cast(`{c}` as double) AS c{i}" for i, c in enumerate(cs)])
    # built from covariance and deviations, because the corr aggregate fails on a constant column
    row = numbers.selectExpr(
        *[
            f"try_divide(covar_pop(c{i}, c{j}), stddev_pop(CASE WHEN c{j} IS NOT NULL THEN c{i} END) "
            f"* stddev_pop(CASE WHEN c{i} IS NOT NULL THEN c{j} END)) AS r{i}_{j}"
            for i, j in pairs
        ]
    )
    cells = F.array(*[F.struct(F.lit(cs[i]).alias("a"), F.lit(cs[j]).alias("b"), F.col(f"r{i}_{j}").alias("r")) for i, j in pairs])
    return row.select(F.explode(cells).alias("e")).select("e.*")


def _corr_gram(df: DataFrame, cs: list[str], block: int = BLOCK, lanes: int = LANES, numbers: Numbers | None = None) -> DataFrame:
    """Masked cross-product sums by blocks of columns: one array of sums per block pair and task.

    Values are centred on the column means first, so the sums of squares do not cancel. Scan tasks are merged
    to a few per core, each sends one row per block pair, and the arrays are added in two levels, first in
    ``lanes`` lanes, so that a block pair is not one task's work however many tasks there are.
    """
    numbers = numbers or columns_of(df, cs)
    means, fills = column_moments(df, cs, numbers), numbers.vector()
    centre = np.array([means[c].mean or 0.0 for c in cs])
    d = len(cs)
    starts = list(range(0, d, block))
    scanned = numbers.table.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)

    def partial(batches):
        total = np.zeros((4, d, d))
        rows = 0
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch, fills) - centre
                mask = (~np.isnan(x)).astype(float)
                x = np.nan_to_num(x)
                total += [mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x]
                rows += len(x)
        if rows:
            n, s, q, p = total
            lane = (TaskContext.get().partitionId() if TaskContext.get() else 0) % lanes
            for i in starts:
                for j in (j for j in starts if j >= i):
                    a, b = slice(i, i + block), slice(j, j + block)
                    sums = np.stack([n[a, b], s[a, b], s[b, a].T, q[a, b], q[b, a].T, p[a, b]])
                    yield pa.RecordBatch.from_pylist([{"i": i, "j": j, "lane": lane, "sums": sums.tobytes()}], schema=_BLOCK_ARROW)

    def added(group: pa.Table) -> pa.Table:
        sums = sum(np.frombuffer(v.as_py()) for v in group["sums"])
        return pa.Table.from_pylist([{"i": group["i"][0].as_py(), "j": group["j"][0].as_py(), "lane": group["lane"][0].as_py(), "sums": sums.tobytes()}], schema=_BLOCK_ARROW)

    def correlations(batches):
        for batch in batches:
            for r in batch.to_pylist():
                wide = min(block, d - r["j"])
                n, si, sj, qi, qj, p = np.frombuffer(r["sums"]).reshape(6, -1, wide)
                with np.errstate(invalid="ignore", divide="ignore"):
                    cov, vi, vj = p - si * sj / n, qi - si * si / n, qj - sj * sj / n
                    # a variance this far below the raw squares is rounding noise of a constant column
                    real = (vi > qi * 1e-13) & (vj > qj * 1e-13)
                    value = np.where(real, cov / (np.sqrt(np.maximum(vi, 0)) * np.sqrt(np.maximum(vj, 0))), np.nan)
                a, b = (k.ravel() for k in np.indices(value.shape))
                later = (b + r["j"]) > (a + r["i"])
                value = value.ravel()[later]
                yield pa.RecordBatch.from_arrays([pa.array((a[later] + r["i"]).astype(np.int32)), pa.array((b[later] + r["j"]).astype(np.int32)), pa.array(value, mask=np.isnan(value))], names=["i", "j", "r"])

    sums = scanned.mapInArrow(partial, _BLOCK_SCHEMA).groupBy("i", "j", "lane").applyInArrow(added, _BLOCK_SCHEMA).groupBy("i", "j").applyInArrow(added, _BLOCK_SCHEMA)
    names = "array(" + ", ".join(f"'{c}'" for c in cs) + ")"
    return sums.mapInArrow(correlations, "i int, j int, r double").select(F.expr(f"get({names}, i) AS a"), F.expr(f"get({names}, j) AS b"), "r")


def correlated_columns(df: DataFrame, threshold: float = 0.7, protect: Sequence[str] = (), numbers: Numbers | None = None) -> list[str]:
    """Columns correlated above the threshold with any earlier column, dropped or not. ``numbers`` are the kept columns,
    where there are any."""
    cs = numeric_columns(df, protect)
    if len(cs) < 2:
        return []
    hit = correlation_matrix(df, cs, numbers=numbers).filter(F.abs("r") > F.lit(threshold)).select("b").distinct()
    found = {r["b"] for r in hit.collect()}  # at most one row per column
    return [c for c in cs if c in found]


def drop_correlated(df: DataFrame, threshold: float = 0.7, protect: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    gone = correlated_columns(df, threshold, protect)
    return df.drop(*gone), gone


# -- categories ----------------------------------------------------------------------------------


def equal_width_bins(df: DataFrame, cs: Sequence[str], bins: int = 10) -> DataFrame:
    """Replace numeric columns by the number of their equal-width bin."""
    ends = column_moments(df, cs)
    out = {}
    for c in cs:
        low, high = ends[c].low, ends[c].high
        if low is None or low == high:
            out[c] = F.when(F.col(c).isNotNull(), F.lit(0))
        else:
            width = (float(high) - float(low)) / bins
            out[c] = F.least(F.floor((F.col(c) - F.lit(float(low))) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return df.withColumns(out)


def _pair_cells(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Contingency cells of many column pairs in one pass, counted before the shuffle."""
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).cast("string").alias("va"), F.col(b).cast("string").alias("vb"))
            for a, b in pairs
        ]
    )
    combos = df.groupBy(*sorted({c for p in pairs for c in p})).agg(F.count(F.lit(1)).alias("__w"))
    return (
        combos.select("__w", F.explode(cells).alias("e"))
        .filter("e.va is not null and e.vb is not null")
        .groupBy(*[F.col(f"e.{n}").alias(n) for n in ("a", "b", "va", "vb")])
        .agg(F.sum("__w").alias("n"))
    )


def chi_squared(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Chi-squared statistic and Cramer's V of each column pair."""
    return _chi_of(_pair_cells(df, pairs))


def _chi_of(cells: DataFrame) -> DataFrame:
    rows = cells.groupBy("a", "b", "va").agg(F.sum("n").alias("nr"))
    cols = cells.groupBy("a", "b", "vb").agg(F.sum("n").alias("nc"))
    shape = rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("r"), F.sum("nr").alias("total")).join(
        cols.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c")), ["a", "b"]
    )
    term = F.sum(F.col("n").cast("double") * F.col("n") / (F.col("nr").cast("double") * F.col("nc")))
    sums = cells.join(rows, ["a", "b", "va"]).join(cols, ["a", "b", "vb"]).groupBy("a", "b").agg(term.alias("term"))
    chi2 = F.col("total") * (F.col("term") - F.lit(1.0))
    free = F.least(F.col("r"), F.col("c")) - 1
    return sums.join(shape, ["a", "b"]).select(
        "a", "b", "total", "r", "c", chi2.alias("chi2"),
        F.sqrt(F.try_divide(F.greatest(chi2, F.lit(0.0)), F.col("total") * free)).alias("cramers_v"),
    )


def _phi_k(chi2: float, row_counts: Sequence[int], col_counts: Sequence[int]) -> float | None:
    """Correlation of the bivariate normal whose chi-squared in the same marginal bins matches
    (Baak et al., arXiv:1811.11440), found by bisection."""
    nx, ny, n = len(row_counts), len(col_counts), float(sum(row_counts))
    if nx < 2 or ny < 2:
        return None
    normal = NormalDist()
    u = np.concatenate([[0.0], np.cumsum(row_counts) / n])
    v = np.concatenate([[0.0], np.cumsum(col_counts) / n])
    u[-1] = v[-1] = 1.0
    y = np.array([normal.inv_cdf(p) if 0.0 < p < 1.0 else (-math.inf if p <= 0.0 else math.inf) for p in v])
    nodes, weights = np.polynomial.legendre.leggauss(32)
    at = u[:-1, None] + (nodes + 1.0) / 2.0 * np.diff(u)[:, None]
    x = np.vectorize(normal.inv_cdf)(np.clip(at, 1e-15, 1.0 - 1e-15))
    independent = np.outer(np.diff(u), np.diff(v))
    cdf = np.vectorize(lambda z: 0.5 * math.erfc(-z / math.sqrt(2.0)))

    def normal_chi2(rho: float) -> float:
        if rho >= 1.0:
            joint = np.clip(np.minimum(u[1:, None], v[None, 1:]) - np.maximum(u[:-1, None], v[None, :-1]), 0.0, None)
        else:
            inner = np.diff(cdf((y[None, None, :] - rho * x[:, :, None]) / math.sqrt(1.0 - rho * rho)), axis=2)
            joint = (inner * weights[None, :, None]).sum(axis=1) / 2.0 * np.diff(u)[:, None]
        return float(((joint - independent) ** 2 / independent).sum()) * n

    pedestal = float((nx - 1) * (ny - 1))
    if chi2 <= pedestal:
        return 0.0
    highest = n * min(nx - 1, ny - 1)
    if chi2 >= highest:
        return 1.0
    scale = (highest - pedestal) / normal_chi2(1.0)
    low, high = 0.0, 1.0
    for _ in range(40):
        mid = (low + high) / 2.0
        if pedestal + scale * normal_chi2(mid) < chi2:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0


def phi_k(df: DataFrame, pairs: Sequence[tuple[str, str]], max_levels: int = 2_000) -> DataFrame:
    """Phi-K of each pair of (binned) columns. Counts, margins and solutions all come from Spark, a pair at a time."""
    cells = checkpointed(_pair_cells(df, pairs))

    def margin(side: str, name: str) -> DataFrame:
        counts = cells.groupBy("a", "b", side).agg(F.sum("n").alias("n"))
        return counts.groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct(side, "n")))["n"].alias(name))

    sizes = [cells.groupBy("a", "b").agg(F.count_distinct(side).alias("k")).agg(F.max("k")).first()[0] or 0 for side in ("va", "vb")]
    if max(sizes) > max_levels:
        raise ValueError(f"a column has {max(sizes)} levels; bin it before measuring Phi-K")
    stats = _chi_of(cells).join(margin("va", "rows"), ["a", "b"]).join(margin("vb", "cols"), ["a", "b"])

    def solve(batches):
        for batch in batches:
            found = [_phi_k(*v) for v in zip(*(batch.column(c).to_pylist() for c in ("chi2", "rows", "cols")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], names=["a", "b", "phi_k"])

    dealt = stats.select("a", "b", "chi2", "rows", "cols").repartition(max(1, min(200, len(pairs))), "a", "b")
    return dealt.mapInArrow(solve, "a string, b string, phi_k double")


def phi_k_with_target(df: DataFrame, cs: Sequence[str], target: str, k: int = 10) -> DataFrame:
    """The ``k`` columns most associated with the target."""
    return phi_k(df, [(target, c) for c in cs]).orderBy(F.desc_nulls_last("phi_k"), "b").limit(k)
