"""Drift between a reference and a current table, column by column.

Numeric columns of both tables are melted to (variable, side, value), equal values are counted
before the shuffle, and two-sided running totals over range buckets give the Kolmogorov-Smirnov and
Wasserstein distances. Binned measures use the reference deciles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.prefix import ROWS_PER_BUCKET, running_totals
from riskloom.operators.quantiles import exact_quantiles
from riskloom.operators.profile import frequencies

# Share used for an empty bin in the stability index, and the drift limits.
EMPTY_SHARE = 1e-4
NUMERIC_LIMIT = 0.1
CATEGORY_LIMIT = 0.1


def _melt(reference: DataFrame, current: DataFrame, cs: Sequence[str]) -> DataFrame:
    parts = []
    for side, df in ((0, reference), (1, current)):
        cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in cs])
        parts.append(df.select(F.lit(side).alias("side"), F.explode(cells).alias("e")).select("side", "e.variable", "e.value"))
    return parts[0].unionByName(parts[1]).filter(F.col("value").isNotNull())


def numeric_distances(
    reference: DataFrame, current: DataFrame, cs: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Kolmogorov-Smirnov statistic and Wasserstein distance in units of the reference deviation."""
    rows = _melt(reference, current, cs)
    sums = {"ref": F.when(F.col("side") == 0, 1).otherwise(0), "cur": F.when(F.col("side") == 1, 1).otherwise(0)}
    runs = running_totals(rows, "value", sums, ["variable"], rows_per_bucket, next_value=True)
    totals = rows.groupBy("variable").agg(
        F.sum(sums["ref"]).alias("n_ref"),
        F.sum(sums["cur"]).alias("n_cur"),
        F.stddev_pop(F.when(F.col("side") == 0, F.col("value"))).alias("spread"),
    )
    gap = F.abs(F.try_divide(F.col("cum_ref"), F.col("n_ref")) - F.try_divide(F.col("cum_cur"), F.col("n_cur")))
    return (
        runs.join(F.broadcast(totals), "variable")  # one row per column
        .groupBy("variable")
        .agg(
            F.max(gap).alias("ks"),
            F.try_divide(F.sum(gap * (F.col("next_value") - F.col("value"))), F.greatest(F.max("spread"), F.lit(1e-3))).alias(
                "wasserstein"
            ),
        )
    )


def _share_measures(shares: DataFrame) -> DataFrame:
    """Population stability index and Jensen-Shannon distance from shares p (reference) and q (current)."""
    p, q = F.greatest("p", F.lit(EMPTY_SHARE)), F.greatest("q", F.lit(EMPTY_SHARE))
    mid = (F.col("p") + F.col("q")) / 2.0
    half = lambda s: F.when(F.col(s) > 0, F.col(s) * F.log2(F.col(s) / mid)).otherwise(0.0)
    return shares.groupBy("variable").agg(
        F.sum((q - p) * F.log(q / p)).alias("psi"),
        F.sqrt(F.greatest(F.sum(half("p") + half("q")) / 2.0, F.lit(0.0))).alias("jensen_shannon"),
    )


def _with_shares(counts: DataFrame) -> DataFrame:
    """Counts (variable, level, side, n) to one row per level with both shares."""
    wide = counts.groupBy("variable", "level").agg(
        F.sum(F.when(F.col("side") == 0, F.col("n")).otherwise(0)).alias("ref"),
        F.sum(F.when(F.col("side") == 1, F.col("n")).otherwise(0)).alias("cur"),
    )
    totals = wide.groupBy("variable").agg(F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"))
    return wide.join(F.broadcast(totals), "variable").withColumns(  # one row per column
        {"p": F.try_divide(F.col("ref"), F.col("n_ref")), "q": F.try_divide(F.col("cur"), F.col("n_cur"))}
    )


def numeric_stability(reference: DataFrame, current: DataFrame, cs: Sequence[str], bins: int = 10) -> DataFrame:
    """Stability index and Jensen-Shannon distance over the reference quantile bins ``(a, b]``."""
    cuts = exact_quantiles(reference, cs, [i / bins for i in range(1, bins)])
    rows = _melt(reference, current, cs)
    level = None
    for c in cs:
        edges = sorted({e for e in cuts[c] if e is not None})
        at = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < F.col("value"))) if edges else F.lit(0)
        level = F.when(F.col("variable") == c, at) if level is None else level.when(F.col("variable") == c, at)
    counts = rows.groupBy("variable", "side", level.alias("level")).agg(F.count(F.lit(1)).alias("n"))
    return _share_measures(_with_shares(counts))


def category_drift(reference: DataFrame, current: DataFrame, cs: Sequence[str]) -> DataFrame:
    """Stability index, Jensen-Shannon distance and chi-squared statistic per category column."""
    counts = frequencies(reference, cs).withColumn("side", F.lit(0)).unionByName(
        frequencies(current, cs).withColumn("side", F.lit(1))
    ).withColumnRenamed("value", "level")
    shares = _with_shares(counts)
    total = F.col("n_ref") + F.col("n_cur")
    both = F.col("ref") + F.col("cur")
    cell = lambda n, side: F.pow(F.col(n) - both * F.col(side) / total, 2.0) / (both * F.col(side) / total)
    chi2 = shares.groupBy("variable").agg(F.sum(cell("ref", "n_ref") + cell("cur", "n_cur")).alias("chi2"))
    return _share_measures(shares).join(chi2, "variable")


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    numeric_limit: float = NUMERIC_LIMIT,
    category_limit: float = CATEGORY_LIMIT,
) -> DataFrame:
    """One row per column with its measures and whether it drifted."""
    parts = []
    none = F.lit(None).cast("double")
    if numeric:
        table = numeric_distances(reference, current, numeric).join(numeric_stability(reference, current, numeric), "variable")
        parts.append(
            table.select("variable", F.lit("numeric").alias("kind"), "ks", "wasserstein", "psi", "jensen_shannon",
                         none.alias("chi2"), (F.col("wasserstein") >= numeric_limit).alias("drifted"))
        )
    if categorical:
        table = category_drift(reference, current, categorical)
        parts.append(
            table.select("variable", F.lit("category").alias("kind"), none.alias("ks"), none.alias("wasserstein"), "psi",
                         "jensen_shannon", "chi2", (F.col("jensen_shannon") >= category_limit).alias("drifted"))
        )
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def drift_share(report: DataFrame, limit: float = 0.5) -> DataFrame:
    """Share of drifted columns and whether the whole table counts as drifted."""
    share = F.avg(F.col("drifted").cast("double"))
    return report.agg(
        F.count(F.lit(1)).alias("n_columns"), F.sum(F.col("drifted").cast("long")).alias("n_drifted"),
        share.alias("share"), (share >= limit).alias("table_drifted"),
    )
