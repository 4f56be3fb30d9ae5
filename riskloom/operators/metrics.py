"""Evaluation of binary scores: confusion counts, business score, thresholds, ranking quality.

Everything is computed from counts. Ranking measures first group equal scores, then use running
totals over range buckets, so no task ever sorts the whole score table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.prefix import ROWS_PER_BUCKET, running_totals

# Gain of each outcome; a missed defaulter costs ten times a refused good client.
BUSINESS_WEIGHTS = {"tn": 1.0, "fp": -1.0, "fn": -10.0, "tp": 1.0}
# Beta of the reported F measures.
BETAS = (1, 2, 5, 10)


def confusion_exprs(label: Column, predicted: Column) -> list[Column]:
    def count(y: int, p: int) -> Column:
        return F.count(F.when((label == y) & (predicted == p), F.lit(1)))

    return [count(0, 0).alias("tn"), count(0, 1).alias("fp"), count(1, 0).alias("fn"), count(1, 1).alias("tp")]


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    predicted = F.when(F.col(score) > F.lit(threshold), 1).otherwise(0)
    return df.agg(*confusion_exprs(F.col(label), predicted))


def business_score(weights: Mapping[str, float] = BUSINESS_WEIGHTS) -> Column:
    """Gain from the four counts, scaled between the worst and the best possible gain."""
    c = {k: F.col(k).cast("double") for k in ("tn", "fp", "fn", "tp")}
    w = {k: F.lit(float(v)) for k, v in weights.items()}
    good, bad = c["tn"] + c["fp"], c["fn"] + c["tp"]
    gain = sum((c[k] * w[k] for k in ("fp", "fn", "tp")), c["tn"] * w["tn"])
    worst = good * w["fp"] + bad * w["fn"]
    best = good * w["tn"] + bad * w["tp"]
    return F.try_divide(gain - worst, best - worst)


def precision() -> Column:
    return F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))


def recall() -> Column:
    return F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), F.lit(0.0))


def f_beta(beta: float) -> Column:
    b = float(beta * beta)
    hits = F.col("tp") * F.lit(1.0 + b)
    return F.coalesce(F.try_divide(hits, hits + F.col("fn") * F.lit(b) + F.col("fp")), F.lit(0.0))


def with_threshold_metrics(counts: DataFrame, weights: Mapping[str, float] = BUSINESS_WEIGHTS) -> DataFrame:
    return counts.withColumns(
        {"recall": recall(), "precision": precision()}
        | {f"f{b}_score": f_beta(b) for b in BETAS}
        | {"business_score": business_score(weights)}
    )


def threshold_sweep(
    df: DataFrame, label: str, score: str, steps: int = 100, gain: Callable[[], Column] = business_score
) -> DataFrame:
    """Confusion counts and gain at thresholds 0, 1/steps, ... ; a row is positive when score > threshold.

    Each score is counted once, under the highest threshold it exceeds; running sums over the
    ``steps`` bins give every threshold, instead of one pass per threshold.
    """
    x = F.col(score).cast("double")
    guess = F.ceil(x * F.lit(float(steps))) - 1
    # ceil of a product may be one step off; decide by comparing with the threshold itself
    at = F.when(x > (guess + 1) / F.lit(float(steps)), guess + 1).when(x > guess / F.lit(float(steps)), guess).otherwise(guess - 1)
    slot = F.greatest(F.lit(-1), F.least(F.lit(steps - 1), at)).cast("long")
    counts = (
        df.filter(x.isNotNull() & F.col(label).isNotNull())
        .groupBy(slot.alias("slot"))
        .agg(F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) == 0, 1)).alias("neg"))
    )
    slots = df.sparkSession.range(-1, steps).withColumnRenamed("id", "slot")
    full = slots.join(counts, "slot", "left").fillna(0, ["pos", "neg"])
    at_or_above = Window.partitionBy(F.lit(0)).orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(F.lit(0))
    table = full.select(
        "slot",
        F.sum("pos").over(at_or_above).alias("tp"),
        F.sum("neg").over(at_or_above).alias("fp"),
        F.sum("pos").over(everything).alias("p"),
        F.sum("neg").over(everything).alias("n"),
    ).filter("slot >= 0")
    table = table.select(
        (F.col("slot") / F.lit(float(steps))).alias("threshold"),
        (F.col("n") - F.col("fp")).alias("tn"),
        "fp",
        (F.col("p") - F.col("tp")).alias("fn"),
        "tp",
    )
    return table.withColumn("gain", gain())


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The threshold with the highest gain, the lowest one among equals."""
    return sweep.orderBy(F.desc("gain"), F.asc("threshold")).limit(1).select("threshold", "gain")


def _score_runs(df: DataFrame, label: str, score: str, by: Sequence[str], rows_per_bucket: int) -> DataFrame:
    sums = {"pos": F.when(F.col(label) == 1, 1).otherwise(0), "neg": F.when(F.col(label) == 0, 1).otherwise(0)}
    return running_totals(df.filter(F.col(label).isNotNull()), score, sums, by, rows_per_bucket)


def ranking_metrics(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Area under the ROC curve (tied scores share their average rank) and average precision."""
    runs = _score_runs(df, label, score, by, rows_per_bucket)
    totals = df.filter(F.col(score).isNotNull()).groupBy(*by).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("__p"), F.count(F.when(F.col(label) == 0, 1)).alias("__n")
    )
    joined = runs.join(totals, list(by), "left") if by else runs.crossJoin(F.broadcast(totals))  # one row
    below = F.col("cum_neg") - F.col("neg")
    at_least_pos = F.col("__p") - F.col("cum_pos") + F.col("pos")
    at_least_all = at_least_pos + F.col("__n") - F.col("cum_neg") + F.col("neg")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / F.lit(2.0)))
    precision_steps = F.sum(F.col("pos") * at_least_pos / at_least_all)
    return joined.groupBy(*by).agg(
        F.try_divide(wins, F.max(F.col("__p").cast("double")) * F.max("__n")).alias("roc_auc"),
        F.try_divide(precision_steps, F.max(F.col("__p").cast("double"))).alias("average_precision"),
    )


def evaluate_at_threshold(df: DataFrame, label: str, score: str, threshold: float, title: str) -> DataFrame:
    """One result row: all threshold and ranking measures of one experiment."""
    counts = with_threshold_metrics(confusion(df, label, score, threshold))
    ranks = ranking_metrics(df, label, score)
    return counts.crossJoin(F.broadcast(ranks)).withColumn("experiment", F.lit(title))  # one row each
