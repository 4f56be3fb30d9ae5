"""Feature selection: constant columns, aligned column sets and rules over importance tables.

Importance tables have one row per feature, so their global sorts and windows are small by nature.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import numeric_columns
from riskloom.operators.moments import Moments, column_moments
from riskloom.operators.ordered import minmax_scale, rank_by
from riskloom.operators.profile import top_k


def align_columns(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    shared = [c for c in a.columns if c in set(b.columns)]
    return a.select(*shared), b.select(*shared)


def constant_columns(df: DataFrame, protect: Sequence[str] = (), known: Mapping[str, Moments] | None = None) -> list[str]:
    """Columns with at most one distinct value, a missing value counting as one.

    Minimum, maximum and counts decide this; no distinct count and no shuffle of rows is needed. ``known`` are the
    moments of the numeric columns, where they have been taken.
    """
    cs = [c for c in df.columns if c not in set(protect)]
    numbers = numeric_columns(df.select(*cs))
    moments = column_moments(df, numbers) if known is None else {c: known[c] for c in numbers}
    # whole numbers beyond the range of a double are compared as they are
    exact = [c for c in cs if c not in moments or (moments[c].low == moments[c].high and abs(moments[c].low or 0.0) >= 2.0**53)]
    aggs = ["count(*) AS n"]
    for i, c in enumerate(exact):
        aggs += [f"count(`{c}`) AS c{i}", f"min(`{c}`) = max(`{c}`) AS e{i}"]
    row = df.selectExpr(*aggs).first()
    found = {c for c, m in moments.items() if m.present == 0 or (m.present == row["n"] and m.low == m.high)} - set(exact)
    found |= {c for i, c in enumerate(exact) if row[f"c{i}"] == 0 or (row[f"c{i}"] == row["n"] and row[f"e{i}"])}
    return [c for c in cs if c in found]


def drop_constant(df: DataFrame, protect: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    gone = constant_columns(df, protect)
    return df.drop(*gone), gone


def normalised_importance(df: DataFrame, value: str, prefix: str) -> DataFrame:
    """Importance scaled to 0..1 and its 0-based rank."""
    scaled = minmax_scale(df, value, f"{prefix}_normalized")
    return rank_by(scaled, f"{prefix}_normalized", "feature", f"{prefix}_ranking")


def combine_importances(a: DataFrame, b: DataFrame, a_value: str, b_value: str) -> DataFrame:
    """Outer join of two importance tables with the sum of their normalised scores."""
    return a.join(b, "feature", "outer").withColumn("combined", F.col(a_value) + F.col(b_value))


def zero_importance(df: DataFrame, value: str = "importance") -> DataFrame:
    """Features whose importance, averaged over all runs given, is zero."""
    return df.groupBy("feature").agg(F.avg(value).alias("importance")).filter(F.col("importance") == 0)


def label_selection(selected: DataFrame, everything: DataFrame) -> DataFrame:
    """Every feature once, marked Select or Delete."""
    keep = selected.select("feature").distinct()
    rest = everything.select("feature").distinct().join(keep, "feature", "left_anti")
    return keep.withColumn("action", F.lit("Select")).unionByName(rest.withColumn("action", F.lit("Delete")))


def select_over(df: DataFrame, threshold: float) -> DataFrame:
    return label_selection(df.filter(F.col("combined") > threshold), df)


def select_top_combined(df: DataFrame, k: int = 15) -> DataFrame:
    return label_selection(top_k(df, "combined", "feature", k), df)


def select_top_of_each(df: DataFrame, values: Sequence[str], k: int) -> DataFrame:
    """Union of the ``k`` best features of every model."""
    best = None
    for v in values:
        part = top_k(df, v, "feature", k).select("feature")
        best = part if best is None else best.union(part)
    return label_selection(best.distinct(), df)
