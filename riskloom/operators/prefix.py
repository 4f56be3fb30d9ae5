"""Running sums, positions and empirical distributions over whole tables.

None of these may sort a table in one task. Values are cut into contiguous buckets at approximate
quantiles; each bucket is ranked on its own and shifted by the totals of the buckets before it.
Equal values are pre-aggregated first, so a value shared by a third of the rows is one row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import all_present
from riskloom.session import checkpointed

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 10_000


def value_splits(df: DataFrame, value: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> list[float]:
    """Inner bucket edges for a numeric column; empty when one bucket is enough."""
    n = df.select(F.count(value)).first()[0]
    buckets = min(MAX_BUCKETS, math.ceil(n / rows_per_bucket)) if n else 1
    if buckets <= 1:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    edges = df.select(F.percentile_approx(F.col(value).cast("double"), probs, max(10_000, 4 * buckets))).first()[0]
    return sorted(set(edges))


def add_bucket(df: DataFrame, value: str, splits: Sequence[float], name: str = "__bucket") -> DataFrame:
    if not splits:
        return df.withColumn(name, F.lit(0.0))
    edges = [float("-inf"), *splits, float("inf")]
    return (
        Bucketizer(splits=edges, inputCol="__x", outputCol=name)
        .transform(df.withColumn("__x", F.col(value).cast("double")))
        .drop("__x")
    )


def running_totals(
    df: DataFrame,
    value: str,
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    next_value: bool = False,
) -> DataFrame:
    """One row per distinct value (and ``by`` group) with each sum and its running total ``cum_*``.

    ``sums`` holds row-level terms. With ``next_value`` the following distinct value is added too.
    """
    rows = df.filter(all_present([value, *by]))
    splits = value_splits(rows, value, rows_per_bucket)
    rows = add_bucket(rows, value, splits)
    aggs = [F.sum(e).alias(n) for n, e in sums.items()]
    cells = rows.groupBy(*by, "__bucket", value).agg(*aggs)
    inside = Window.partitionBy(*by, "__bucket").orderBy(value)
    running = {f"cum_{n}": F.sum(n).over(inside.rowsBetween(Window.unboundedPreceding, 0)) for n in sums}
    if next_value:
        running["next_value"] = F.lead(value).over(inside)
    out = cells.withColumns(running)
    if not splits:
        return out.drop("__bucket")
    earlier = Window.partitionBy(*by).orderBy("__bucket")
    offsets = (
        rows.groupBy(*by, "__bucket")
        .agg(*aggs, F.min(value).alias("__low"))
        .select(
            *by,
            "__bucket",
            *[
                F.coalesce(F.sum(n).over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"__off_{n}")
                for n in sums
            ],
            F.lead("__low").over(earlier).alias("__next_low"),
        )
    )
    out = out.join(offsets, [*by, "__bucket"], "left")
    shifted = {f"cum_{n}": F.col(f"cum_{n}") + F.col(f"__off_{n}") for n in sums}
    if next_value:
        shifted["next_value"] = F.coalesce("next_value", "__next_low")
    return out.withColumns(shifted).drop("__bucket", "__next_low", *[f"__off_{n}" for n in sums])


def rank_in_group(
    df: DataFrame, by: Sequence[str], order: str, tie: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Zero-based ``rank`` of every row within its group by a numeric order and a unique tie-break.

    Used where a group can hold a large part of the table, so no window may span a whole group.
    Rows are ranked within (group, bucket); a bucket bounds the rows of one task as long as the
    order values are spread out (use a hash of the row id where the order is meant to be random).
    """
    splits = value_splits(df, order, rows_per_bucket)
    rows = add_bucket(df.filter(all_present([order, *by])), order, splits)
    inside = Window.partitionBy(*by, "__bucket").orderBy(order, tie)
    ranked = rows.withColumn("rank", F.row_number().over(inside) - F.lit(1).cast("long"))
    if not splits:
        return ranked.drop("__bucket")
    earlier = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*by, "__bucket")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*by, "__bucket", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off"))
    )
    return (
        ranked.join(offsets, [*by, "__bucket"], "left")
        .withColumn("rank", F.col("rank") + F.col("__off"))
        .drop("__bucket", "__off")
    )


def range_positions(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Zero-based ``rank`` within each group for any order columns and any group size.

    Rows are range-partitioned by group and order, which cuts a large group over many tasks, and
    checkpointed, which fixes the partitions; each part is ranked and shifted by the parts before.
    """
    ranged = checkpointed(df.repartitionByRange(*by, *order).withColumn("__part", F.spark_partition_id()))
    ranked = ranged.withColumn("rank", F.row_number().over(Window.partitionBy(*by, "__part").orderBy(*order)) - 1)
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*by, "__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*by, "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off"))
    )
    return (
        ranked.join(offsets, [*by, "__part"], "left").withColumn("rank", F.col("rank") + F.col("__off")).drop("__part", "__off")
    )


def empirical_cdf(df: DataFrame, value: str, by: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Empirical distribution per group, one row per distinct value.

    In an ascending sort of ``n`` rows, row ``i`` has position ``i / (n - 1)``. Equal values take
    consecutive positions; they are given as the range ``cdf_low .. cdf_high`` with their count.
    """
    runs = running_totals(df, value, {"n": F.lit(1)}, by, rows_per_bucket)
    totals = df.filter(all_present([value, *by])).groupBy(*by).agg(F.count(F.lit(1)).alias("total"))
    # one row per group: broadcast only below the counted bound
    totals = totals if by and totals.limit(ROWS_PER_BUCKET + 1).count() > ROWS_PER_BUCKET else F.broadcast(totals)
    runs = runs.join(totals, list(by), "left") if by else runs.crossJoin(totals)
    span = F.col("total") - F.lit(1)
    return runs.select(
        *by,
        value,
        "n",
        F.try_divide(F.col("cum_n") - F.col("n"), span).alias("cdf_low"),
        F.try_divide(F.col("cum_n") - F.lit(1), span).alias("cdf_high"),
    )
