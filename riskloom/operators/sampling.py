"""Deterministic splits and samples: decided by a hash of the row id, so a retried task repeats them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.prefix import ROWS_PER_BUCKET, rank_in_group


def hash_text(key: str, seed: int) -> Column:
    """A text in random order that depends on the id and the seed only; other engines have the same function."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def hash_unit(key: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the id and the seed only."""
    return F.conv(F.substring(hash_text(key, seed), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def train_validation_split(df: DataFrame, key: str, test_size: float = 0.25, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Two disjoint tables without a shuffle; a row's side never depends on the other rows."""
    u = hash_unit(key, seed)
    return df.filter(u >= F.lit(test_size)), df.filter(u < F.lit(test_size))


def stratified_sample(df: DataFrame, by: str, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows of every class. The rank filter is applied before the shuffle as well, so a large
    class sends at most ``n`` rows per map task."""
    w = Window.partitionBy(by).orderBy(hash_text(key, seed), F.col(key))
    return (
        df.filter(F.col(by).isNotNull()).withColumn("__pos", F.row_number().over(w)).filter(F.col("__pos") <= n).drop("__pos")
    )


def preview(df: DataFrame, n: int, key: str | None = None, seed: int = 0) -> DataFrame:
    """First rows, or rows in hash order when a key is given."""
    return df.limit(n) if key is None else df.orderBy(hash_text(key, seed), F.col(key)).limit(n)


def stratified_folds(
    df: DataFrame, by: str, key: str, folds: int = 10, seed: int = 0, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Add a ``fold`` such that every class is spread evenly: its rows, in hash order, are dealt in turn."""
    hashed = df.withColumn("__u", hash_unit(key, seed))
    ranked = rank_in_group(hashed, [by], "__u", key, rows_per_bucket)
    return ranked.withColumn("fold", F.pmod(F.col("rank"), F.lit(folds)).cast("int")).drop("__u", "rank")
