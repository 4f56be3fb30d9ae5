"""Encoders and scalers: fitted state is a small table or a dictionary, applied by lookup or literal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import recode
from riskloom.operators.aggregate import BROADCAST_ROWS, sort_position
from riskloom.operators.moments import Moments, column_moments
from riskloom.operators.prefix import range_positions
from riskloom.session import checkpointed

MAX_LITERAL_LEVELS = 200


def first_seen_codes(
    df: DataFrame, cs: Sequence[str], order: Sequence[str], window_levels: int = 1_000_000
) -> DataFrame:
    """Rows (variable, value, code): levels numbered from 1 by first appearance in ``order``.

    A missing value is a level of its own. The first step finds each level's least value of the leading order
    column (one number, so partial minima stay in a hash aggregate); only rows that tie on it are compared
    in the remaining order columns. The numbering sees one row per level: few levels are numbered by a
    window, many (by their count) over range partitions.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in cs])
    lead, rest = sort_position(df, order[:1]), order[1:]
    position = sort_position(df, rest) if rest else F.lit(0)
    rows = df.select(lead.alias("lead"), position.alias("position"), F.explode(cells).alias("e")).select("lead", "position", "e.*")
    seen = checkpointed(rows.groupBy("variable", "value").agg(F.min("lead").alias("lead")))
    levels = seen.count()
    if rest:
        least = F.broadcast(seen) if levels <= BROADCAST_ROWS else seen
        same = F.col("r.value").eqNullSafe(F.col("s.value")) & (F.col("r.variable") == F.col("s.variable")) & F.col("r.lead").eqNullSafe(F.col("s.lead"))
        ties = rows.alias("r").join(least.alias("s"), same, "left_semi")
        seen = checkpointed(ties.groupBy("variable", "value").agg(F.min("lead").alias("lead"), F.min("position").alias("position")))
    else:
        seen = seen.withColumn("position", F.lit(0))
    if levels > window_levels:
        numbered = range_positions(seen, ["variable"], ["lead", "position"])
        return numbered.select("variable", "value", (F.col("rank") + 1).alias("code"))
    w = Window.partitionBy("variable").orderBy("lead", "position")
    return seen.select("variable", "value", F.row_number().over(w).cast("long").alias("code"))


def label_encode_first_seen(df: DataFrame, cs: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Replace each column by its first-seen code. Small vocabularies become literals; a large one
    is joined as a table instead of being pulled to the driver."""
    codes = first_seen_codes(df, cs, order)
    sizes = {r["variable"]: r["count"] for r in codes.groupBy("variable").count().collect()}
    small = [c for c in cs if sizes.get(c, 0) <= MAX_LITERAL_LEVELS]
    maps: dict[str, dict] = {c: {} for c in small}
    for r in codes.filter(F.col("variable").isin(small)).collect() if small else []:
        maps[r["variable"]][r["value"]] = r["code"]
    out = df.withColumns({c: recode(F.col(c).cast("string"), m) for c, m in maps.items()}) if maps else df
    for c in cs:
        if c in maps:
            continue
        table = codes.filter(F.col("variable") == c).select(F.col("value").alias("__v"), F.col("code").alias("__c"))
        out = (
            out.join(table, F.col(c).cast("string").eqNullSafe(F.col("__v")), "left")
            .withColumn(c, F.col("__c"))
            .drop("__v", "__c")
        )
    return out


def fit_response(df: DataFrame, cs: Sequence[str], target: str) -> DataFrame:
    """Rows (variable, value, share_0, share_1): the share of each class per category of many columns,
    from one scan and one shuffle of partial counts. An absent class has share 0."""
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in cs])
    share = lambda k: F.count(F.when(F.col("__y") == k, F.lit(1))) / F.count(F.lit(1))
    return (
        df.select(F.col(target).alias("__y"), F.explode(cells).alias("e"))
        .filter(F.col("e.value").isNotNull())
        .groupBy(F.col("e.variable").alias("variable"), F.col("e.value").alias("value"))
        .agg(share(0).alias("share_0"), share(1).alias("share_1"))
    )


def response_encode(fit: DataFrame, apply_to: Sequence[DataFrame], cs: Sequence[str], target: str) -> list[DataFrame]:
    """Replace categories by their class shares in ``fit`` (``<c>_0``, ``<c>_1``); a category unseen
    there stays missing. Columns with few levels become literals, so nothing is joined."""
    if not cs:
        return list(apply_to)
    table = checkpointed(fit_response(fit, cs, target))
    sizes = {r["variable"]: r["count"] for r in table.groupBy("variable").count().collect()}
    small = [c for c in cs if sizes.get(c, 0) <= MAX_LITERAL_LEVELS]
    maps: dict[str, dict] = {f"{c}_{k}": {} for c in small for k in (0, 1)}
    for r in table.filter(F.col("variable").isin(small)).collect() if small else []:
        for k in (0, 1):
            maps[f"{r['variable']}_{k}"][r["value"]] = r[f"share_{k}"]
    literal = {
        f"{c}_{k}": recode(F.col(c).cast("string"), maps[f"{c}_{k}"]).cast("double") for c in small for k in (0, 1)
    }
    out = [df.withColumns(literal).drop(*small) if small else df for df in apply_to]
    for c in cs:
        if c in set(small):
            continue
        part = table.filter(F.col("variable") == c).select(
            F.col("value").alias("__v"), F.col("share_0").alias(f"{c}_0"), F.col("share_1").alias(f"{c}_1")
        )
        part = F.broadcast(part) if sizes[c] <= BROADCAST_ROWS else part
        out = [df.join(part, F.col(c).cast("string") == F.col("__v"), "left").drop("__v", c) for df in out]
    return out


def fit_standard(df: DataFrame, cs: Sequence[str], known: Mapping[str, Moments] | None = None) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column (deviation 1 for a constant column). ``known`` are its moments, where
    they have been taken."""
    moments = column_moments(df, cs) if known is None else {c: known[c] for c in cs}
    return {c: (m.mean, m.deviation or 1.0) for c, m in moments.items() if m.present}


def standard_scale(df: DataFrame, fitted: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Centre and scale, then put 0 where the value is missing."""
    return df.withColumns(
        {c: F.coalesce((F.col(c).cast("double") - F.lit(m)) / F.lit(s), F.lit(0.0)) for c, (m, s) in fitted.items()}
    )


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weights: rows / (classes x rows of the class)."""
    counts = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    overall = Window.partitionBy(F.lit(0))  # one row per class
    return counts.select(
        target, "n", (F.sum("n").over(overall) / (F.count(F.lit(1)).over(overall) * F.col("n"))).alias("weight")
    )
