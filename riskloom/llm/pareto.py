"""Mixing sources to target weights by Pareto order sampling.

Targets: sources, ordered by code point with null last, carry repeating weights and share a multiple of
all words; no target exceeds ``cap`` times its source's words, and what is cut off goes to the others
by weight. A document is then taken ``floor(target / source words)`` whole times for certain, and once
more with an inclusion probability in proportion to its size (so that the expected words are those that remain
to the target; ``MOST`` at most): documents are ranked by ``odds(u) / odds(inclusion)`` with a random number
``u`` that is a function of the document's id, and the first of the ranking that fill the remaining words are
selected.

Defined results: null or empty texts have size 0 and no further copy; an empty table gives no rows; rows that repeat an id
are selected together; other columns are ignored; a null id is an id of its own.

A source may hold any share of the rows: the place where its ranking is cut is found from sums per
bucket of the ranking, and only the documents of the bucket that holds the cut are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import n_words, small
from riskloom.session import checkpointed


MOST = 0.98


def uniform(doc_id: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 that depends on the id and the seed only."""
    text = F.coalesce(doc_id.cast("string"), F.lit("null"))
    x = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), text)), 1, 12), 16, 10).cast("double")
    return (x + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """One row per source: its words, weight and target. Windows here run over one row per source."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    by = by.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn("weight", w)
    by = by.withColumn("most", F.lit(float(cap)) * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    up = Window.orderBy("ratio", "place")
    everything = Window.partitionBy()
    by = (
        by.withColumn("capped", F.coalesce(F.sum("most").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("all", F.sum("source_size").over(everything))
    )
    # the level that holds if exactly the sources before this one are capped; it is right from the first one that stays under its cap
    by = by.withColumn("level", (F.lit(float(share)) * F.col("all") - F.col("capped")) / F.col("left"))
    fits = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(everything)
    by = by.withColumn("fits", fits)
    below = F.struct("ratio", "place") < F.struct(F.col("fits.ratio"), F.col("fits.place"))
    target = F.when(F.col("fits").isNull() | below, F.col("most")).otherwise(F.least(F.col("most"), F.col("fits.level") * F.col("weight")))
    return by.select("source", "place", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame, *, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: str = "mix", keep_text: bool = False
) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken; with ``keep_text`` also the input's columns, kept under ``row``."""
    sizes = checkpointed(docs.select("doc_id", "source", n_words().alias("size")))
    total = sizes.count()
    buckets = 1 << max(10, (total // 50_000).bit_length())
    share_of = source_targets(sizes, weights, share, cap).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    share_of = checkpointed(
        share_of.withColumn("whole", F.floor("rate"))
        .withColumn("part", F.col("rate") - F.col("whole"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    squares = sizes.groupBy(F.col("source").alias("_source")).agg(F.sum((F.col("size") * F.col("size")).cast("decimal(38,0)")).cast("double").alias("squares"))
    share_of = share_of.join(small(squares), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    share_of = checkpointed(share_of.withColumn("per_word", F.when(F.col("squares") > 0, F.col("rest") / F.col("squares")).otherwise(0.0)).drop("squares"))
    share_small = small(share_of)

    def ranked(df: DataFrame, side: DataFrame) -> DataFrame:
        u = uniform(F.col("doc_id"), seed)
        df = df.join(side.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        odds = (u / (F.lit(1.0) - u)) / (F.col("inclusion") / (F.lit(1.0) - F.col("inclusion")))
        df = df.withColumn("inclusion", F.least(F.col("per_word") * F.col("size"), F.lit(MOST)))
        df = df.withColumn("rank", F.when((F.col("part") > 0) & (F.col("inclusion") > 0), odds)).drop("inclusion")
        return df.withColumn("bucket", F.floor(F.col("rank") / (F.lit(1.0) + F.col("rank")) * buckets))

    order = ranked(sizes, share_small).where("rank is not null")
    sums = order.groupBy("place", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    run = Window.partitionBy("place").orderBy("bucket")
    sums = sums.withColumn("before", F.sum("words").over(run) - F.col("words"))
    cut = sums.where("before <= rest and before + words > rest").groupBy("place").agg(F.min_by(F.struct("bucket", "before"), "bucket").alias("cut"))
    cut = checkpointed(cut.select("place", F.col("cut.bucket").alias("cut_bucket"), "cut.before"))
    within = order.join(small(cut), "place").where("bucket = cut_bucket")
    within = within.groupBy("place", "rank", "doc_id").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("before").alias("before"))
    run = Window.partitionBy("place").orderBy("rank", F.col("doc_id").asc_nulls_first())
    within = within.withColumn("ahead", F.col("before") + F.sum("size").over(run) - F.col("size")).where("ahead + size / 2 <= rest")
    last = within.groupBy("place").agg(F.max(F.struct("rank", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("id"))).alias("last"))
    share_of = checkpointed(share_of.join(cut.drop("before"), "place", "left").join(last, "place", "left"))

    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", n_words().alias("size")) if keep_text else sizes
    out = ranked(source, small(share_of))
    here = F.struct("rank", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("id"))
    chosen = F.col("cut_bucket").isNull() | (F.col("bucket") < F.col("cut_bucket")) | ((F.col("bucket") == F.col("cut_bucket")) & (here <= F.col("last")))
    extra = F.when(F.col("rank").isNotNull() & F.coalesce(chosen, F.lit(False)), 1).otherwise(0)
    out = out.withColumn("copies", (F.col("whole") + extra).cast("int")).withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
    return out.select(*(["row"] if keep_text else []), "doc_id", "size", "source_size", "target", "copies", "taken")


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of the mix with the input's columns: a document taken twice is there twice."""
    rows = mix_sources(docs, keep_text=True, **parameters).where("copies > 0")
    rows = rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])


ORACLE = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][(place % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS most FROM s),
r AS (SELECT *, most / weight AS ratio FROM w),
c AS (SELECT *, coalesce(sum(most) OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS capped,
  sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS remaining,
  (sum(source_size) OVER ())::DOUBLE AS everything FROM r),
l AS (SELECT *, (1.5::DOUBLE * everything - capped) / remaining AS level FROM c),
f AS (SELECT *, min(CASE WHEN level <= ratio THEN {'a': ratio, 'b': place, 'c': level} END) OVER () AS fits FROM l),
t AS (SELECT source, place, source_size, CASE WHEN fits IS NULL OR ratio < fits.a OR (ratio = fits.a AND place < fits.b) THEN most
  ELSE least(most, fits.c * weight) END AS target FROM f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t),
q AS (SELECT *, floor(rate) AS whole, rate - floor(rate) AS part, target - floor(rate) * source_size AS rest FROM p),
u AS (SELECT d.doc_id, d.size, q.*, (('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE AS x
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
o AS (SELECT *, CASE WHEN part > 0 AND inclusion > 0 THEN (x / (1.0 - x)) / (inclusion / (1.0 - inclusion)) END AS rank
  FROM (SELECT u.*, least(CASE WHEN squares > 0 THEN rest / squares ELSE 0.0 END * size, 0.98::DOUBLE) AS inclusion
    FROM u JOIN (SELECT source, sum(size * size)::DOUBLE AS squares FROM d GROUP BY source) e ON e.source IS NOT DISTINCT FROM u.source)),
a AS (SELECT *, sum(size) OVER (PARTITION BY place ORDER BY rank, doc_id) AS upto, sum(size) OVER (PARTITION BY place, rank, doc_id) AS tied FROM o)
SELECT doc_id, size, source_size, target,
  (whole + CASE WHEN part > 0 AND inclusion > 0 AND upto - tied + tied / 2.0 <= rest THEN 1 ELSE 0 END)::INT AS copies,
  ((whole + CASE WHEN part > 0 AND inclusion > 0 AND upto - tied + tied / 2.0 <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM a
"""
