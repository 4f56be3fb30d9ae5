"""Table profiles and distributions: the data behind every exploratory table and chart."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.columns import numeric_columns, split_by_kind
from riskloom.operators.moments import column_moments
from riskloom.operators.quantiles import exact_quantiles
from riskloom.session import checkpointed

# The percentiles printed when none are asked for.
DEFAULT_PERCENTILES = [0, 25, 50, 75, 90, 92, 94, 96, 98, 100]

# digests of 16 bytes that are broadcast at most
BROADCAST_DIGESTS = 500_000


def frequencies(df: DataFrame, cs: Sequence[str]) -> DataFrame:
    """Rows (variable, value as text, n) for many columns in one scan and one shuffle.

    Values are counted before the shuffle, so frequent values travel as one row per task.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in cs])
    return (
        df.select(F.explode(cells).alias("cell"))
        .filter(F.col("cell.value").isNotNull())
        .groupBy(F.col("cell.variable").alias("variable"), F.col("cell.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, cs: Sequence[str]) -> DataFrame:
    """Most frequent value per column, the smallest among equals, with its frequency and the distinct count."""
    return (
        frequencies(df, cs)
        .groupBy("variable")
        .agg(
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"),
            F.max("n").alias("frequency"),
            F.count(F.lit(1)).alias("distinct"),
        )
    )


def distinct_numbers(df: DataFrame, cs: Sequence[str]) -> dict[str, int]:
    """Number of distinct present values of numeric columns: each travels as a column number and 64 bits, once per task."""
    if not cs:
        return {}
    whole = {f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)}
    typed = df.selectExpr(*[f"cast(`{c}` as {'bigint' if c in whole else 'double'}) AS c{i}" for i, c in enumerate(cs)])

    def run(batches):
        held: dict[int, list[np.ndarray]] = {}
        size = 0

        def out():
            for i, parts in held.items():
                bits = np.unique(np.concatenate(parts))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bits), i, np.int32)), pa.array(bits)], names=["c", "bits"])

        for batch in batches:
            for i, column in enumerate(batch.columns):
                x = column.drop_null().to_numpy(zero_copy_only=False)
                if x.dtype.kind == "f":
                    x = (np.unique(x[~np.isnan(x)]) + 0.0).view(np.int64)  # one zero
                x = np.unique(x)
                held.setdefault(i, []).append(x)
                size += len(x)
            if size > 1 << 21:
                yield from out()
                held, size = {}, 0
        yield from out()

    found = typed.mapInArrow(run, "c int, bits long").distinct().groupBy("c").count().collect()  # one row per column
    counts = {r["c"]: r["count"] for r in found}
    return {c: counts.get(i, 0) for i, c in enumerate(cs)}


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """Count per value and its percentage of all rows; missing values are not listed."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return (
        df.filter(F.col(c).isNotNull())
        .groupBy(c)
        .agg(F.count(F.lit(1)).alias("n"))
        .crossJoin(F.broadcast(total))  # one row
        .select(c, "n", (F.lit(100.0) * F.col("n") / F.col("total")).alias("percent"))
    )


def target_rate(df: DataFrame, c: str, target: str) -> DataFrame:
    """Percentage of positives per category, categories without a positive left out."""
    positive = F.count(F.when(F.col(target) == 1, F.lit(1)))
    return (
        df.filter(F.col(c).isNotNull())
        .groupBy(c)
        .agg(F.round(F.lit(100.0) * positive / F.count(F.lit(1)), 2).alias("rate"))
        .filter(F.col("rate").isNotNull() & (F.col("rate") > 0))
    )


def category_by_target(df: DataFrame, c: str, target: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """One row per category with one count column per class; a missing combination stays NULL."""
    counts = [
        F.nullif(F.count(F.when(F.col(target) == k, F.lit(1))), F.lit(0)).alias(f"target_{k}") for k in classes
    ]
    return df.filter(F.col(c).isNotNull()).groupBy(c).agg(*counts)


def top_k(df: DataFrame, value: str, tie: str, k: int) -> DataFrame:
    """The ``k`` largest; planned as a per-task heap, not as a sort."""
    return df.orderBy(F.desc_nulls_last(value), F.asc(tie)).limit(k)


def column_types(df: DataFrame) -> DataFrame:
    """Number of columns per type, beside the row and column count of the table."""
    rows: dict[str, int] = {}
    for f in df.schema.fields:
        rows[f.dataType.simpleString()] = rows.get(f.dataType.simpleString(), 0) + 1
    table = df.sparkSession.createDataFrame(sorted(rows.items()), "type string, columns long")
    n = df.agg(F.count(F.lit(1)).alias("table_rows"))
    return table.crossJoin(F.broadcast(n)).withColumn("table_columns", F.lit(len(df.columns)).cast("long"))


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, missing, repeated, fill share, and the moments or the mode."""
    numbers = numeric_columns(df)
    numeric = set(numbers)
    texts = [c for c in df.columns if c not in numeric]
    base = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(texts)]).first()
    n, known = base["n"], column_moments(df, numbers)
    present = {c: base[f"c{i}"] for i, c in enumerate(texts)} | {c: m.present for c, m in known.items()}
    quartiles = exact_quantiles(df, numbers, [0.25, 0.5, 0.75])
    values = distinct_numbers(df, numbers)
    shape = {r["variable"]: r for r in modes(df, texts).collect()} if texts else {}
    out = []
    for c in df.columns:
        filled = present[c]
        distinct = values[c] if c in numeric else shape[c]["distinct"] if c in shape else 0
        moments = [None] * 7
        if c in numeric and filled:
            m = known[c]
            spread = m.deviation * (filled / (filled - 1)) ** 0.5 if filled > 1 else None
            moments = [m.mean, spread, m.low, *quartiles[c], m.high]
        top = [None, None] if c in numeric or c not in shape else [shape[c]["mode"], shape[c]["frequency"]]
        out.append(
            (c, df.schema[c].dataType.simpleString(), n - filled, n - (n - filled) - distinct,
             100.0 - 100.0 * (n - filled) / n if n else None, filled, *moments, *top)
        )
    return df.sparkSession.createDataFrame(
        out,
        "variable string, type string, missing long, repeated long, fill_percent double, filled long, mean double, "
        "std double, low double, q25 double, median double, q75 double, high double, top string, top_count long",
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and percentage of every column that has any."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"c{i}") for i, c in enumerate(df.columns)]
    )
    cells = F.array(
        *[F.struct(F.lit(c).alias("variable"), F.col(f"c{i}").alias("missing")) for i, c in enumerate(df.columns)]
    )
    return (
        counts.select("n", F.explode(cells).alias("e"))
        .select("e.variable", "e.missing", F.round(F.lit(100.0) * F.col("e.missing") / F.col("n"), 2).alias("percent"))
        .filter(F.col("missing") > 0)
    )


def missing_total(df: DataFrame) -> DataFrame:
    """Missing cells of the whole table and their percentage of all cells."""
    missing = sum((F.count(F.when(F.col(c).isNull(), F.lit(1))) for c in df.columns[1:]),
                  F.count(F.when(F.col(df.columns[0]).isNull(), F.lit(1))))
    cells = F.count(F.lit(1)) * len(df.columns)
    return df.agg(missing.alias("missing"), cells.alias("cells"), F.round(F.lit(100.0) * missing / cells, 2).alias("percent"))


def sentinel_report(df: DataFrame, sentinels: dict[str, float]) -> DataFrame:
    """Rows that carry a column's sentinel value, with the rounded percentage."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.col(c) == v, F.lit(1))).alias(f"c{i}") for i, (c, v) in enumerate(sentinels.items())],
    )
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"c{i}").alias("hits")) for i, c in enumerate(sentinels)])
    return counts.select("n", F.explode(cells).alias("e")).select(
        "e.variable", "e.hits", F.round(F.lit(100.0) * F.col("e.hits") / F.col("n"), 2).alias("percent")
    )


def binned_distribution(df: DataFrame, c: str, edges: Sequence[float]) -> DataFrame:
    """Counts in right-closed bins ``(a, b]``, empty bins included, as a share of all rows."""
    bins = list(zip(edges[:-1], edges[1:], strict=True))
    aggs = [F.count(F.when((F.col(c) > a) & (F.col(c) <= b), F.lit(1))).alias(f"b{i}") for i, (a, b) in enumerate(bins)]
    cells = F.array(
        *[F.struct(F.lit(float(a)).alias("low"), F.lit(float(b)).alias("high"), F.col(f"b{i}").alias("n")) for i, (a, b) in enumerate(bins)]
    )
    return (
        df.agg(F.count(F.lit(1)).alias("total"), *aggs)
        .select("total", F.explode(cells).alias("e"))
        .select("e.low", "e.high", "e.n", (F.lit(100.0) * F.col("e.n") / F.col("total")).alias("percent"))
    )


def percentiles(df: DataFrame, c: str, wanted: Sequence[float] = DEFAULT_PERCENTILES) -> DataFrame:
    values = exact_quantiles(df, [c], [p / 100.0 for p in wanted])[c]
    return df.sparkSession.createDataFrame(
        [(float(p), v) for p, v in zip(wanted, values, strict=True)], "percentile double, value double"
    )


def box_stats(df: DataFrame, c: str, reach: float = 1.5, by: str | None = None, levels: Sequence = ()) -> DataFrame:
    """Quartiles, mean and whiskers (the outermost values within ``reach`` IQRs), overall or per level."""
    groups = [(None, F.lit(True))] if by is None else [(v, F.col(by) == F.lit(v)) for v in levels]
    x = F.col(c).cast("double")
    parts = df.select(*[F.when(where, x).alias(f"g{i}") for i, (_, where) in enumerate(groups)])
    q = exact_quantiles(parts, parts.columns, [0.25, 0.5, 0.75])
    aggs = []
    for i in range(len(groups)):
        g, (q1, _, q3) = F.col(f"g{i}"), q[f"g{i}"]
        if q1 is None:
            q1 = q3 = 0.0
        low, high = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
        aggs += [F.avg(g).alias(f"a{i}"), F.min(F.when(g >= low, g)).alias(f"l{i}"), F.max(F.when(g <= high, g)).alias(f"h{i}")]
    row = parts.agg(*aggs).first()
    out = [
        (None if v is None else str(v), *q[f"g{i}"], row[f"a{i}"], row[f"l{i}"], row[f"h{i}"])
        for i, (v, _) in enumerate(groups)
    ]
    return df.sparkSession.createDataFrame(
        out, "level string, q25 double, median double, q75 double, mean double, whisker_low double, whisker_high double"
    )


def density_by_class(df: DataFrame, c: str, target: str, bins: int = 25) -> DataFrame:
    """Equal-width bin counts of a numeric column per class."""
    limits = df.agg(F.min(F.col(c).cast("double")).alias("low"), F.max(F.col(c).cast("double")).alias("high"))
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    at = F.least(F.floor(F.coalesce(F.try_divide(F.col(c) - F.col("low"), width), F.lit(0.0))), F.lit(bins - 1))
    return (
        df.filter(F.col(c).isNotNull() & F.col(target).isNotNull())
        .crossJoin(F.broadcast(limits))  # one row
        .groupBy(F.col(target).alias("target"), at.cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def reference_table(df: DataFrame, categorical: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """What a single client is compared with: mean and median of numbers, mode of categories."""
    kept = df.drop(*exclude)
    numbers, cats = split_by_kind(kept, categorical)
    numbers = [c for c in numbers if isinstance(kept.schema[c].dataType, T.NumericType)]
    medians = exact_quantiles(kept, numbers, [0.5])
    means = kept.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(numbers)]).first() if numbers else None
    tops = {r["variable"]: r["mode"] for r in modes(kept, cats).collect()} if cats else {}
    out = [(c, float(means[f"m{i}"]) if means[f"m{i}"] is not None else None, medians[c][0], None) for i, c in enumerate(numbers)]
    out += [(c, None, None, tops.get(c)) for c in cats]
    return df.sparkSession.createDataFrame(out, "variable string, mean double, median double, mode string")


def client_comparison(df: DataFrame, key: str, client, reference: DataFrame) -> DataFrame:
    """One client's values beside the reference table."""
    names = [c for c in df.columns if c != key]
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("client_value")) for c in names])
    rows = df.filter(F.col(key) == F.lit(client)).select(F.explode(cells).alias("e")).select("e.*")
    return rows.join(F.broadcast(reference), "variable", "inner")  # one row per column


VIEW_NUMBERS = "c int, whisker_low double, whisker_high double, negatives long, positives long"


def client_view(
    df: DataFrame, key: str, client, target: str, numbers: Sequence[str], categories: Sequence[str], reach: float = 3.0, bins: int = 25
) -> DataFrame:
    """Everything one client is shown against, one row per variable.

    Categories: the share of the client's category, its target rate, its rows per class, and the mode.
    Numbers: mean, box (quartiles and the outermost values within ``reach`` IQRs), and the rows per class in the
    client's equal-width bin. Each part reads the table once for all variables.
    """
    own = df.filter(F.col(key) == F.lit(client)).select(target, *numbers, *categories).first()  # one row
    if own is None:
        raise ValueError(f"no row with {key} = {client}")
    moments, quartiles = column_moments(df, numbers), exact_quantiles(df, numbers, [0.25, 0.5, 0.75])
    limits, spots = [], []
    for c in numbers:
        q1, _, q3 = quartiles[c]
        limits.append((np.nan, np.nan) if q1 is None else (q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)))
        m, v = moments[c], own[c]
        width = (m.high - m.low) / bins if m.present else 0.0
        spots.append((m.low or 0.0, width, None if v is None else 0 if width == 0 else min(int((float(v) - m.low) // width), bins - 1)))
    doubles = df.selectExpr(f"cast(`{target}` as int) AS y", *[f"cast(`{c}` as double) AS c{i}" for i, c in enumerate(numbers)])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(0).fill_null(-1).to_numpy()
            rows = []
            for i in range(len(numbers)):
                x = batch.column(i + 1).to_numpy(zero_copy_only=False)
                known = ~np.isnan(x)
                low, high = x[known & (x >= limits[i][0])], x[known & (x <= limits[i][1])]
                base, width, spot = spots[i]
                at = np.minimum(np.floor((np.where(known, x, base) - base) / width), bins - 1) if width else np.zeros(len(x))
                here = known & (at == spot) if spot is not None else np.zeros(len(x), bool)
                rows.append((i, float(low.min()) if len(low) else None, float(high.max()) if len(high) else None, int((here & (y == 0)).sum()), int((here & (y == 1)).sum())))
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds, strict=True)], names=["c", "whisker_low", "whisker_high", "negatives", "positives"])

    boxes = doubles.mapInArrow(run, VIEW_NUMBERS).groupBy("c").agg(F.min("whisker_low").alias("low"), F.max("whisker_high").alias("high"), F.sum("negatives").alias("n0"), F.sum("positives").alias("n1"))
    box = {r["c"]: r for r in boxes.collect()} if numbers else {}  # one row per number
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in categories])
    mine = F.create_map(*[F.lit(x) for c in categories for x in (c, None if own[c] is None else str(own[c]))])
    at = df.select(F.col(target).alias("y"), F.explode(cells).alias("e")).groupBy(F.col("e.variable").alias("variable")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("e.value") == mine[F.col("e.variable")]).alias("n"),
        *[F.count_if((F.col("e.value") == mine[F.col("e.variable")]) & (F.col("y") == k)).alias(f"n{k}") for k in (0, 1)],
    )
    shares = {r["variable"]: r for r in at.collect()} if categories else {}  # one row per category
    tops = {r["variable"]: r["mode"] for r in modes(df, categories).collect()} if categories else {}
    out = []
    for c in categories:
        s = shares[c]
        rate = 100.0 * s["n1"] / s["n"] if s["n"] else None
        out.append((c, None if own[c] is None else str(own[c]), 100.0 * s["n"] / s["rows"], rate, s["n0"], s["n1"], tops.get(c), *[None] * 6))
    for i, c in enumerate(numbers):
        q, b = quartiles[c], box[i]
        out.append((c, None if own[c] is None else str(own[c]), None, None, b["n0"], b["n1"], None, moments[c].mean, *q, b["low"], b["high"]))
    schema = "variable string, client_value string, percent double, rate double, negatives long, positives long, mode string, mean double, q25 double, median double, q75 double, whisker_low double, whisker_high double"
    return df.sparkSession.createDataFrame(out, schema)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus copies.

    Rows are counted by a 128-bit digest; only rows that share theirs are compared as they are, so a table
    without copies exchanges digests alone.
    """
    cs = [F.col(f"`{c}`") for c in df.columns]
    low, high = F.xxhash64(*cs), F.xxhash64(F.lit(1), *[c.isNull() for c in cs], *reversed(cs))
    digests = df.select(low.alias("__low"), high.alias("__high")).groupBy("__low", "__high").agg(F.count(F.lit(1)).alias("copies"))
    digests = checkpointed(digests)
    single = digests.where("copies = 1").agg(F.count(F.lit(1)).alias("single"))
    shared = digests.where("copies > 1").select("__low", "__high")
    if shared.count() <= BROADCAST_DIGESTS:
        shared = F.broadcast(shared)
    alike = df.withColumns({"__low": low, "__high": high}).join(shared, ["__low", "__high"], "left_semi")
    exact = alike.groupBy(*cs).agg(F.count(F.lit(1)).alias("copies")).agg(
        F.count(F.lit(1)).alias("different"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")
    )
    total, different = F.col("single") + F.col("rows"), F.col("single") + F.col("different")
    return single.join(F.broadcast(exact)).select(total.alias("table_rows"), different.alias("distinct_rows"), (total - different).alias("duplicate_rows"))  # one row each


def key_overlap(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct keys of each table, how many of them the first table has too, and the surplus copies of a key.

    Tables are reduced to distinct (key, table) pairs before they meet.
    """
    (base, *_) = tables
    pairs = None
    for name, (df, key) in tables.items():
        part = df.select(F.col(key).alias("key")).filter("key is not null").groupBy("key").agg(
            F.count(F.lit(1)).alias("n")
        ).withColumn("source", F.lit(name))
        pairs = part if pairs is None else pairs.unionByName(part)
    by_key = pairs.groupBy("key").agg(
        F.max(F.when(F.col("source") == base, 1).otherwise(0)).alias("in_base"),
        *[F.sum(F.when(F.col("source") == name, F.col("n"))).alias(f"n_{i}") for i, name in enumerate(tables)],
    )
    aggs = []
    for i in range(len(tables)):
        aggs += [
            F.count(f"n_{i}").alias(f"d{i}"),
            F.count(F.when((F.col("in_base") == 1) & F.col(f"n_{i}").isNotNull(), F.lit(1))).alias(f"o{i}"),
            F.coalesce(F.sum(F.col(f"n_{i}") - 1), F.lit(0)).alias(f"s{i}"),
        ]
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("source"), F.col(f"d{i}").alias("distinct_keys"), F.col(f"o{i}").alias("keys_in_base"),
                     F.col(f"s{i}").alias("repeated_keys"))
            for i, name in enumerate(tables)
        ]
    )
    return by_key.agg(*aggs).select(F.explode(cells).alias("e")).select("e.*")
