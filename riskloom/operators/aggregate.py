"""Spec-driven aggregation: the operator behind every roll-up from snapshots to loans to clients.

A spec maps a column to the statistics wanted from it, e.g. ``{"AMT": "mean max", "ST": "last"}``.
All row subsets of one roll-up (years, statuses, everything) become conditional aggregates of a
single ``groupBy``: one scan and one shuffle, with map-side partial aggregation, so a key that
holds a third of the rows reaches its reducer as one partial row per map task. Nothing collects a
group: first and last are ``min_by``/``max_by``. Where the rows of each key are counted, the same
statistics are folded over rows sorted by key (``fold.py``), which hundreds of them need.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.columns import all_present, distinct_names, level_flag, level_names
from riskloom.operators.fold import Wanted, foldable, sorted_fold
from riskloom.operators.profile import frequencies
from riskloom.session import checkpointed, task_count

Spec = Mapping[str, str | Sequence[str]]
ORDERED = {"first", "last"}
HOT_KEY_ROWS = 1_000_000
PLAIN = {"mean": "avg", "max": "max", "min": "min", "count": "count"}
# rows of a task that folds wide statistics: at least, while cores are idle, and at most
FEW_FOLDED, MANY_FOLDED = 25_000, 100_000


@dataclass(frozen=True)
class Part:
    """One spec applied to one row subset (``where=None`` means all rows)."""

    spec: Spec
    suffix: str = ""
    where: Column | None = None


def stats_of(spec: Spec) -> Iterable[tuple[str, str]]:
    for column, stats in spec.items():
        for stat in stats.split() if isinstance(stats, str) else stats:
            yield column, stat


def stat_name(column: str, stat: str, suffix: str = "") -> str:
    return f"{column}_{stat}".upper() + suffix


def sort_position(df: DataFrame, order: Sequence[str]) -> Column:
    """A single comparable value for an ascending sort with missing values last.

    One numeric column stays primitive, which keeps ``min_by``/``max_by`` buffers small and the aggregate
    hash-based: whole numbers stay whole (doubles would join those above 2^53), and a missing fraction
    sorts as NaN, behind infinity. Several columns become a struct.
    """
    if not order:
        raise ValueError("first/last need an explicit order with a unique tie-break")
    if len(order) == 1:
        kind = df.schema[order[0]].dataType
        if isinstance(kind, T.IntegralType):
            return F.coalesce(F.col(order[0]).cast("long"), F.lit((1 << 63) - 1))
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.coalesce(F.col(order[0]).cast("double"), F.lit(float("nan")))
    fields: list[Column] = []
    for i, name in enumerate(order):
        fields += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}")]
    return F.struct(*fields)


def statistic(stat: str, column: str, where: str | None = None, position: str = "__position") -> str:
    """SQL text of one aggregate, with the missing-value rules of the feature tables.

    A sum over an all-missing subset is 0, but a subset without any row is missing. First and last
    take the first and last non-missing value in order. ``where`` names a boolean column.
    """
    x = f"`{column}`"
    v = x if where is None else f"CASE WHEN `{where}` THEN {x} END"
    if stat == "sum":
        total = f"coalesce(sum({v}), 0)"
        return total if where is None else f"CASE WHEN count_if(`{where}`) > 0 THEN {total} END"
    if stat in ORDERED:
        present = f"{x} IS NOT NULL" if where is None else f"`{where}` AND {x} IS NOT NULL"
        pick = "min_by" if stat == "first" else "max_by"
        return f"{pick}({x}, CASE WHEN {present} THEN `{position}` END)"
    if stat not in PLAIN:
        raise ValueError(f"unknown statistic {stat}")
    return f"{PLAIN[stat]}({v})"


@dataclass(frozen=True)
class KeyCounts:
    """Rows with a key, and the most rows of one key."""

    rows: int
    most: int


def key_counts(df: DataFrame, keys: Sequence[str]) -> KeyCounts:
    """Counted over the key columns alone."""
    seen = df.filter(all_present(keys)).groupBy(*keys).count().agg(F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    return KeyCounts(seen["rows"] or 0, seen["most"] or 0)


def aggregate_parts(
    df: DataFrame,
    keys: Sequence[str],
    parts: Sequence[Part],
    order: Sequence[str] = (),
    means: Mapping[str, Column] | None = None,
    seen: KeyCounts | None = None,
    hot_rows: int = HOT_KEY_ROWS,
    dealt: bool = False,
) -> DataFrame:
    """All parts in one ``groupBy``; rows with a missing key are left out. ``means`` names expressions whose mean is added.

    Subset conditions and the sort position become columns once, so they are evaluated once per row
    however many statistics use them. ``seen`` (an upper bound will do) tells that no key has more than ``hot_rows``
    rows: these are then dealt and sorted by key and all statistics of numbers folded in one pass. ``dealt`` rows
    of a key already lie in one task.
    """
    means = dict(means or {})
    helpers = {f"__where{i}": p.where for i, p in enumerate(parts) if p.where is not None}
    helpers |= {f"__mean{i}": e for i, e in enumerate(means.values())}
    spread = df.filter(all_present(keys))
    spread = spread.withColumns(helpers) if helpers else spread
    placed = any(s in ORDERED for p in parts for _, s in stats_of(p.spec))
    wanted = [
        Wanted(stat_name(c, s, p.suffix), s, c, None if p.where is None else f"__where{i}")
        for i, p in enumerate(parts)
        for c, s in stats_of(p.spec)
    ]
    wanted += [Wanted(name, "mean", f"__mean{i}") for i, name in enumerate(means)]
    if seen is not None and seen.most <= hot_rows:
        if placed and not order:
            raise ValueError("first/last need an explicit order with a unique tie-break")
        tasks = task_count(seen.rows, df.sparkSession.sparkContext.defaultParallelism, FEW_FOLDED, MANY_FOLDED)
        if foldable(spread, keys, wanted):
            used = dict.fromkeys([*keys, *(order if placed else []), *(c for w in wanted for c in (w.column, w.where) if c)])
            rows = spread.selectExpr(*[f"`{c}`" for c in used])
            rows = rows if dealt else rows.repartition(tasks, *keys)
            return sorted_fold(rows.sortWithinPartitions(*[F.asc_nulls_last(c) for c in [*keys, *(order if placed else [])]]), keys, wanted)
        if not dealt and tasks > 1:
            spread = spread.repartition(tasks, *keys)
    if placed:
        spread = spread.withColumn("__position", sort_position(df, order))
    exprs = [F.expr(f"{statistic(w.stat, w.column, w.where)} AS `{w.name}`") for w in wanted]
    return spread.groupBy(*keys).agg(*exprs)


def dealt_by_key(rows: DataFrame, keys: Sequence[str], counted: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Rows with a key dealt by it, ahead of an aggregate that makes many more columns than a row has.

    Where keys hold few rows, partial aggregates of so many columns are larger than the rows and their number hardly falls.
    ``counted`` holds the keys of ``rows`` and is cheap to read: its count gives the number of tasks, and rows
    with a key of more than ``hot_rows`` rows are left to partial aggregates.
    """
    counts = counted.filter(all_present(keys)).groupBy(*keys).count()
    seen = counts.agg(F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    tasks = task_count(seen["rows"] or 0, rows.sparkSession.sparkContext.defaultParallelism)
    if tasks == 1 or seen["most"] > hot_rows:
        return rows
    return rows.filter(all_present(keys)).repartition(tasks, *keys)


def group_agg(
    df: DataFrame, keys: Sequence[str], spec: Spec, order: Sequence[str] = (), suffix: str = "", seen: KeyCounts | None = None
) -> DataFrame:
    return aggregate_parts(df, keys, [Part(spec, suffix)], order, seen=seen)


def subset_agg(
    df: DataFrame, keys: Sequence[str], spec: Spec, subsets: Mapping[str, Column], order: Sequence[str] = ()
) -> DataFrame:
    """The same spec over several row subsets, one suffix each; keys outside every subset are left out."""
    inside = F.lit(False)
    for where in subsets.values():
        inside = inside | F.coalesce(where, F.lit(False))
    parts = [Part(spec, suffix, where) for suffix, where in subsets.items()]
    return aggregate_parts(df.filter(inside), keys, parts, order)


def periods(age: str, latest: int, suffix: str = "_YEAR_") -> dict[str, Column]:
    """Subsets for period 0 .. latest-1 and one for everything older."""
    out = {f"{suffix}{i}": F.col(age) == i for i in range(latest)}
    out[f"{suffix}REST"] = F.col(age) >= latest
    return out


def categories(c: str, named: Sequence[str], suffix: str = "_") -> dict[str, Column]:
    """Subsets for each named category and one for all others; a missing category belongs to the rest."""
    out = {f"{suffix}{n}": F.col(c) == F.lit(v) for v, n in distinct_names(named, lambda v: v.upper()).items()}
    out[f"{suffix}REST"] = ~F.coalesce(F.col(c).isin(*named), F.lit(False))
    return out


# -- first and last rows of a key ---------------------------------------------------------------


def _ends(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, from_end: bool) -> DataFrame:
    """Rows with their position counted from the chosen end in ``__pos``."""
    if not order:
        raise ValueError("taking rows from an end needs an explicit order with a unique tie-break")
    sort = [F.desc_nulls_first(c) if from_end else F.asc_nulls_last(c) for c in order]
    w = Window.partitionBy(*keys).orderBy(*sort)
    return df.filter(all_present(keys)).withColumn("__pos", F.row_number().over(w)).filter(F.col("__pos") <= n)


def take_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows per key. The rank filter is limited before the shuffle (WindowGroupLimit),
    so a hot key sends at most ``n`` rows per map task."""
    return _ends(df, keys, order, n, from_end=False).drop("__pos")


def take_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Last ``n`` rows per key, missing order values counting as the latest."""
    return _ends(df, keys, order, n, from_end=True).drop("__pos")


def agg_with_ends(
    df: DataFrame,
    keys: Sequence[str],
    spec: Spec,
    order: Sequence[str],
    last: int | None = None,
    first: int | None = None,
    suffixes: Mapping[str, str] | None = None,
    hot_rows: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """The spec over the latest ``last`` rows, the ``first`` rows and all rows of each key.

    One scan and one exchange: a row's place from the front and from the end come from one window, and all three
    subsets are conditional aggregates on that partitioning, whose sort position is the place (one number, so
    first and last stay in a hash aggregate). Clients with more than ``hot_rows`` rows, found by a count of the
    keys alone, would be one window each: their ends are limited before the shuffle instead. ``hot_rows=None``
    skips the count.
    """
    names = {"last": f"_LAST_{last}", "first": f"_FIRST_{first}", "all": "_ALL"} | dict(suffixes or {})
    if not order:
        raise ValueError("taking rows from an end needs an explicit order with a unique tie-break")
    rows = df.filter(all_present(keys))
    if hot_rows is None:
        return _placed_ends(rows, keys, spec, order, last, first, names)
    seen = key_counts(rows, keys)
    if seen.most <= hot_rows:
        return _placed_ends(rows, keys, spec, order, last, first, names, seen)
    hot = rows.groupBy(*keys).count().filter(F.col("count") > hot_rows).select(*keys)
    marked = F.broadcast(hot) if small_enough(hot) else hot
    cold = _placed_ends(rows.join(marked, list(keys), "left_anti"), keys, spec, order, last, first, names, KeyCounts(seen.rows, hot_rows))
    return cold.unionByName(_limited_ends(rows.join(marked, list(keys), "left_semi"), keys, spec, order, last, first, names))


def _placed_ends(rows: DataFrame, keys, spec: Spec, order, last, first, names: Mapping[str, str], seen: KeyCounts | None = None) -> DataFrame:
    by_key = Window.partitionBy(*keys)
    if seen is not None:
        tasks = task_count(seen.rows, rows.sparkSession.sparkContext.defaultParallelism, FEW_FOLDED, MANY_FOLDED)
        needed = dict.fromkeys([*keys, *order, *spec])
        rows = rows.selectExpr(*[f"`{c}`" for c in needed]).repartition(tasks, *keys)
    up = F.row_number().over(by_key.orderBy(*[F.asc_nulls_last(c) for c in order]))
    placed = rows.withColumns({"__up": up, "__size": F.count(F.lit(1)).over(by_key)})
    parts = [Part(spec, names["all"])]
    if first:
        parts.insert(0, Part(spec, names["first"], F.col("__up") <= first))
    if last:
        parts.insert(0, Part(spec, names["last"], F.col("__up") > F.col("__size") - last))
    # the windows have brought the rows of a key together
    return aggregate_parts(placed, keys, parts, ["__up"], seen=seen, hot_rows=max(HOT_KEY_ROWS, seen.most if seen else 0), dealt=True)


def _limited_ends(df: DataFrame, keys, spec: Spec, order, last, first, names: Mapping[str, str]) -> DataFrame:
    """Every branch limited to its rows before the shuffle and aggregated before the branches meet."""
    out = group_agg(df, keys, spec, order, names["all"])
    # inside an end the position is one number, which keeps its first/last aggregates primitive
    if first:
        rows = _ends(df, keys, order, first, from_end=False)
        out = group_agg(rows, keys, spec, ["__pos"], names["first"]).join(out, list(keys))
    if last:
        rows = _ends(df, keys, order, last, from_end=True).withColumn("__pos", -F.col("__pos"))
        out = group_agg(rows, keys, spec, ["__pos"], names["last"]).join(out, list(keys))
    return out


# -- category shares ------------------------------------------------------------------------------


def levels_of(df: DataFrame, c: str, limit: int = 10_000) -> list:
    """Sorted non-missing levels of a category; refuses to pull more than ``limit`` of them."""
    rows = df.select(c).filter(F.col(c).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{c} has more than {limit} levels, too many for one column each")
    return sorted(r[0] for r in rows)


def levels_of_all(df: DataFrame, cs: Sequence[str], limit: int = 10_000) -> dict[str, list[str]]:
    """Levels of several text categories from one scan, with the same bound on what is pulled."""
    rows = frequencies(df, cs).select("variable", "value").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{', '.join(cs)} have more than {limit} levels, too many for one column each")
    return {c: sorted(r["value"] for r in rows if r["variable"] == c) for c in cs}


def level_flags(c: str, levels: Sequence, prefix: str, suffix: str = "") -> dict[str, Column]:
    """One flag per level, whose mean is the level's share."""
    return {name + suffix: level_flag(c, v) for v, name in level_names(prefix, levels).items()}


def share_exprs(c: str, levels: Sequence, prefix: str, suffix: str = "") -> list[Column]:
    """Share of a key's rows in each level (rows with a missing category count in the base)."""
    return [F.avg(flag).alias(name) for name, flag in level_flags(c, levels, prefix, suffix).items()]


def category_shares(
    df: DataFrame, keys: Sequence[str], c: str, prefix: str, levels: Sequence | None = None, suffix: str = ""
) -> DataFrame:
    levels = levels_of(df, c) if levels is None else levels
    return df.filter(all_present(keys)).groupBy(*keys).agg(*share_exprs(c, levels, prefix, suffix))


# -- second-level roll-ups ------------------------------------------------------------------------


def roll_up_by_name(
    df: DataFrame, keys: Sequence[str], drop: Sequence[str] = (), marker: str = "MEAN", seen: KeyCounts | None = None
) -> DataFrame:
    """Loan to client: columns named as means get mean, sum and max; all others get the mean."""
    spec = {
        c: "mean sum max" if marker in c else "mean" for c in df.columns if c not in set(keys) and c not in set(drop)
    }
    return group_agg(df, keys, spec, seen=seen)


def roll_up_with_rest(df: DataFrame, keys: Sequence[str], spec: Spec, drop: Sequence[str] = (), seen: KeyCounts | None = None) -> DataFrame:
    """An explicit spec plus the plain mean, under its own name, of every column the spec leaves out."""
    rest = [c for c in df.columns if c not in set(spec) | set(keys) | set(drop)]
    return aggregate_parts(df, keys, [Part(spec)], means={c: F.expr(f"`{c}`") for c in rest}, seen=seen)


def mean_all(df: DataFrame, keys: Sequence[str], drop: Sequence[str] = (), suffix: str = "", seen: KeyCounts | None = None) -> DataFrame:
    """Mean of every numeric column per key."""
    skip = set(keys) | set(drop)
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]
    return aggregate_parts(df, keys, [], means={f"{c}{suffix}": F.expr(f"`{c}`") for c in numeric}, seen=seen)


# -- group statistics as row features -------------------------------------------------------------

BROADCAST_ROWS = 200_000


def small_enough(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a lookup has at most ``limit`` rows; stops counting just past the limit."""
    return df.limit(limit + 1).count() <= limit


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], check: bool = True) -> DataFrame:
    """Left join of a lookup table. It is broadcast only when its row count has been checked;
    otherwise the planner chooses, and a skewed key is split by adaptive execution."""
    if check and small_enough(table):
        table = F.broadcast(table)
    return rows.join(table, list(keys), "left")


def group_statistics(
    fit: DataFrame, apply_to: Sequence[DataFrame], key_sets: Sequence[Sequence[str]], spec: Spec
) -> list[DataFrame]:
    """Statistics of each key set, fitted on one table and joined to the rows of several.

    A join writes every column of both sides anew. The rows and each set of statistics therefore pass the joins as one
    packed column besides the keys, and become columns again once, after the last join.
    """
    used = list(dict.fromkeys(c for keys in key_sets for c in keys))
    out = [rows.selectExpr(*[f"`{c}`" for c in used], f"{_packed(rows.columns)} AS __row") for rows in apply_to]
    names = [[(f"__row.`{c}`", c) for c in rows.columns] for rows in apply_to]
    for i, keys in enumerate(key_sets):
        stats = group_agg(fit, keys, spec, suffix="_AGG_" + "_".join(keys))
        made = [c for c in stats.columns if c not in set(keys)]
        stats = fitted_table(stats.selectExpr(*[f"`{c}`" for c in keys], f"{_packed(made)} AS __stats{i}"))
        out = [rows.join(stats, list(keys), "left") for rows in out]
        # as a join by name leaves them: keys, other columns, new ones
        names = [
            [(f"__row.`{k}`", k) for k in keys] + [n for n in of if n[1] not in set(keys)] + [(f"__stats{i}.`{c}`", c) for c in made]
            for of in names
        ]
    return [rows.selectExpr(*[f"{e} AS `{c}`" for e, c in of]) for rows, of in zip(out, names, strict=True)]


def _packed(cs: Sequence[str]) -> str:
    return "struct(" + ", ".join(f"`{c}`" for c in cs) + ")"


def fitted_table(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A lookup table computed once and kept in a checkpoint, because it is applied to several
    tables; marked for broadcast only if its counted size allows it."""
    kept = checkpointed(table)
    return F.broadcast(kept) if small_enough(kept, limit) else kept


def merge_client_tables(base: DataFrame, features: Mapping[str, DataFrame], key: str, check: bool = False) -> DataFrame:
    """Left-join client-level feature tables to the base; a clashing name gets its table's prefix.

    The base and each table pass the joins as one packed column besides the key (see ``group_statistics``).
    """
    own = [c for c in base.columns if c != key]
    out = base.selectExpr(f"`{key}`", *([f"{_packed(own)} AS __row"] if own else []))
    taken = {c: f"__row.`{c}`" for c in own}
    for i, (prefix, table) in enumerate(features.items()):
        if check:
            repeated = table.groupBy(key).count().filter(F.col("count") > 1).limit(1).count()
            if repeated:
                raise ValueError(f"feature table {prefix} is not unique on {key}")
        added = [c for c in table.columns if c != key]
        packed = [f"{_packed(added)} AS __table{i}"] if added else []
        out = out.join(table.selectExpr(f"`{key}`", *packed), key, "left")
        taken |= {f"{prefix}_{c}" if c in taken else c: f"__table{i}.`{c}`" for c in added}
    return out.selectExpr(f"`{key}`", *[f"{e} AS `{c}`" for c, e in taken.items()])
