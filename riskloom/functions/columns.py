"""Column expressions shared by all feature builders.

Every function takes and returns ``Column`` objects (or column names), so whole layers of derived
features stay inside one projection and one code-generated stage. Missing is always SQL NULL:
``nan_to_null`` is applied once, right after the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

# Fixed value: the guard added to a denominator.
GUARD = 1e-5


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _cols(cs: Sequence[ColumnLike]) -> list[Column]:
    return [col(c) for c in cs]


def all_present(cs: Sequence[ColumnLike]) -> Column:
    return reduce(and_, [c.isNotNull() for c in _cols(cs)])


# -- missing values ---------------------------------------------------------------------------


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn floating NaN into NULL so that aggregates and comparisons skip it."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in floats else F.col(c) for c in df.columns])


def row_null_count(cs: Sequence[ColumnLike]) -> Column:
    return reduce(add, [c.isNull().cast("int") for c in _cols(cs)])


def nullify_where(c: ColumnLike, unwanted: Column) -> Column:
    """Blank ``c`` where ``unwanted`` holds; an unknown condition keeps the value."""
    return F.when(~F.coalesce(unwanted, F.lit(False)), col(c))


def clip_to_range(c: ColumnLike, low: float, high: float) -> Column:
    """Keep values strictly inside ``(low, high)``; everything else becomes missing."""
    return F.when((col(c) > low) & (col(c) < high), col(c))


# -- arithmetic -------------------------------------------------------------------------------


def safe_ratio(a: ColumnLike, b: ColumnLike, guard: float = GUARD) -> Column:
    """``a / (b + guard)``; an exactly cancelled denominator gives NULL rather than an ANSI error."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double") + F.lit(guard))


def plain_ratio(a: ColumnLike, b: ColumnLike) -> Column:
    """Unguarded ratio; division by zero is missing."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def row_sum(cs: Sequence[ColumnLike]) -> Column:
    """Row-wise sum in which one missing term makes the sum missing."""
    return reduce(add, _cols(cs))


def weighted_sum(weights: Mapping[str, float]) -> Column:
    return reduce(add, [F.col(c) * F.lit(w) for c, w in weights.items()])


def row_max(cs: Sequence[ColumnLike]) -> Column:
    return F.when(all_present(cs), F.greatest(*_cols(cs)))


def row_min(cs: Sequence[ColumnLike]) -> Column:
    return F.when(all_present(cs), F.least(*_cols(cs)))


def row_mean(cs: Sequence[ColumnLike]) -> Column:
    return row_sum(cs) / F.lit(float(len(cs)))


def row_var(cs: Sequence[ColumnLike]) -> Column:
    """Population variance across the columns of one row, in centred form."""
    centre = row_mean(cs)
    return reduce(add, [(c - centre) * (c - centre) for c in _cols(cs)]) / F.lit(float(len(cs)))


def floor_div(c: ColumnLike, n: int) -> Column:
    return F.floor(col(c) / F.lit(float(n)))


def whole_years(days: ColumnLike) -> Column:
    """Completed years in a relative day count of either sign."""
    return F.abs(col(days) / F.lit(365.0)).cast("int")


def recency_weighted(value: ColumnLike, age: ColumnLike) -> Column:
    """A value that fades with its age in periods (0 = now)."""
    return col(value).cast("double") / (col(age) + F.lit(1.0))


def zero_flag(c: ColumnLike) -> Column:
    """0 for an exact zero, 1 for everything else; a missing value counts as 1."""
    return F.when(col(c) == 0, F.lit(0)).otherwise(F.lit(1))


def interest(annuity: ColumnLike, terms: ColumnLike, credit: ColumnLike) -> dict[str, Column]:
    """Total interest of an annuity loan, its share of the credit and the approximate yearly rate."""
    amount = col(annuity) * col(terms) - col(credit)
    return {
        "amount": amount,
        "share": safe_ratio(amount, credit),
        "rate": F.try_divide(amount * F.lit(24.0), col(credit) * (col(terms) + F.lit(1.0))),
    }


# -- recoding ---------------------------------------------------------------------------------


def recode(c: ColumnLike, mapping: Mapping, keep_unmapped: bool = False) -> Column:
    """Dictionary recode. A ``None`` key matches missing values.

    ``keep_unmapped=True`` leaves other values as they are (replace); otherwise they become
    missing (map). Entries are literals in one CASE, so nothing is joined or shuffled.
    """
    source = col(c)
    out = None
    for old, new in mapping.items():
        hit = source.isNull() if old is None else source == F.lit(old)
        out = F.when(hit, F.lit(new)) if out is None else out.when(hit, F.lit(new))
    if out is None:
        return source if keep_unmapped else F.lit(None)
    return out.otherwise(source) if keep_unmapped else out


def as_category(c: ColumnLike) -> Column:
    return col(c).cast("string")


def one_hot(df: DataFrame, c: str, levels: Sequence, prefix: str) -> DataFrame:
    """Add one 0/1 column per given level; a missing value is 0 everywhere."""
    return df.withColumns({name: level_flag(c, v) for v, name in level_names(prefix, levels).items()})


def level_flag(c: ColumnLike, level) -> Column:
    return F.when(col(c) == F.lit(level), F.lit(1.0)).otherwise(F.lit(0.0))


def level_name(prefix: str, level) -> str:
    """Column name of one category level, free of characters that need quoting."""
    return f"{prefix}_" + "".join(ch if ch.isalnum() else "_" for ch in str(level))


def distinct_names(values: Sequence, name: Callable) -> dict:
    """A name per value; where several values have one name, the later ones get a number behind it."""
    out, used = {}, set()
    for v in values:
        n, k = name(v), 2
        while n in used:
            n, k = f"{name(v)}_{k}", k + 1
        used.add(n)
        out[v] = n
    return out


def level_names(prefix: str, levels: Sequence) -> dict:
    return distinct_names(levels, lambda v: level_name(prefix, v))


# -- scores -----------------------------------------------------------------------------------

# Lower edges of the risk bands on the 0..100 score, with their labels.
SCORE_BANDS = [(0.0, "green"), (25.0, "limegreen"), (49.5, "red"), (50.5, "orange"), (75.0, "crimson")]
# The two decision labels.
DENIED = "Credit denied"
APPROVED = "Credit approved"


def band(score: ColumnLike, bands: Sequence[tuple[float, str]] = SCORE_BANDS) -> Column:
    """Label of the half-open band ``[edge, next edge)`` that holds the score."""
    out = None
    for edge, label in sorted(bands, reverse=True):
        out = F.when(col(score) >= edge, label) if out is None else out.when(col(score) >= edge, label)
    return out


def percent_score(probability: ColumnLike) -> Column:
    return F.round(col(probability) * F.lit(100.0), 2)


def decide(probability: ColumnLike, threshold: float = 0.5) -> Column:
    return F.when(percent_score(probability) >= F.lit(threshold * 100.0), F.lit(DENIED)).otherwise(F.lit(APPROVED))


# -- column sets ------------------------------------------------------------------------------


def names_matching(names: Sequence[str], contains: Sequence[str] = (), excludes: Sequence[str] = ()) -> list[str]:
    """Names that hold all ``contains`` parts and none of the ``excludes`` parts."""
    return [n for n in names if all(p in n for p in contains) and not any(p in n for p in excludes)]


def split_by_kind(df: DataFrame, categorical: Sequence[str] = (), marker: str = "_cat_") -> tuple[list[str], list[str]]:
    """Numeric and categorical column names; strings, named columns and ``marker`` names are categories."""
    cats = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) or f.name in set(categorical) or marker in f.name
    ]
    return [c for c in df.columns if c not in set(cats)], cats


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in set(exclude)]
