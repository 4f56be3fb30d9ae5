"""Registry, table access and the SQL text generator for spec-driven aggregates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.aggregate import stat_name, stats_of
from riskloom.session import dealt, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver tables of one folder, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run a text whose tables are named in braces. Customers are dealt by their number: a row of a few bytes on
        disk becomes one of hundreds of columns without a shuffle on the way."""
        names = ("customer", "orders", "lineitem", "events", "labels", "documents")
        used = {n: getattr(self, n) for n in names if "{" + n + "}" in text}
        if "customer" in used:
            used["customer"] = dealt(used["customer"])
        return self.spark.sql(text, **used)


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def once(build: Callable[[Tables], object]):
    """Build a staged result once per session and folder; its tables are kept below the shared folder."""
    kept: dict[tuple[str, str], object] = {}

    def get(t: Tables):
        at = t.spark.sparkContext.applicationId, t.folder
        if at not in kept:
            kept[at] = build(t)
        return kept[at]

    return get


def scratch(spark: SparkSession) -> str:
    """A new folder for a round trip, below the session's shared folder."""
    return shared_folder(spark)


# -- comparable output -----------------------------------------------------------------------------


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column; adding 0.0 turns a negative zero into zero."""
    real = (T.DoubleType, T.FloatType)
    return df.selectExpr(
        *[
            f"round(cast(`{f.name}` as double), {digits}) + 0.0D AS `{f.name}`" if isinstance(f.dataType, real) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def all_rounded(df: DataFrame, keys: Sequence[str], digits: int = 6) -> DataFrame:
    """Keys as they are, every other column as a rounded double.

    Means of whole numbers often end in an exact half of the last digit, where the order of a sum
    decides the rounding. A small shift on both sides moves such values off the edge.
    """
    others = [c for c in df.columns if c not in set(keys)]
    return df.selectExpr(
        *keys, *[f"round(cast(`{c}` as double) + {shift(digits)}D, {digits}) + 0.0D AS `{c}`" for c in others]
    )


def shift(digits: int) -> str:
    return f"{3.0 * 10.0 ** -(digits + 2):.{digits + 3}f}"


def sql_all_rounded(inner: str, keys: Sequence[str], digits: int = 6) -> str:
    """The same rounding in the oracle."""
    k = ", ".join(keys)
    return f"SELECT {k}, round(COLUMNS(* EXCLUDE ({k}))::DOUBLE + {shift(digits)}, {digits}) + 0.0 FROM ({inner}) AS src"


# -- SQL text of spec-driven aggregates ------------------------------------------------------------


def sql_stat(column: str, stat: str, where: str | None = None, order: str | None = None) -> str:
    v = column if where is None else f"CASE WHEN {where} THEN {column} END"
    if stat == "sum":
        if where is None:
            return f"coalesce(sum({v}), 0)"
        return f"CASE WHEN count(*) FILTER (WHERE {where}) > 0 THEN coalesce(sum({v}), 0) END"
    if stat in ("first", "last"):
        fn = "arg_min" if stat == "first" else "arg_max"
        extra = "" if where is None else f" AND ({where})"
        return f"{fn}({column}, {order}) FILTER (WHERE {column} IS NOT NULL{extra})"
    fn = {"mean": "avg", "max": "max", "min": "min", "count": "count", "median": "median"}[stat]
    return f"{fn}({v})"


def sql_spec(spec: Mapping, suffix: str = "", where: str | None = None, order: str | None = None) -> str:
    """Select-list entries of one spec over one row subset."""
    return ", ".join(
        f"{sql_stat(c, s, where, order)} AS {stat_name(c, s, suffix)}" for c, s in stats_of(spec)
    )
