"""Queries for weighted means, ordered ends, ranks and empirical distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import aggregate as A
from riskloom.operators import ordered as O
from riskloom.operators.prefix import empirical_cdf
from riskloom.queries.base import Tables, all_rounded, query, rounded, sql_all_rounded
from riskloom.queries.tables import LOANS_SQL, loans

EVENTS = (
    "SELECT user_id, ts, event_id, value, CASE WHEN event_type IN ('click', 'error') THEN NULL ELSE floor(value) END AS gappy FROM {events}"
)
EVENTS_SQL = EVENTS.format(events="events")


def _ewm_sql(partition: str, order: str, alpha: float, reach: str) -> str:
    join = "a.rn >= b.rn" + (f" AND a.{partition} = b.{partition}" if partition else "") + reach
    over = (f"PARTITION BY {partition} " if partition else "") + f"ORDER BY {order}"
    w = f"pow({1 - alpha!r}, a.rn - b.rn)"
    return (
        f"WITH n AS (SELECT *, row_number() OVER ({over}) AS rn FROM ({EVENTS_SQL})) "
        f"SELECT a.event_id, round(sum(b.value * {w}) / sum({w}), 6) AS EXP_value, "
        f"round(sum(b.gappy * {w}) / sum({w}) FILTER (WHERE b.gappy IS NOT NULL), 6) AS EXP_gappy "
        f"FROM n a JOIN n b ON {join} GROUP BY a.event_id"
    )


@query("w1_ewm_mean", _ewm_sql("user_id", "ts, event_id", 0.8, ""))
def w1(t: Tables):
    out = O.ewm_mean(t.sql(EVENTS), ["value", "gappy"], ["user_id"], ["ts", "event_id"], 0.8)
    return rounded(out.select("event_id", "EXP_value", "EXP_gappy"))


@query("w2_ewm_mean_global", _ewm_sql("", "user_id, ts, event_id", 0.5, " AND a.rn - b.rn < 200"))
def w2(t: Tables):
    out = O.ewm_mean_global(t.sql(EVENTS), ["value", "gappy"], ["user_id", "ts", "event_id"], 0.5)
    return rounded(out.select("event_id", "EXP_value", "EXP_gappy"))


def _ends(name: str, direction: str, n: int) -> str:
    return (
        f"SELECT '{name}' AS side, l_orderkey, l_partkey, l_suppkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey "
        f"ORDER BY l_linenumber {direction}, l_partkey {direction}, l_suppkey {direction}) AS rn FROM lineitem) WHERE rn <= {n}"
    )


@query("w3_take_first_and_last", _ends("first", "ASC", 2) + " UNION ALL " + _ends("last", "DESC", 3))
def w3(t: Tables):
    keys, order = ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"]
    df = t.lineitem.select(*keys, *order)
    first = A.take_first(df, keys, order, 2).withColumn("side", F.lit("first"))
    return first.unionByName(A.take_last(df, keys, order, 3).withColumn("side", F.lit("last")))


@query(
    "w4_ordered_first_last",
    sql_all_rounded(
        "SELECT user_id, arg_min(gappy, (ts, event_id)) FILTER (WHERE gappy IS NOT NULL) AS GAPPY_FIRST, "
        "arg_max(gappy, (ts, event_id)) FILTER (WHERE gappy IS NOT NULL) AS GAPPY_LAST, arg_max(value, (ts, event_id)) AS VALUE_LAST "
        f"FROM ({EVENTS_SQL}) GROUP BY 1",
        ["user_id"],
    ),
)
def w4(t: Tables):
    out = A.group_agg(t.sql(EVENTS), ["user_id"], {"gappy": "first last", "value": "last"}, ["ts", "event_id"])
    return all_rounded(out, ["user_id"])


IMPORTANCE_SQL = "SELECT p_brand AS feature, sum(p_size) AS importance FROM part GROUP BY 1"


def importances(t: Tables):
    return t.part.groupBy(F.col("p_brand").alias("feature")).agg(F.sum("p_size").alias("importance"))


@query("w5_rank_by", f"SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) - 1 AS ranking FROM ({IMPORTANCE_SQL})")
def w5(t: Tables):
    return O.rank_by(importances(t), "importance", "feature")


@query(
    "w6_empirical_cdf",
    "SELECT o_orderstatus, amount, count(*) AS n, round(min((i - 1) / (size - 1)), 6) AS cdf_low, round(max((i - 1) / (size - 1)), 6) AS cdf_high "
    "FROM (SELECT o_orderstatus, amount, row_number() OVER (PARTITION BY o_orderstatus ORDER BY amount) AS i, count(*) OVER (PARTITION BY o_orderstatus) AS size "
    f"FROM {LOANS_SQL}) GROUP BY 1, 2",
)
def w6(t: Tables):
    return rounded(empirical_cdf(loans(t), "amount", ["o_orderstatus"]))


CUMULATIVE = (
    "SELECT feature, importance, importance / sum(importance) OVER () AS share, row_number() OVER w AS position, "
    "sum(importance) OVER (w ROWS UNBOUNDED PRECEDING) / sum(importance) OVER () AS cumulative "
    f"FROM ({IMPORTANCE_SQL}) WINDOW w AS (ORDER BY importance DESC, feature)"
)


@query("w7_cumulative_share", f"SELECT feature, importance, round(share, 6) AS share, position, round(cumulative, 6) AS cumulative FROM ({CUMULATIVE})")
def w7(t: Tables):
    return rounded(O.cumulative_share(importances(t), "importance", "feature"))


@query("w7_needed_for_share", f"SELECT min(position) AS needed FROM ({CUMULATIVE}) WHERE cumulative > 0.9")
def w7b(t: Tables):
    return O.needed_for_share(importances(t), "importance", "feature", 0.9)
