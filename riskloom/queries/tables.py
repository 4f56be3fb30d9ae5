"""Queries for joins, aggregates, profiles, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.operators import aggregate as A
from riskloom.operators import profile as P
from riskloom.operators.sampling import preview, stratified_sample
from riskloom.operators.selection import label_selection
from riskloom.queries.base import Tables, all_rounded, query, rounded, scratch, sql_all_rounded, sql_spec
from riskloom.queries.loan_tables import (
    APPLICATION_NUMBERS,
    APPLICATION_TEXT,
    LOAN_TABLES,
    PREVIOUS_REAL,
    PREVIOUS_TEXT,
    PREVIOUS_WHOLE,
    oracle_text,
)
from riskloom.sources.tables import append_results

# whole thousands keep every sum exact in both engines
LOANS = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, floor(o_totalprice / 1000) AS amount, "
    "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE floor(o_totalprice / 700) END AS maybe, o_orderdate FROM {orders}"
)
LOANS_SQL = f"({LOANS.format(orders='orders')})"


def loans(t: Tables):
    return t.sql(LOANS)


def cased(c: str) -> str:
    return f"CASE WHEN {c} THEN 1 ELSE 0 END"


# -- joins ---------------------------------------------------------------------------------------

SPEC = {"amount": "mean sum max min", "maybe": "mean sum last first"}
FLAG_SPEC = {"amount": "sum max", "maybe": "sum last"}
ORDER = ["o_orderdate", "o_orderkey"]
SQL_ORDER = "(o_orderdate, o_orderkey)"


@query(
    "j1_merge_client_tables",
    sql_all_rounded(
        "SELECT c_custkey, floor(c_acctbal) AS balance, a.n AS n, a.total AS total, b.n AS second_n, b.n_lines AS n_lines FROM customer "
        f"LEFT JOIN (SELECT o_custkey, count(*) AS n, sum(amount) AS total FROM {LOANS_SQL} GROUP BY 1) a ON a.o_custkey = c_custkey "
        "LEFT JOIN (SELECT o_custkey, max(l_linenumber) AS n, count(*) AS n_lines FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) b "
        "ON b.o_custkey = c_custkey",
        ["c_custkey"],
    ),
)
def j1(t: Tables):
    base = t.customer.select("c_custkey", F.floor("c_acctbal").alias("balance"))
    first = loans(t).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
    second = (
        t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("l_linenumber").alias("n"), F.count(F.lit(1)).alias("n_lines"))
    )
    return all_rounded(A.merge_client_tables(base, {"first": first, "second": second}, "c_custkey"), ["c_custkey"])


@query(
    "j2_left_join_child",
    "SELECT o_orderkey, n_lines, quantity FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS quantity "
    "FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey",
)
def j2(t: Tables):
    child = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity")
    )
    return t.orders.select("o_orderkey").join(child, "o_orderkey", "left")


OPEN, DONE = "o_orderstatus = 'O'", "o_orderstatus = 'F'"


@query(
    "j3_outer_merge_of_subsets",
    sql_all_rounded(
        f"SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, a.* EXCLUDE (o_custkey), b.* EXCLUDE (o_custkey) FROM "
        f"(SELECT o_custkey, {sql_spec(FLAG_SPEC, '_O', None, SQL_ORDER)} FROM {LOANS_SQL} WHERE {OPEN} GROUP BY 1) a FULL JOIN "
        f"(SELECT o_custkey, {sql_spec(FLAG_SPEC, '_F', None, SQL_ORDER)} FROM {LOANS_SQL} WHERE {DONE} GROUP BY 1) b ON a.o_custkey = b.o_custkey",
        ["o_custkey"],
    ),
)
def j3(t: Tables):
    subsets = {"_O": F.col("o_orderstatus") == "O", "_F": F.col("o_orderstatus") == "F"}
    return all_rounded(A.subset_agg(loans(t), ["o_custkey"], FLAG_SPEC, subsets, ORDER), ["o_custkey"])


@query(
    "j4_inner_merge",
    "SELECT c_custkey, n, urgent FROM customer JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) a ON a.o_custkey = c_custkey "
    "JOIN (SELECT o_custkey, count(*) AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) b ON b.o_custkey = c_custkey",
)
def j4(t: Tables):
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("urgent")
    )
    return t.customer.select("c_custkey").join(counts.filter("urgent > 0"), "c_custkey")


@query(
    "j5_lookup_on_keys",
    sql_all_rounded(
        f"SELECT o_orderkey, amount, m, h FROM {LOANS_SQL} a JOIN (SELECT o_orderstatus, o_orderpriority, avg(amount) AS m, max(amount) AS h "
        f"FROM {LOANS_SQL} GROUP BY 1, 2) b ON a.o_orderstatus = b.o_orderstatus AND a.o_orderpriority = b.o_orderpriority",
        ["o_orderkey"],
    ),
)
def j5(t: Tables):
    keys = ["o_orderstatus", "o_orderpriority"]
    table = loans(t).groupBy(*keys).agg(F.avg("amount").alias("m"), F.max("amount").alias("h"))
    return all_rounded(A.lookup(loans(t), table, keys).select("o_orderkey", "amount", "m", "h"), ["o_orderkey"])


@query(
    "j6_outer_join_importances",
    "SELECT coalesce(a.part, b.part) AS part, sold, listed FROM (SELECT l_partkey AS part, count(*) AS sold FROM lineitem "
    "WHERE l_returnflag = 'R' GROUP BY 1) a FULL JOIN (SELECT p_partkey AS part, p_retailprice AS listed FROM part WHERE p_size > 10) b ON a.part = b.part",
)
def j6(t: Tables):
    sold = t.lineitem.filter("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("part")).agg(F.count(F.lit(1)).alias("sold"))
    listed = t.part.filter("p_size > 10").select(F.col("p_partkey").alias("part"), F.col("p_retailprice").alias("listed"))
    return sold.join(listed, "part", "outer")


def _overlap(name: str, table: str, key: str) -> str:
    return (
        f"SELECT '{name}' AS source, count(DISTINCT {key}) AS distinct_keys, "
        f"count(DISTINCT CASE WHEN {key} IN (SELECT c_custkey FROM customer) THEN {key} END) AS keys_in_base, "
        f"count({key}) - count(DISTINCT {key}) AS repeated_keys FROM {table}"
    )


@query(
    "j7_key_overlap",
    " UNION ALL ".join(
        [_overlap("customer", "customer", "c_custkey"), _overlap("orders", "orders", "o_custkey"), _overlap("events", "events", "user_id")]
    ),
)
def j7(t: Tables):
    return P.key_overlap(
        {"customer": (t.customer, "c_custkey"), "orders": (t.orders, "o_custkey"), "events": (t.events, "user_id")}
    )


@query(
    "j8_anti_join",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey IS NOT NULL)",
)
def j8(t: Tables):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(urgent, "c_custkey", "left_anti")


# -- aggregates ----------------------------------------------------------------------------------


@query(
    "g1_group_agg",
    sql_all_rounded(f"SELECT o_custkey, {sql_spec(SPEC, '', None, SQL_ORDER)} FROM {LOANS_SQL} GROUP BY 1", ["o_custkey"]),
)
def g1(t: Tables):
    return all_rounded(A.group_agg(loans(t), ["o_custkey"], SPEC, ORDER), ["o_custkey"])


STATES = {
    "_F": "o_orderstatus = 'F'",
    "_O": "o_orderstatus = 'O'",
    "_REST": "o_orderstatus NOT IN ('F', 'O')",
}


@query(
    "g2_subset_agg",
    sql_all_rounded(
        "SELECT o_custkey, " + ", ".join(sql_spec(SPEC, s, w, SQL_ORDER) for s, w in STATES.items()) + f" FROM {LOANS_SQL} GROUP BY 1",
        ["o_custkey"],
    ),
)
def g2(t: Tables):
    subsets = A.categories("o_orderstatus", ["F", "O"])
    return all_rounded(A.subset_agg(loans(t), ["o_custkey"], SPEC, subsets, ORDER), ["o_custkey"])


def sql_ends(keys: str, order: str, source: str, spec: dict, sql_order: str, parts: dict[str, str]) -> str:
    ranked = (
        f"SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS up, "
        f"count(*) OVER (PARTITION BY {keys}) AS size FROM {source}"
    )
    lists = ", ".join(sql_spec(spec, s, w, sql_order) for s, w in parts.items())
    return f"SELECT {keys}, {lists} FROM ({ranked}) GROUP BY {keys}"


@query(
    "g3_first_and_last_n",
    sql_all_rounded(
        sql_ends(
            "o_custkey", "o_orderdate, o_orderkey", LOANS_SQL, SPEC, SQL_ORDER,
            {"_LAST_5": "up > size - 5", "_FIRST_2": "up <= 2", "_ALL": "up > 0"},
        ),
        ["o_custkey"],
    ),
)
def g3(t: Tables):
    return all_rounded(A.agg_with_ends(loans(t), ["o_custkey"], SPEC, ORDER, last=5, first=2), ["o_custkey"])


TWO_SPEC = {"l_quantity": "mean sum max", "l_linenumber": "max"}


@query(
    "g4_group_by_two_keys",
    sql_all_rounded(f"SELECT l_orderkey, l_suppkey, {sql_spec(TWO_SPEC)} FROM lineitem GROUP BY 1, 2", ["l_orderkey", "l_suppkey"]),
)
def g4(t: Tables):
    return all_rounded(A.group_agg(t.lineitem, ["l_orderkey", "l_suppkey"], TWO_SPEC), ["l_orderkey", "l_suppkey"])


LOAN_LEVEL = (
    "SELECT l_orderkey, max(o_custkey) AS client, avg(l_linenumber) AS NUMBER_MEAN, sum(l_quantity) AS QUANTITY_SUM, "
    "max(l_quantity) AS QUANTITY_MAX FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1"
)
ROLL = {"NUMBER_MEAN": "mean sum max", "QUANTITY_SUM": "mean", "QUANTITY_MAX": "mean"}


def loan_level(t: Tables):
    return (
        t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("l_orderkey")
        .agg(
            F.max("o_custkey").alias("client"), F.avg("l_linenumber").alias("NUMBER_MEAN"),
            F.sum("l_quantity").alias("QUANTITY_SUM"), F.max("l_quantity").alias("QUANTITY_MAX"),
        )
    )


@query("g5_roll_up_by_name", sql_all_rounded(f"SELECT client, {sql_spec(ROLL)} FROM ({LOAN_LEVEL}) GROUP BY 1", ["client"]))
def g5(t: Tables):
    return all_rounded(A.roll_up_by_name(loan_level(t), ["client"], drop=["l_orderkey"]), ["client"])


@query(
    "g6_roll_up_with_rest",
    sql_all_rounded(
        f"SELECT client, {sql_spec({'QUANTITY_SUM': 'mean sum max'})}, avg(NUMBER_MEAN) AS NUMBER_MEAN, avg(QUANTITY_MAX) AS QUANTITY_MAX "
        f"FROM ({LOAN_LEVEL}) GROUP BY 1",
        ["client"],
    ),
)
def g6(t: Tables):
    return all_rounded(
        A.roll_up_with_rest(loan_level(t), ["client"], {"QUANTITY_SUM": "mean sum max"}, drop=["l_orderkey"]), ["client"]
    )


@query(
    "g7_mean_of_all",
    sql_all_rounded(
        "SELECT l_orderkey, avg(l_linenumber) AS l_linenumber_M, avg(l_quantity) AS l_quantity_M, avg(l_partkey) AS l_partkey_M FROM lineitem GROUP BY 1",
        ["l_orderkey"],
    ),
)
def g7(t: Tables):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_returnflag")
    return all_rounded(A.mean_all(df, ["l_orderkey"], suffix="_M"), ["l_orderkey"])


@query(
    "g8_category_shares",
    sql_all_rounded(
        "SELECT user_id, " + ", ".join(f"avg({cased(f'event_type = {chr(39)}{v}{chr(39)}')}) AS TYPE_{v}" for v in ("click", "error", "purchase", "signup", "view"))
        + " FROM events GROUP BY 1",
        ["user_id"],
    ),
)
def g8(t: Tables):
    return all_rounded(A.category_shares(t.events, ["user_id"], "event_type", "TYPE"), ["user_id"])


@query(
    "g9_value_counts",
    "SELECT o_orderpriority, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM orders), 6) AS percent FROM orders GROUP BY 1",
)
def g9(t: Tables):
    return rounded(P.value_counts(t.orders, "o_orderpriority"))


TARGETED = f"(SELECT *, {cased('TARGET = 1')} AS y FROM ({oracle_text('application')}))"


@query(
    "g10_target_rate",
    f"SELECT OCCUPATION_TYPE, rate FROM (SELECT OCCUPATION_TYPE, round(100.0 * sum(TARGET) / count(*), 2) AS rate FROM ({oracle_text('application')}) "
    "WHERE OCCUPATION_TYPE IS NOT NULL GROUP BY 1) WHERE rate > 0",
)
def g10(t: Tables):
    return P.target_rate(t.sql(LOAN_TABLES["application"]), "OCCUPATION_TYPE", "TARGET")


@query(
    "g11_category_by_target",
    "SELECT NAME_FAMILY_STATUS, nullif(sum(1 - TARGET), 0) AS target_0, nullif(sum(TARGET), 0) AS target_1 "
    f"FROM ({oracle_text('application')}) WHERE NAME_FAMILY_STATUS IS NOT NULL GROUP BY 1",
)
def g11(t: Tables):
    return P.category_by_target(t.sql(LOAN_TABLES["application"]), "NAME_FAMILY_STATUS", "TARGET")


def _profile_sql(c: str, kind: str, numeric: bool) -> str:
    moments = (
        f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c})::DOUBLE, 4) AS low, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25, "
        f"round(median({c}::DOUBLE), 4) AS median, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75, round(max({c})::DOUBLE, 4) AS high, NULL AS top, NULL AS top_count"
        if numeric
        else "NULL AS mean, NULL AS std, NULL AS low, NULL AS q25, NULL AS median, NULL AS q75, NULL AS high, "
        f"(SELECT {c} FROM src WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
        f"(SELECT count(*) FROM src WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 1 DESC LIMIT 1) AS top_count"
    )
    return (
        f"SELECT '{c}' AS variable, '{kind}' AS type, count(*) - count({c}) AS missing, count({c}) - count(DISTINCT {c}) AS repeated, "
        f"round(100.0 - 100.0 * (count(*) - count({c})) / count(*), 4) AS fill_percent, count({c}) AS filled, {moments} FROM src"
    )


PROFILED = {
    **{c: ("bigint", True) for c in PREVIOUS_WHOLE}, **{c: ("double", True) for c in PREVIOUS_REAL}, **{c: ("string", False) for c in PREVIOUS_TEXT},
}


@query(
    "g12_table_profile",
    f"WITH src AS ({oracle_text('previous')}) " + " UNION ALL ".join(_profile_sql(c, k, n) for c, (k, n) in PROFILED.items()),
)
def g12(t: Tables):
    return rounded(P.table_profile(t.sql(LOAN_TABLES["previous"]).select(*PROFILED)), 4)


@query(
    "g12_column_types",
    "SELECT type, n AS count, (SELECT count(*) FROM orders) AS table_rows, 6 AS table_columns FROM "
    "(VALUES ('bigint', 2), ('string', 2), ('double', 1), ('timestamp_ntz', 1)) v(type, n)",
)
def g12b(t: Tables):
    return P.column_types(t.orders).withColumnRenamed("columns", "count")


@query(
    "g13_missing_report",
    f"WITH src AS ({oracle_text('application')}) SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count(*) - count({c}) AS missing, round(100.0 * (count(*) - count({c})) / count(*), 2) AS percent FROM src"
        for c in ["SK_ID_CURR", "SEGMENT", "TARGET", *APPLICATION_TEXT, *APPLICATION_NUMBERS]
    ) + ") WHERE missing > 0",
)
def g13(t: Tables):
    return P.missing_report(t.sql(LOAN_TABLES["application"]))


@query(
    "g13_missing_total",
    "SELECT m AS missing, 8 * n AS cells, round(100.0 * m / (8 * n), 2) AS percent FROM (SELECT count(*) AS n, "
    f"2 * count(*) - count(DAYS_ENTRY_PAYMENT) - count(AMT_PAYMENT) AS m FROM ({oracle_text('installments')}))",
)
def g13b(t: Tables):
    return P.missing_total(t.sql(LOAN_TABLES["installments"]))


EDGES = [0, 50000, 100000, 200000, 400000, 600000]


@query(
    "g14_binned_distribution",
    "SELECT low::DOUBLE AS low, high::DOUBLE AS high, count(o_totalprice) AS n, round(100.0 * count(o_totalprice) / (SELECT count(*) FROM orders), 6) AS percent "
    "FROM (VALUES " + ", ".join(f"({a}, {b})" for a, b in zip(EDGES[:-1], EDGES[1:], strict=True)) + ") v(low, high) "
    "LEFT JOIN orders ON o_totalprice > low AND o_totalprice <= high GROUP BY low, high",
)
def g14(t: Tables):
    return rounded(P.binned_distribution(t.orders, "o_totalprice", EDGES))


@query(
    "g15_percentiles",
    " UNION ALL ".join(
        f"SELECT {p}::DOUBLE AS percentile, round(quantile_cont(o_totalprice, {p / 100}), 4) AS value FROM orders" for p in P.DEFAULT_PERCENTILES
    ),
)
def g15(t: Tables):
    return rounded(P.percentiles(t.orders, "o_totalprice"), 4)


def _box(where: str, level: str, k: float) -> str:
    q = f"SELECT quantile_cont(amount, 0.25) AS q25, median(amount) AS median, quantile_cont(amount, 0.75) AS q75, avg(amount) AS mean FROM {LOANS_SQL} WHERE {where}"
    return (
        f"SELECT {level} AS level, q25, median, q75, round(mean, 6) AS mean, "
        f"(SELECT min(amount) FROM {LOANS_SQL} WHERE {where} AND amount >= q25 - {k} * (q75 - q25)) AS whisker_low, "
        f"(SELECT max(amount) FROM {LOANS_SQL} WHERE {where} AND amount <= q75 + {k} * (q75 - q25)) AS whisker_high FROM ({q})"
    )


@query("g16_box_stats", _box("true", "NULL", 0.2) + " UNION ALL " + " UNION ALL ".join(_box(f"o_orderstatus = '{s}'", f"'{s}'", 3) for s in "FOP"))
def g16(t: Tables):
    df = loans(t).withColumn("amount", F.col("amount").cast("double"))
    return rounded(P.box_stats(df, "amount", 0.2).unionByName(P.box_stats(df, "amount", 3, "o_orderstatus", ["F", "O", "P"])))


@query(
    "g17_density_by_target",
    "SELECT target, least(floor((amount - lo) / ((hi - lo) / 25)), 24)::BIGINT AS bin, count(*) AS n FROM "
    f"(SELECT amount::DOUBLE AS amount, {cased(DONE)} AS target, min(amount) OVER () AS lo, max(amount) OVER () AS hi FROM {LOANS_SQL}) GROUP BY 1, 2",
)
def g17(t: Tables):
    df = loans(t).withColumn("y", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))
    return P.density_by_class(df, "amount", "y", 25)


REF_NUM = APPLICATION_NUMBERS
REF_CAT = APPLICATION_TEXT
REF_SQL = f"WITH src AS MATERIALIZED ({oracle_text('application')}) " + " UNION ALL ".join(
    [f"SELECT '{c}' AS variable, round(avg({c}), 6) AS mean, round(median({c}::DOUBLE), 6) AS median, NULL AS mode FROM src" for c in REF_NUM]
    + [
        f"SELECT '{c}', NULL, NULL, (SELECT {c} FROM src WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1)"
        for c in REF_CAT
    ]
)


@query("g18_reference_table", REF_SQL)
def g18(t: Tables):
    return rounded(P.reference_table(t.sql(LOAN_TABLES["application"]).select(*REF_NUM, *REF_CAT)))


@query(
    "g19_duplicate_rows",
    "SELECT count(*) AS table_rows, count(DISTINCT (o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)) AS distinct_rows, "
    "count(*) - count(DISTINCT (o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)) AS duplicate_rows FROM orders",
)
def g19(t: Tables):
    return P.duplicate_rows(t.orders)


STAT_KEYS = [["o_orderstatus", "o_orderpriority"], ["o_orderstatus"]]
STAT_SPEC = {"amount": "mean max min", "maybe": "mean max"}


def _stat_join(fit: str, rows: str) -> str:
    out = f"SELECT o_orderkey, r.o_orderstatus, r.o_orderpriority{{}} FROM {rows} r"
    cols = ""
    for i, keys in enumerate(STAT_KEYS):
        k = ", ".join(keys)
        out += f" LEFT JOIN (SELECT {k}, {sql_spec(STAT_SPEC, '_AGG_' + '_'.join(keys))} FROM {fit} GROUP BY {k}) s{i} ON " + " AND ".join(
            f"s{i}.{c} = r.{c}" for c in keys
        )
        cols += f", s{i}.* EXCLUDE ({k})"
    return out.format(cols)


@query(
    "g20_group_statistics",
    sql_all_rounded(
        _stat_join(f"(SELECT * FROM {LOANS_SQL} WHERE o_orderdate < DATE '1998-01-01')", f"(SELECT * FROM {LOANS_SQL} WHERE o_orderdate >= DATE '1998-01-01')"),
        ["o_orderkey", "o_orderstatus", "o_orderpriority"],
    ),
)
def g20(t: Tables):
    fit = loans(t).filter("o_orderdate < DATE '1998-01-01'")
    rows = loans(t).filter("o_orderdate >= DATE '1998-01-01'").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    (out,) = A.group_statistics(fit, [rows], STAT_KEYS, STAT_SPEC)
    return all_rounded(out, ["o_orderkey", "o_orderstatus", "o_orderpriority"])


@query(
    "g21_sentinel_report",
    f"WITH src AS ({oracle_text('previous')}) " + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {c} = {v}) AS hits, round(100.0 * count(*) FILTER (WHERE {c} = {v}) / count(*), 2) AS percent FROM src"
        for c, v in (("DAYS_FIRST_DUE", 365243), ("SELLERPLACE_AREA", 4000000))
    ),
)
def g21(t: Tables):
    return P.sentinel_report(t.sql(LOAN_TABLES["previous"]), {"DAYS_FIRST_DUE": 365243, "SELLERPLACE_AREA": 4000000})


# -- sorts, limits, sets, samples ----------------------------------------------------------------


@query(
    "l1_mixed_sort_nulls_last",
    "SELECT * FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY maybe DESC NULLS LAST, "
    f"o_orderdate ASC NULLS LAST, o_orderkey) AS pos FROM {LOANS_SQL}) WHERE pos <= 3",
)
def l1(t: Tables):
    # the limit on the position is pushed below the shuffle, so no task sorts a whole hot key
    w = Window.partitionBy("o_custkey").orderBy(F.desc_nulls_last("maybe"), F.asc_nulls_last("o_orderdate"), F.asc("o_orderkey"))
    return loans(t).withColumn("pos", F.row_number().over(w)).filter("pos <= 3").select("o_custkey", "o_orderkey", "pos")


@query("l2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def l2(t: Tables):
    return P.top_k(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", 25)


TOP = "SELECT l_partkey AS feature FROM lineitem GROUP BY 1 ORDER BY {} DESC, 1 LIMIT {}"


@query(
    "l3_union_of_labelled_sets",
    f"SELECT p_partkey AS feature, CASE WHEN p_partkey IN (SELECT feature FROM ({TOP.format('count(*)', 15)})) THEN 'Select' ELSE 'Delete' END AS action FROM part",
)
def l3(t: Tables):
    counts = t.lineitem.groupBy(F.col("l_partkey").alias("feature")).agg(F.count(F.lit(1)).alias("n"))
    return label_selection(P.top_k(counts, "n", "feature", 15), t.part.select(F.col("p_partkey").alias("feature")))


@query(
    "l4_set_operations",
    f"WITH a AS ({TOP.format('count(*)', 40)}), b AS ({TOP.format('sum(l_quantity)', 40)}) "
    "SELECT 'union' AS op, feature FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL "
    "SELECT 'difference', feature FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL "
    "SELECT 'intersection', feature FROM (SELECT * FROM a INTERSECT SELECT * FROM b)",
)
def l4(t: Tables):
    stats = t.lineitem.groupBy(F.col("l_partkey").alias("feature")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    a, b = P.top_k(stats, "n", "feature", 40).select("feature"), P.top_k(stats, "q", "feature", 40).select("feature")
    parts = {"union": a.union(b).distinct(), "difference": a.exceptAll(b), "intersection": a.intersect(b)}
    out = None
    for op, df in parts.items():
        df = df.select(F.lit(op).alias("op"), "feature")
        out = df if out is None else out.unionByName(df)
    return out


def _hash_sql(key: str, seed: int) -> str:
    return f"md5('{seed}:' || {key})"


@query(
    "l6_stratified_sample",
    f"SELECT SK_ID_CURR, TARGET FROM (SELECT SK_ID_CURR, TARGET, row_number() OVER (PARTITION BY TARGET ORDER BY {_hash_sql('SK_ID_CURR', 84)}, SK_ID_CURR) AS n "
    f"FROM ({oracle_text('application')}) WHERE TARGET IS NOT NULL) WHERE n <= 100",
)
def l6(t: Tables):
    return stratified_sample(t.sql(LOAN_TABLES["application"]).select("SK_ID_CURR", "TARGET"), "TARGET", "SK_ID_CURR", 100, 84)


@query("l8_preview", f"SELECT * FROM orders ORDER BY {_hash_sql('o_orderkey', 84)}, o_orderkey LIMIT 20")
def l8(t: Tables):
    return preview(t.orders, 20, "o_orderkey", 84)


@query(
    "l7_append_results",
    "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT o_orderpriority, count(*) FROM orders GROUP BY 1",
)
def l7(t: Tables):
    path = scratch(t.spark)
    append_results(t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), path)
    append_results(t.orders.groupBy(F.col("o_orderpriority").alias("o_orderstatus")).agg(F.count(F.lit(1)).alias("n")), path)
    return t.spark.read.parquet(path)
