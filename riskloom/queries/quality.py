"""Queries for imputation, encoding, correlation, selection and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import correlate as C
from riskloom.operators import drift as D
from riskloom.operators import encode as E
from riskloom.operators import impute as I
from riskloom.operators import ordered as O
from riskloom.operators import selection as S
from riskloom.queries.base import Tables, all_rounded, query, rounded, sql_all_rounded
from riskloom.operators.prefix import range_positions
from riskloom.queries.loan_tables import APPLICATION_NUMBERS, APPLICATION_TEXT, LOAN_TABLES, PREVIOUS_REAL, PREVIOUS_TEXT, oracle_text
from riskloom.functions.columns import one_hot, recode

APP = oracle_text("application")
WITH_APP = f"WITH app AS MATERIALIZED ({APP}) "
NUMBERS = APPLICATION_NUMBERS
# train and test are told apart by market segment
TRAIN, TEST = "SEGMENT <> 'BUILDING'", "SEGMENT = 'BUILDING'"


def application(t: Tables):
    return t.sql(LOAN_TABLES["application"])


@query(
    "q1_median_impute",
    sql_all_rounded(
        WITH_APP + "SELECT SK_ID_CURR, " + ", ".join(
            f"coalesce({c}, (SELECT median({c}) FROM app WHERE {TRAIN})) AS {c}" for c in NUMBERS
        ) + f" FROM app",
        ["SK_ID_CURR"],
    ),
)
def q1(t: Tables):
    df = application(t)
    return all_rounded(I.fill(df.select("SK_ID_CURR", *NUMBERS), I.fit_medians(df.filter(TRAIN), NUMBERS)), ["SK_ID_CURR"])


CATS = APPLICATION_TEXT


@query(
    "q2_mode_impute",
    WITH_APP + "SELECT SK_ID_CURR, " + ", ".join(
        f"coalesce({c}, (SELECT {c} FROM app WHERE {c} IS NOT NULL AND {TRAIN} GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}" for c in CATS
    ) + f" FROM app",
)
def q2(t: Tables):
    df = application(t)
    (out,) = I.impute(df.filter(TRAIN), df.select("SK_ID_CURR", *CATS), numeric=[], text=CATS)
    return out


SPARSE = APPLICATION_TEXT + APPLICATION_NUMBERS


@query(
    "q3_drop_sparse",
    WITH_APP + " UNION ALL ".join(
        f"SELECT variable FROM (SELECT '{c}' AS variable, round(100.0 * (count(*) - count({c})) / count(*), 2) AS p FROM app) WHERE p > 30"
        for c in SPARSE
    ),
)
def q3(t: Tables):
    _, gone = I.drop_sparse(application(t).select(*SPARSE), 30)
    return t.spark.createDataFrame([(c,) for c in gone], "variable string")


PREV = oracle_text("previous")
CORR = PREVIOUS_REAL


def _corr_sql(source: str, cs: list[str]) -> str:
    """All pairs from one pass; a constant column has no correlation."""
    pairs = [(a, b) for i, a in enumerate(cs) for b in cs[i + 1 :]]
    cells = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': corr({a}, {b})}}" for a, b in pairs)
    return f"SELECT e.a AS a, e.b AS b, CASE WHEN isfinite(e.r) THEN e.r END AS r FROM (SELECT unnest([{cells}]) AS e FROM ({source}))"


CORR_SQL = _corr_sql(PREV, CORR)
APP_CORR_SQL = _corr_sql(APP, APPLICATION_NUMBERS)


@query("q4_drop_correlated", f"SELECT DISTINCT b AS variable FROM ({CORR_SQL}) WHERE abs(r) > 0.7")
def q4(t: Tables):
    _, gone = C.drop_correlated(t.sql(LOAN_TABLES["previous"]).select("SK_ID_PREV", *CORR), 0.7, protect=["SK_ID_PREV"])
    return t.spark.createDataFrame([(c,) for c in gone], "variable string")


@query("q5_correlation_matrix", f"SELECT a, b, round(r, 6) + 0.0 AS r FROM ({CORR_SQL})")
def q5(t: Tables):
    return rounded(C.correlation_matrix(t.sql(LOAN_TABLES["previous"]), CORR))


@query("q5_correlation_matrix_wide", f"SELECT a, b, round(r, 6) + 0.0 AS r FROM ({APP_CORR_SQL})")
def q5b(t: Tables):
    return rounded(C.correlation_matrix(application(t), APPLICATION_NUMBERS))


@query("q4_drop_correlated_wide", f"SELECT DISTINCT b AS variable FROM ({APP_CORR_SQL}) WHERE abs(r) > 0.7")
def q4b(t: Tables):
    _, gone = C.drop_correlated(application(t).select("SK_ID_CURR", *APPLICATION_NUMBERS), 0.7, protect=["SK_ID_CURR"])
    return t.spark.createDataFrame([(c,) for c in gone], "variable string")


PHI_PAIRS = [(a, b) for i, a in enumerate(PREVIOUS_TEXT) for b in PREVIOUS_TEXT[i + 1 :]]


def _chi_sql(a: str, b: str) -> str:
    src = f"SELECT {a} AS va, {b} AS vb, count(*) AS n FROM prev WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2"
    return (
        f"SELECT '{a}' AS a, '{b}' AS b, total, r, c, total * (term - 1) AS chi2, sqrt(greatest(term - 1, 0) / (least(r, c) - 1)) AS cramers_v FROM ("
        "SELECT sum(n)::BIGINT AS total, count(DISTINCT va) AS r, count(DISTINCT vb) AS c, sum(n::DOUBLE * n / (nr::DOUBLE * nc)) AS term FROM ("
        f"SELECT *, sum(n) OVER (PARTITION BY va) AS nr, sum(n) OVER (PARTITION BY vb) AS nc FROM ({src})))"
    )


@query(
    "q6_chi_squared",
    f"WITH prev AS MATERIALIZED ({PREV}) SELECT a, b, total, r, c, round(chi2, 6) + 0.0 AS chi2, round(cramers_v, 6) + 0.0 AS cramers_v FROM ("
    + " UNION ALL ".join(_chi_sql(a, b) for a, b in PHI_PAIRS) + ")",
)
def q6(t: Tables):
    return rounded(C.chi_squared(t.sql(LOAN_TABLES["previous"]), PHI_PAIRS))


@query("q6_phi_k_matrix")
def q6b(t: Tables):
    return C.phi_k(t.sql(LOAN_TABLES["previous"]), PHI_PAIRS)


@query("q6_phi_k_target")
def q6c(t: Tables):
    """The ten columns most associated with the target, of all of the application."""
    df = C.equal_width_bins(application(t).select("TARGET", *APPLICATION_TEXT, *APPLICATION_NUMBERS), APPLICATION_NUMBERS)
    return C.phi_k_with_target(df, [*APPLICATION_TEXT, *APPLICATION_NUMBERS], "TARGET", 10)


SPLITS = {"price": "o_totalprice", "shifted": "o_totalprice + 100000 * (o_custkey % 7)", "client": "o_custkey"}
HALVES = "SELECT " + ", ".join(f"(2 * row_number() OVER (ORDER BY {e}, o_orderkey) <= count(*) OVER ())::INT AS {n}" for n, e in SPLITS.items()) + " FROM orders"
SPLIT_PAIRS = [("price", "shifted"), ("price", "client"), ("shifted", "client")]


@query(
    "q6_phi_k_median_splits",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(CASE WHEN chi2 <= 1 THEN 0 ELSE sin(pi() / 2 * sqrt((chi2 - 1) / (n - 1))) END, 3) + 0.0 AS phi_k "
        f"FROM (SELECT count(*) AS n, count(*) * pow(4.0 * count(*) FILTER ({a} = 1 AND {b} = 1) / count(*) - 1, 2) AS chi2 FROM ({HALVES}))"
        for a, b in SPLIT_PAIRS
    ),
)
def q6d(t: Tables):
    """Of two columns cut at their medians, Phi-K has a closed form: the quadrants of a bivariate normal."""
    rows = t.orders.select("o_orderkey", *[F.expr(e).alias(n) for n, e in SPLITS.items()])
    total = rows.count()
    for n in SPLITS:
        ranked = range_positions(rows.withColumn("all", F.lit(0)), ["all"], [n, "o_orderkey"])
        rows = ranked.withColumn(n, (2 * (F.col("rank") + 1) <= total).cast("int")).drop("rank", "all")
    return rounded(C.phi_k(rows, SPLIT_PAIRS), 3)


CONST = {"always": "1", "never": "CAST(NULL AS INT)", "half": "CASE WHEN c_nationkey > 5 THEN 1 END", "varied": "c_nationkey"}


@query(
    "q7_drop_constant",
    " UNION ALL ".join(
        f"SELECT variable FROM (SELECT '{n}' AS variable, count(DISTINCT coalesce(CAST({e} AS VARCHAR), 'missing')) AS d FROM customer) WHERE d <= 1"
        for n, e in CONST.items()
    ),
)
def q7(t: Tables):
    df = t.customer.select(*[F.expr(e.replace("VARCHAR", "STRING")).alias(n) for n, e in CONST.items()])
    _, gone = S.drop_constant(df)
    return t.spark.createDataFrame([(c,) for c in gone], "variable string")


SEEN = ["NAME_GOODS_CATEGORY", "NAME_TYPE_SUITE"]


def _seen_sql(c: str) -> str:
    return (
        f"SELECT {c} AS v, row_number() OVER (ORDER BY seen_at) AS code FROM (SELECT {c}, min((SK_ID_CURR, DAYS_DECISION, SK_ID_PREV)) AS seen_at FROM ({PREV}) GROUP BY 1)"
    )


@query(
    "q8_label_encode_first_seen",
    "SELECT SK_ID_PREV, " + ", ".join(f"s{i}.code AS {c}" for i, c in enumerate(SEEN)) + f" FROM ({PREV}) p "
    + " ".join(f"LEFT JOIN ({_seen_sql(c)}) s{i} ON s{i}.v IS NOT DISTINCT FROM p.{c}" for i, c in enumerate(SEEN)),
)
def q8(t: Tables):
    df = t.sql(LOAN_TABLES["previous"]).select("SK_ID_PREV", "SK_ID_CURR", "DAYS_DECISION", *SEEN)
    return E.label_encode_first_seen(df, SEEN, ["SK_ID_CURR", "DAYS_DECISION", "SK_ID_PREV"]).select("SK_ID_PREV", *SEEN)


@query(
    "q9_ordinal_encode",
    "SELECT SK_ID_BUREAU, MONTHS_BALANCE, CASE STATUS WHEN 'C' THEN 0 WHEN '0' THEN 1 WHEN '1' THEN 2 WHEN '2' THEN 3 WHEN 'X' THEN 4 "
    f"WHEN '3' THEN 5 WHEN '4' THEN 6 WHEN '5' THEN 7 END AS code FROM ({oracle_text('bureau_balance')})",
)
def q9(t: Tables):
    from riskloom.plans.bureau import STATUS_CODES

    return t.sql(LOAN_TABLES["bureau_balance"]).select("SK_ID_BUREAU", "MONTHS_BALANCE", recode("STATUS", STATUS_CODES).alias("code"))


@query(
    "q10_one_hot",
    "SELECT o_orderkey, " + ", ".join(f"(CASE WHEN o_orderstatus = '{v}' THEN 1 ELSE 0 END)::DOUBLE AS ST_{v}" for v in "FOP") + " FROM orders",
)
def q10(t: Tables):
    return one_hot(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O", "P"], "ST").drop("o_orderstatus")


@query(
    "q11_response_encode",
    f"SELECT SK_ID_CURR, round(p0, 6) AS OCCUPATION_TYPE_0, round(p1, 6) AS OCCUPATION_TYPE_1 FROM ({APP}) a LEFT JOIN ("
    f"SELECT OCCUPATION_TYPE AS o, avg(1 - TARGET) AS p0, avg(TARGET) AS p1 FROM ({APP}) WHERE {TRAIN} GROUP BY 1) ON o = OCCUPATION_TYPE WHERE {TEST}",
)
def q11(t: Tables):
    df = application(t).select("SK_ID_CURR", "TARGET", "SEGMENT", "OCCUPATION_TYPE")
    (out,) = E.response_encode(df.filter(TRAIN), [df.filter(TEST).select("SK_ID_CURR", "OCCUPATION_TYPE")], ["OCCUPATION_TYPE"], "TARGET")
    return rounded(out)


@query(
    "q12_standard_scale",
    WITH_APP + "SELECT SK_ID_CURR, " + ", ".join(
        f"round(coalesce(({c} - (SELECT avg({c}) FROM app WHERE {TRAIN})) / (SELECT stddev_pop({c}) FROM app WHERE {TRAIN}), 0), 6) + 0.0 AS {c}"
        for c in NUMBERS
    ) + f" FROM app",
)
def q12(t: Tables):
    df = application(t).select("SK_ID_CURR", "SEGMENT", *NUMBERS)
    return rounded(E.standard_scale(df, E.fit_standard(df.filter(TRAIN), NUMBERS)).drop("SEGMENT"))


# two importance tables with one row per brand
A_SQL = "SELECT p_brand AS feature, sum(p_size) AS a FROM part WHERE p_size > 10 GROUP BY 1"
B_SQL = "SELECT p_brand AS feature, count(*) AS b FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1"


def two_importances(t: Tables):
    a = t.part.filter("p_size > 10").groupBy(F.col("p_brand").alias("feature")).agg(F.sum("p_size").alias("a"))
    b = t.part.join(t.lineitem, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("feature")).agg(F.count(F.lit(1)).alias("b"))
    return a, b


def _norm(sql: str, v: str) -> str:
    return f"SELECT *, ({v} - min({v}) OVER ()) / (max({v}) OVER () - min({v}) OVER ()) AS {v}_normalized FROM ({sql})"


COMBINED = (
    f"SELECT coalesce(x.feature, y.feature) AS feature, a_normalized, b_normalized, a_normalized + b_normalized AS combined "
    f"FROM ({_norm(A_SQL, 'a')}) x FULL JOIN ({_norm(B_SQL, 'b')}) y ON x.feature = y.feature"
)


def combined(t: Tables):
    a, b = two_importances(t)
    return S.combine_importances(
        S.normalised_importance(a, "a", "a"), S.normalised_importance(b, "b", "b"), "a_normalized", "b_normalized"
    ).select("feature", "a_normalized", "b_normalized", "combined")


@query("q13_minmax_scale", f"SELECT feature, a, round(a_normalized, 6) AS scaled FROM ({_norm(A_SQL, 'a')})")
def q13(t: Tables):
    return rounded(O.minmax_scale(two_importances(t)[0], "a", "scaled"))


@query("q14_combined_importance", f"SELECT feature, round(a_normalized, 6) AS a_normalized, round(b_normalized, 6) AS b_normalized, round(combined, 6) AS combined FROM ({COMBINED})")
def q14(t: Tables):
    return rounded(combined(t))


def _action(condition: str) -> str:
    return f"SELECT feature, CASE WHEN {condition} THEN 'Select' ELSE 'Delete' END AS action FROM ({COMBINED}) q"


def _best(v: str, k: int) -> str:
    return f"feature IN (SELECT feature FROM ({COMBINED}) ORDER BY {v} DESC NULLS LAST, feature LIMIT {k})"


@query("q14_select_over_02", _action("combined > 0.2"))
def q14b(t: Tables):
    return S.select_over(combined(t), 0.2)


@query("q14_select_over_05", _action("combined > 0.5"))
def q14c(t: Tables):
    return S.select_over(combined(t), 0.5)


@query("q14_select_top_combined", _action(_best("combined", 15)))
def q14d(t: Tables):
    return S.select_top_combined(combined(t), 15)


@query("q14_select_top_10_of_each", _action(f"{_best('a_normalized', 10)} OR {_best('b_normalized', 10)}"))
def q14e(t: Tables):
    return S.select_top_of_each(combined(t), ["a_normalized", "b_normalized"], 10)


@query("q14_select_top_25_of_each", _action(f"{_best('a_normalized', 25)} OR {_best('b_normalized', 25)}"))
def q14f(t: Tables):
    return S.select_top_of_each(combined(t), ["a_normalized", "b_normalized"], 25)


@query(
    "q15_zero_importance",
    "SELECT feature, 0.0::DOUBLE AS importance FROM (SELECT p_partkey AS feature, sum(CASE WHEN l_quantity > 49 THEN 1 ELSE 0 END) AS hits "
    "FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1) WHERE hits = 0",
)
def q15(t: Tables):
    rows = t.part.join(t.lineitem, F.col("l_partkey") == F.col("p_partkey"))
    return S.zero_importance(rows.select(F.col("p_partkey").alias("feature"), F.when(F.col("l_quantity") > 49, 1.0).otherwise(0.0).alias("importance")))


@query(
    "q16_class_weights",
    f"SELECT TARGET, count(*) AS n, round((SELECT count(*) FROM ({APP})) / (2.0 * count(*)), 6) AS weight FROM ({APP}) GROUP BY 1",
)
def q16(t: Tables):
    return rounded(E.class_weights(application(t), "TARGET"))


# -- drift: orders before and after a date -------------------------------------------------------

DRIFT = (
    "SELECT floor(o_totalprice / 1000) * (CASE WHEN o_orderdate < DATE '1998-01-01' THEN 1 ELSE 1.25 END) AS amount, "
    "CAST(o_custkey AS DOUBLE) AS client, o_orderpriority AS priority, o_orderstatus AS status, o_orderdate < DATE '1998-01-01' AS early FROM {orders}"
)
DRIFT_SQL = DRIFT.format(orders="orders")


def sides(t: Tables):
    df = t.sql(DRIFT).withColumn("amount", F.col("amount").cast("double"))
    return df.filter("early"), df.filter("not early")


def _distance_sql(c: str) -> str:
    return (
        f"WITH s AS (SELECT {c}::DOUBLE AS v, early FROM ({DRIFT_SQL})), g AS (SELECT v, count(*) FILTER (WHERE early) AS a, count(*) FILTER (WHERE NOT early) AS b FROM s GROUP BY 1), "
        "c AS (SELECT v, lead(v) OVER (ORDER BY v) AS nv, sum(a) OVER (ORDER BY v) / (SELECT sum(a) FROM g) AS fa, sum(b) OVER (ORDER BY v) / (SELECT sum(b) FROM g) AS fb FROM g) "
        f"SELECT '{c}' AS variable, round(max(abs(fa - fb)), 6) AS ks, round(sum(abs(fa - fb) * (nv - v)) / greatest((SELECT stddev_pop(v) FROM s WHERE early), 0.001), 6) AS wasserstein FROM c"
    )


@query("q17_drift_distances", " UNION ALL ".join(f"SELECT * FROM ({_distance_sql(c)})" for c in ("amount", "client")))
def q17(t: Tables):
    return rounded(D.numeric_distances(*sides(t), ["amount", "client"]))


def _share_sql(c: str, levels: str) -> str:
    p, q, m = "greatest(p, 0.0001)", "greatest(q, 0.0001)", "((p + q) / 2)"
    return (
        f"SELECT '{c}' AS variable, round(sum(({q} - {p}) * ln({q} / {p})), 6) + 0.0 AS psi, "
        f"round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / {m}) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / {m}) ELSE 0 END) / 2, 0)), 6) AS jensen_shannon "
        f"FROM (SELECT level, count(*) FILTER (WHERE early) / (SELECT count(*) FROM ({DRIFT_SQL}) WHERE early) AS p, "
        f"count(*) FILTER (WHERE NOT early) / (SELECT count(*) FROM ({DRIFT_SQL}) WHERE NOT early) AS q FROM (SELECT early, {levels} AS level FROM ({DRIFT_SQL})) GROUP BY 1)"
    )


def _deciles(c: str) -> str:
    cuts = ", ".join(f"{i / 10}" for i in range(1, 10))
    edges = f"SELECT DISTINCT unnest(quantile_cont({c}::DOUBLE, [{cuts}])) AS e FROM ({DRIFT_SQL}) WHERE early"
    return f"(SELECT count(*) FROM ({edges}) WHERE e < {c})"


@query("q17_drift_stability", " UNION ALL ".join(_share_sql(c, _deciles(c)) for c in ("amount", "client")))
def q17b(t: Tables):
    return rounded(D.numeric_stability(*sides(t), ["amount", "client"]))


def _chi_side(c: str) -> str:
    return (
        f"SELECT '{c}' AS variable, round(sum(pow(a - (a + b) * na / (na + nb), 2) / ((a + b) * na / (na + nb)) + pow(b - (a + b) * nb / (na + nb), 2) / ((a + b) * nb / (na + nb))), 6) AS chi2 "
        f"FROM (SELECT {c}, count(*) FILTER (WHERE early) AS a, count(*) FILTER (WHERE NOT early) AS b FROM ({DRIFT_SQL}) GROUP BY 1), "
        f"(SELECT count(*) FILTER (WHERE early) AS na, count(*) FILTER (WHERE NOT early) AS nb FROM ({DRIFT_SQL}))"
    )


CATEGORY_SQL = " UNION ALL ".join(
    f"SELECT x.variable, psi, jensen_shannon, chi2 FROM ({_share_sql(c, c)}) x JOIN ({_chi_side(c)}) y ON x.variable = y.variable" for c in ("priority", "status")
)


@query("q17_category_drift", CATEGORY_SQL)
def q17c(t: Tables):
    return rounded(D.category_drift(*sides(t), ["priority", "status"]))
