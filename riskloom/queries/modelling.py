"""Queries for neighbours, models, attributions and evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.functions.columns import DENIED
from riskloom.operators import metrics as M
from riskloom.operators import models as ML
from riskloom.operators.explain import explain
from riskloom.operators.neighbours import knn_target_mean
from riskloom.operators.sampling import stratified_sample
from riskloom.plans.application import NEIGHBOUR_FEATURES, add_application_features, clean_application
from riskloom.queries.base import Tables, query, rounded
from riskloom.queries.loan_tables import APPLICATION_NUMBERS, LOAN_TABLES, oracle_text
from riskloom.queries.quality import TEST, TRAIN

# -- neighbours ----------------------------------------------------------------------------------

K = 500
POINTS = (
    "SELECT SK_ID_CURR AS id, TARGET, SEGMENT, coalesce(EXT_SOURCE_1, 0) AS f0, coalesce(EXT_SOURCE_2, 0) AS f1, coalesce(EXT_SOURCE_3, 0) AS f2, "
    f"coalesce(AMT_CREDIT / (AMT_ANNUITY + 0.00001), 0) AS f3 FROM ({oracle_text('application')})"
)
GAP = " + ".join(f"(q.f{i} - p.f{i}) * (q.f{i} - p.f{i})" for i in range(4))


def _knn_sql(queries: str, other: str) -> str:
    return (
        f"WITH s AS ({POINTS}) SELECT id AS SK_ID_CURR, round(avg(TARGET), 6) AS neighbours FROM (SELECT q.id, p.TARGET, "
        f"row_number() OVER (PARTITION BY q.id ORDER BY {GAP}, p.id) AS rn FROM (SELECT * FROM s WHERE {queries}) q, "
        f"(SELECT * FROM s WHERE {TRAIN}) p WHERE {other}) WHERE rn <= {K} GROUP BY 1"
    )


def neighbour_rows(t: Tables):
    return add_application_features(clean_application(t.sql(LOAN_TABLES["application"]))).select(
        "SK_ID_CURR", "TARGET", "SEGMENT", *NEIGHBOUR_FEATURES
    )


@query("k1_knn_target_mean", _knn_sql(TEST, "true"))
def k1(t: Tables):
    df = neighbour_rows(t)
    out = knn_target_mean(df.filter(TRAIN), df.filter(TEST), "SK_ID_CURR", NEIGHBOUR_FEATURES, "TARGET", K, False, "neighbours")
    return rounded(out.select("SK_ID_CURR", "neighbours"))


@query("k1_knn_target_mean_without_self", _knn_sql(TRAIN, "p.id <> q.id"))
def k1b(t: Tables):
    df = neighbour_rows(t).filter(TRAIN)
    out = knn_target_mean(df, df, "SK_ID_CURR", NEIGHBOUR_FEATURES, "TARGET", K, True, "neighbours")
    return rounded(out.select("SK_ID_CURR", "neighbours"))


# -- models --------------------------------------------------------------------------------------

FEATURES = APPLICATION_NUMBERS
# attributions are made for models on selected features
FEW = ["AMT_CREDIT", "AMT_ANNUITY", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "DAYS_BIRTH"]


def application(t: Tables):
    return clean_application(t.sql(LOAN_TABLES["application"]))


def model(t: Tables, features=FEATURES):
    rows = ML.balanced(application(t).filter(TRAIN), "TARGET")
    return ML.fit_classifier(rows, features, "TARGET", ML.boosted_classifier("TARGET"))


@query("k2_chained_model_impute")
def k2(t: Tables):
    df = application(t)
    train, test = ML.chained_model_impute(
        df.filter(TRAIN), [df.filter(TEST)], ["EXT_SOURCE_2", "EXT_SOURCE_3", "EXT_SOURCE_1"], exclude=["SK_ID_CURR", "TARGET"]
    )
    return train.unionByName(test)


@query("k3_expected_terms")
def k3(t: Tables):
    (out,) = ML.expected_terms(t.sql(LOAN_TABLES["previous"]), [application(t)])
    return out.select("SK_ID_CURR", "EXPECTED_CNT_PAYMENT")


@query(
    "k3_terms_within_the_known_ones",
    f"SELECT SK_ID_CURR, true AS sound FROM ({oracle_text('application')})",
)
def k3b(t: Tables):
    """One expected term per application, no further outside the known terms than half their range."""
    known = t.sql(LOAN_TABLES["previous"]).select("AMT_CREDIT", "AMT_ANNUITY", "CNT_PAYMENT").dropna()
    ends = known.agg(F.min("CNT_PAYMENT").alias("low"), F.max("CNT_PAYMENT").alias("high"))
    slack = (F.col("high") - F.col("low")) / 2
    return k3(t).join(F.broadcast(ends)).select("SK_ID_CURR", F.col("EXPECTED_CNT_PAYMENT").between(F.col("low") - slack, F.col("high") + slack).alias("sound"))


@query("k4_importance_boosted")
def k4(t: Tables):
    return ML.importance_boosted(application(t), "SK_ID_CURR", FEATURES, "TARGET")


@query("k4_boosted_add_up", f"SELECT unnest({FEATURES}) AS feature, 1.0::DOUBLE AS total, true AS sound")
def k4d(t: Tables):
    """One boosted importance per feature, none negative; they add up to one."""
    out = k4(t)
    total = out.agg(F.sum("importance").alias("total"))  # one row
    return rounded(out.join(F.broadcast(total)).select("feature", "total", (F.col("importance") >= 0).alias("sound")))


@query("k4_importance_forest")
def k4b(t: Tables):
    return ML.importance_forest(application(t), "SK_ID_CURR", FEATURES, "TARGET")


@query("k5_score")
def k5(t: Tables):
    return ML.score(application(t).select("SK_ID_CURR", *FEATURES), model(t), FEATURES)


@query("k6_explain")
def k6(t: Tables):
    fitted = model(t, FEW)
    clients = application(t).filter(TEST)
    background = stratified_sample(application(t).filter(TRAIN), "TARGET", "SK_ID_CURR", 100, 84)
    return explain(clients, "SK_ID_CURR", FEW, background, lambda df: ML.probability(df, fitted, FEW), draws=200)


@query("k6_contributions_add_up", f"SELECT SK_ID_CURR, 0.0::DOUBLE AS gap FROM ({oracle_text('application')}) WHERE {TEST}")
def k6b(t: Tables):
    """The contributions of a client add up to its score less the background's mean score."""
    return rounded(k6(t).groupBy("SK_ID_CURR").agg((F.sum("contribution") - F.max(F.col("score") - F.col("expected"))).alias("gap")), 6)


@query("k4_importances_add_up", f"SELECT unnest({FEATURES}) AS feature, 1.0::DOUBLE AS total")
def k4c(t: Tables):
    """One importance per feature; they add up to one."""
    out = k4b(t)
    return rounded(out.crossJoin(F.broadcast(out.agg(F.sum("importance").alias("total")))).select("feature", "total"))


@query(
    "k2_given_values_stay",
    f"SELECT SK_ID_CURR, round(EXT_SOURCE_1, 6) AS EXT_SOURCE_1, round(EXT_SOURCE_2, 6) AS EXT_SOURCE_2, round(EXT_SOURCE_3, 6) AS EXT_SOURCE_3, 0 AS gaps FROM ({oracle_text('application')})",
)
def k2b(t: Tables):
    """Given values are as they were, and no gap is left."""
    filled, names = k2(t), ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
    given = application(t).select("SK_ID_CURR", *[F.col(c).alias(f"had_{c}") for c in names])
    both = filled.select("SK_ID_CURR", *names).join(given, "SK_ID_CURR")
    gaps = sum((F.col(c).isNull().cast("int") for c in names), F.lit(0))
    return rounded(both.select("SK_ID_CURR", *[F.when(F.col(f"had_{c}").isNotNull(), F.col(c)).alias(c) for c in names], gaps.alias("gaps")))


@query("k5_decisions_follow_scores", f"SELECT SK_ID_CURR, true AS sound FROM ({oracle_text('application')})")
def k5b(t: Tables):
    """Scores are in range, and percent score and decision follow from the probability."""
    p = F.col("proba")
    sound = p.between(0, 1) & (F.abs(F.col("credit_score") - 100 * p) <= 1) & ((F.col("prediction") == DENIED) == (F.col("credit_score") >= 50))
    return k5(t).select("SK_ID_CURR", sound.alias("sound"))


# -- evaluation: order status as the truth, a price fraction as the score ------------------------

SCORED = "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, floor(o_totalprice / 500) / 1024 AS p FROM {orders}"
SCORED_SQL = SCORED.format(orders="orders")


def _counts(threshold: str, source: str = SCORED_SQL) -> str:
    return (
        f"SELECT count(*) FILTER (WHERE y = 0 AND p <= {threshold}) AS tn, count(*) FILTER (WHERE y = 0 AND p > {threshold}) AS fp, "
        f"count(*) FILTER (WHERE y = 1 AND p <= {threshold}) AS fn, count(*) FILTER (WHERE y = 1 AND p > {threshold}) AS tp FROM ({source})"
    )


GAIN = "((tn - fp - 10 * fn + tp) - (-(tn + fp) - 10 * (fn + tp))) / ((tn + fp + fn + tp) - (-(tn + fp) - 10 * (fn + tp)))"


def f_sql(b: int) -> str:
    return f"(1 + {b * b}) * tp / ((1 + {b * b}) * tp + {b * b} * fn + fp)"


@query("t1_confusion", _counts("0.3"))
def t1(t: Tables):
    return M.confusion(t.sql(SCORED), "y", "p", 0.3)


@query("t2_business_score", f"SELECT *, round({GAIN}, 6) AS score FROM ({_counts('0.3')})")
def t2(t: Tables):
    return rounded(M.confusion(t.sql(SCORED), "y", "p", 0.3).withColumn("score", M.business_score()))


SWEEP = (
    f"SELECT threshold, tn, fp, fn, tp, {GAIN} AS gain FROM (SELECT i / 100 AS threshold, count(*) FILTER (WHERE y = 0 AND p <= i / 100) AS tn, "
    "count(*) FILTER (WHERE y = 0 AND p > i / 100) AS fp, count(*) FILTER (WHERE y = 1 AND p <= i / 100) AS fn, "
    f"count(*) FILTER (WHERE y = 1 AND p > i / 100) AS tp FROM ({SCORED_SQL}), range(100) r(i) GROUP BY i)"
)


@query("t3_threshold_sweep", f"SELECT * REPLACE (round(gain, 6) AS gain) FROM ({SWEEP})")
def t3(t: Tables):
    return rounded(M.threshold_sweep(t.sql(SCORED), "y", "p"))


@query("t3_best_threshold", f"SELECT threshold, round(gain, 6) AS gain FROM ({SWEEP}) q ORDER BY q.gain DESC, q.threshold LIMIT 1")
def t3b(t: Tables):
    return rounded(M.best_threshold(M.threshold_sweep(t.sql(SCORED), "y", "p")))


RATES = "round(tp / (tp + fn), 6) AS recall, round(tp / (tp + fp), 6) AS precision, " + ", ".join(
    f"round({f_sql(b)}, 6) AS f{b}_score" for b in (1, 2, 5, 10)
)


@query("t4_precision_recall_f", f"SELECT tn, fp, fn, tp, {RATES}, round({GAIN}, 6) AS business_score FROM ({_counts('0.3')})")
def t4(t: Tables):
    return rounded(ML.threshold_report(t.sql(SCORED), "y", "p", 0.3))


RANKING = (
    "SELECT (sum(CASE WHEN y = 1 THEN r END) - np * (np + 1) / 2) / (np * nn) AS roc_auc FROM (SELECT y, rank() OVER (ORDER BY p) "
    "+ (count(*) OVER (PARTITION BY p) - 1) / 2 AS r, sum(y) OVER () AS np, sum(1 - y) OVER () AS nn "
    f"FROM ({SCORED_SQL})) GROUP BY np, nn"
)
PRECISION = (
    "SELECT sum(pos * tp / (tp + fp)) / max(total) AS average_precision FROM (SELECT pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS total "
    f"FROM (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM ({SCORED_SQL}) GROUP BY p) WINDOW w AS (ORDER BY p DESC))"
)


@query("t5_roc_auc", f"SELECT round(roc_auc, 6) AS roc_auc FROM ({RANKING})")
def t5(t: Tables):
    return rounded(M.ranking_metrics(t.sql(SCORED), "y", "p").select("roc_auc"))


@query("t6_average_precision", f"SELECT round(average_precision, 6) AS average_precision FROM ({PRECISION})")
def t6(t: Tables):
    return rounded(M.ranking_metrics(t.sql(SCORED), "y", "p").select("average_precision"))


@query("t7_cross_validate")
def t7(t: Tables):
    return ML.cross_validate(application(t), "SK_ID_CURR", FEATURES, "TARGET", lambda: ML.forest_classifier("TARGET"))


@query("t7_measures_in_range", "SELECT unnest(['test', 'train']) AS part, true AS sound")
def t7b(t: Tables):
    """One row per side; means lie in 0 to 1, deviations in 0 to 1/2, and the forest knows its own training rows better."""
    out = t7(t)
    names = ("roc_auc", "recall", "precision")
    sound = reduce(lambda x, y: x & y, [F.col(f"{m}_mean").between(0, 1) & F.col(f"{m}_std").between(0, 0.5) for m in names])
    best = F.max("roc_auc_mean").over(Window.partitionBy(F.lit(0)))  # two rows
    return out.select("part", (sound & ((F.col("part") == "test") | (F.col("roc_auc_mean") == best))).alias("sound"))


@query(
    "t7_folds_hold_all_classes",
    "SELECT f.fold::INT AS fold, TARGET::INT AS TARGET, (total // 10 + CASE WHEN f.fold < total % 10 THEN 1 ELSE 0 END)::BIGINT AS n FROM range(10) f(fold), "
    f"(SELECT TARGET, count(*) AS total FROM ({oracle_text('application')}) WHERE TARGET IS NOT NULL GROUP BY 1)",
)
def t7c(t: Tables):
    """Rows of each class in each of the ten folds of the kept vectors."""
    spread = ML.with_folds(application(t), "SK_ID_CURR", FEATURES, "TARGET", 10, 0)
    return spread.groupBy("fold", F.col("TARGET").cast("int").alias("TARGET")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "t8_evaluate_at_threshold",
    f"SELECT tn, fp, fn, tp, {RATES}, round({GAIN}, 6) AS business_score, (SELECT round(roc_auc, 6) FROM ({RANKING})) AS roc_auc, "
    f"(SELECT round(average_precision, 6) FROM ({PRECISION})) AS average_precision, 'price fraction' AS experiment FROM ({_counts('0.3')})",
)
def t8(t: Tables):
    return rounded(M.evaluate_at_threshold(t.sql(SCORED), "y", "p", 0.3, "price fraction"))


@query("t8_experiment_row")
def t8b(t: Tables):
    df = application(t)
    return ML.evaluate_experiment(
        df.filter(TRAIN), df.filter(TEST), "SK_ID_CURR", FEATURES, "TARGET",
        lambda: ML.forest_classifier("TARGET"), 0.5, "forest",
    )


@query(
    "t8_experiment_counts",
    f"SELECT count(*) FILTER (WHERE TARGET = 1) AS positives, count(*) FILTER (WHERE TARGET = 0) AS negatives, true AS sound FROM ({oracle_text('application')}) WHERE {TEST}",
)
def t8c(t: Tables):
    """The counts of an experiment add up to the validation rows, and its rates follow from its counts."""
    out = t8b(t)
    sound = [F.abs(F.coalesce(rate, F.lit(0.0)) * (F.col("tp") + F.col(other)) - F.col("tp")) < 1e-6 for rate, other in (("recall", "fn"), ("precision", "fp"))]
    return out.select((F.col("tp") + F.col("fn")).alias("positives"), (F.col("tn") + F.col("fp")).alias("negatives"), (sound[0] & sound[1] & F.col("roc_auc").between(0, 1)).alias("sound"))


@query("t9_grid_search")
def t9(t: Tables):
    return ML.grid_search(application(t), "SK_ID_CURR", FEATURES, "TARGET", ML.forest_classifier, {"trees": [50, 100], "depth": [3, 5]}, folds=5)


@query("t9_one_row_per_combination", "SELECT '{''trees'': ' || trees || ', ''depth'': ' || depth || '}' AS params, true AS sound FROM (VALUES (50), (100)) t(trees), (VALUES (3), (5)) d(depth)")
def t9b(t: Tables):
    return t9(t).select("params", F.col("roc_auc").between(0, 1).alias("sound"))
