"""Tables that are small on disk and become wide are dealt over tasks by their rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import models as ML
from riskloom.operators import quantiles as Q
from riskloom.operators.aggregate import dealt_by_key, group_statistics, merge_client_tables
from riskloom.operators.explain import explain
from riskloom.operators.ordered import ewm_mean
from riskloom.queries.base import Tables
from riskloom.queries.loan_tables import APPLICATION_NUMBERS, LOAN_TABLES
from riskloom.session import dealt, task_count


def customers(spark, folder: str, n: int) -> Tables:
    rows = spark.range(0, n, 1, 1).select(F.col("id").alias("c_custkey"), F.lit("BUILDING").alias("c_mktsegment"), (F.col("id") % 900).cast("double").alias("c_acctbal"))
    rows.write.parquet(f"{folder}/customer.parquet")
    return Tables(spark, folder)


def test_tasks_follow_the_rows():
    assert [task_count(n, 12) for n in (0, 10, 10_000, 10_001, 90_000, 900_000, 5_400_000)] == [1, 1, 1, 2, 9, 48, 108]


def test_a_dealt_table_keeps_its_rows_and_their_copies(spark):
    rows = spark.range(0, 21_000, 1, 1).select(F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("k"))
    out = dealt(rows)
    assert out.rdd.getNumPartitions() > 1
    assert sorted(out.collect(), key=str) == sorted(rows.collect(), key=str)


def test_applications_and_their_vectors_are_not_one_task(spark, tmp_path):
    t = customers(spark, str(tmp_path), 20_000)
    application = t.sql(LOAN_TABLES["application"])
    vectors = ML.kept_vectors(application, APPLICATION_NUMBERS, ["SK_ID_CURR", "TARGET"], "TARGET")
    per_task = [n for n in vectors.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()]
    assert sum(per_task) == 20_000 and max(per_task) <= 10_000


def test_rows_of_a_fold_table_are_dealt_evenly(spark):
    rows = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("k"), (F.col("id") % 2).alias("y"), F.rand(1).alias("x"))
    vectors = ML.with_folds(rows, "k", ["x"], "y", 10, 0)
    per_task = vectors.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(per_task) == 60_000 and max(per_task) <= 25_000
    assert {r["count"] for r in vectors.groupBy("y", "fold").count().collect()} == {3_000}


def test_clients_are_dealt_by_the_rows_they_expand_to(spark):
    clients = spark.range(0, 64, 1, 1).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    seen = []

    def score(df):
        seen.append(df.rdd.getNumPartitions())
        return df.withColumn("probability", F.col("a") * 2 + F.col("b") * F.col("a"))

    why = explain(clients, "k", ["a", "b"], clients, score, draws=5_000)
    sums = why.groupBy("k").agg((F.sum("contribution") - F.max(F.col("score") - F.col("expected"))).alias("gap"), F.count("*").alias("n"))
    assert seen[0] > 1
    assert all(abs(r["gap"]) < 1e-9 and r["n"] == 2 for r in sums.collect())
    assert sums.count() == 64


def test_months_are_dealt_by_their_number_for_wide_aggregates(spark):
    rows = spark.range(0, 600_000, 1, 4).select((F.col("id") % 90_000).alias("k"), F.floor(F.col("id") / 90_000).alias("m"), F.col("id").cast("double").alias("x"))
    out = ewm_mean(rows, ["x"], ["k"], ["m"], 0.5, by_key=True)
    per_task = out.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(per_task) == 12 and sum(per_task) == 600_000
    small = ewm_mean(rows.filter("k < 50"), ["x"], ["k"], ["m"], 0.5)
    both = out.join(small, ["k", "m"]).filter(out["EXP_x"] == small["EXP_x"])
    assert both.count() == small.count() > 0


def test_sampled_columns_are_not_one_task(spark):
    rows = spark.range(0, 5_000, 1, 4).selectExpr(*[f"cast((id * {i + 3}) % 997 as double) AS c{i}" for i in range(60)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    try:
        columns = Q._by_column(Q._sampled(rows, 1.0, 60), 60).rdd.mapPartitions(lambda part: [len({r["c"] for r in part})]).collect()
        medians = Q.exact_quantiles(rows, rows.columns, [0.5], sample_rows=500)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    assert sum(columns) == 60 and max(columns) <= 15
    assert medians == {c: [m] for c, m in rows.toPandas().median().items()}


def test_rows_pass_joins_as_one_column(spark):
    rows = spark.createDataFrame([(1, "a", "x", 2.0), (2, None, "y", None), (2, "b", "x", 4.0), (None, "a", "x", 6.0)], "id int, g string, h string, v double")
    fit = rows.filter("g = 'a'")
    (out,) = group_statistics(fit, [rows], [["g"], ["h", "g"]], {"v": "mean max"})
    made = [f"V_{s}_AGG_{k}" for k in ("g", "h_g") for s in ("MEAN", "MAX")]
    assert out.columns == ["h", "g", "id", "v", *made]
    got = {(r["id"], r["v"]): [r[c] for c in made] for r in out.collect()}
    assert got == {(1, 2.0): [4.0, 6.0] * 2, (None, 6.0): [4.0, 6.0] * 2, (2, None): [None] * 4, (2, 4.0): [None] * 4}
    merged = merge_client_tables(rows, {"t": spark.createDataFrame([(1, 7.0, 8), (None, 1.0, 1)], "id int, v double, w int"), "empty": rows.select("id").filter("id = 1")}, "id")
    assert merged.columns == ["id", "g", "h", "v", "t_v", "w"]
    assert sorted(((r["id"], r["v"], r["t_v"], r["w"]) for r in merged.collect()), key=str) == sorted([(1, 2.0, 7.0, 8), (2, None, None, None), (2, 4.0, None, None), (None, 6.0, None, None)], key=str)
    assert all("__row" in df._jdf.queryExecution().executedPlan().toString() for df in (out, merged))


def test_rows_are_dealt_by_key_before_wide_aggregates(spark):
    rows = spark.range(0, 60_000, 1, 2).selectExpr("nullif(id % 6000, 0) AS k", "id AS x")
    out = dealt_by_key(rows, ["k"], rows)
    clients = out.rdd.mapPartitions(lambda part: [{r["k"] for r in part}]).collect()
    assert len(clients) == 6 and sum(map(len, clients)) == len(set.union(*clients)) == 5_999
    assert out.count() == rows.filter("k is not null").count()
    # a key of many rows is left to partial aggregates, a table of one task's rows as it is
    assert dealt_by_key(rows, ["k"], rows, hot_rows=9) is rows and dealt_by_key(rows.limit(0), ["k"], rows.limit(0)).count() == 0


def test_loans_with_known_terms_are_dealt_by_their_number(spark, monkeypatch):
    seen = []

    class Fitted:
        def transform(self, df):
            return df.withColumn("prediction", F.lit(1.0))

    monkeypatch.setattr(ML, "fit", lambda rows, *_: seen.append(rows) or Fitted())
    loans = spark.range(0, 60_000, 1, 1).selectExpr("cast(id as double) AS AMT_CREDIT", "cast(id % 9 as double) AS AMT_ANNUITY", "cast(id % 60 as double) AS CNT_PAYMENT")
    (out,) = ML.expected_terms(loans, [loans])
    per_task = seen[0].rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(per_task) == out.count() == 60_000 and max(per_task) <= 25_000
