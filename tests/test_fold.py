"""Wide statistics folded over sorted rows equal the same statistics as SQL aggregates."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import aggregate as A
from riskloom.operators import models as ML
from riskloom.operators.correlate import correlated_columns
from riskloom.operators.impute import fill, fit_medians
from riskloom.operators.moments import column_moments, kept_numbers
from riskloom.plans import client_table as PC
from riskloom.plans import snapshots as SN
from riskloom.queries import plans as QP

NAN = float("nan")
STATS = "mean sum max min count first last"


def rows(spark):
    data = [
        ("a", 1, 1.5, 3, 2.0, True), ("a", 2, None, None, NAN, True), ("a", None, 4.0, 7, 1.0, None), ("b", 1, None, None, NAN, False),
        ("b", 2, None, None, NAN, True), ("c", 5, -0.5, -(2**62), None, None), (None, 1, 9.0, 9, 9.0, True),
    ]
    data += [("long", i, None if i % 7 == 0 else i / 4, None if i % 5 == 0 else i * i - 300_000, i % 11 / 2, i % 3 == 0) for i in range(1_000)]
    return spark.createDataFrame(data, "k string, o int, x double, i long, f float, w boolean").repartition(5)


def plain(table):
    return {r["k"]: [None if v is None else "nan" if isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v for v in r] for r in table.collect()}


@pytest.mark.parametrize("batch", [10_000, 16])
def test_folded_statistics_equal_sql(spark, batch):
    df, spec = rows(spark), {"x": STATS, "i": STATS, "f": STATS}
    parts = [A.Part(spec), A.Part(spec, "_W", F.col("w")), A.Part(spec, "_NONE", F.col("o") > 5_000)]
    means = {"share": F.when(F.col("w"), 1.0).otherwise(0.0)}
    sql = A.aggregate_parts(df, ["k"], parts, ["o"], means)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        folded = A.aggregate_parts(df, ["k"], parts, ["o"], means, A.key_counts(df, ["k"]))
        assert "MapInArrow" in folded._jdf.queryExecution().executedPlan().toString()
        assert [(f.name, f.dataType) for f in folded.schema] == [(f.name, f.dataType) for f in sql.schema]
        assert plain(folded) == plain(sql)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("batch", [10_000, 1])
def test_zeros_keep_their_sign_as_in_sql(spark, batch):
    df = spark.createDataFrame([(1, 1, -0.0), (2, 1, 0.0), (2, 2, -0.0), (3, 1, -0.0), (3, 2, 0.0), (4, 1, -0.0), (4, 2, -1.0)], "k int, o int, x double").coalesce(1)
    parts = [A.Part({"x": "mean sum max min last"})]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        folded = A.aggregate_parts(df, ["k"], parts, ["o"], seen=A.KeyCounts(7, 2)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(str, folded)) == sorted(map(str, A.aggregate_parts(df, ["k"], parts, ["o"]).collect()))


def test_hot_keys_and_other_kinds_stay_sql(spark):
    df = rows(spark)
    seen = A.key_counts(df, ["k"])
    assert (seen.rows, seen.most) == (1_006, 1_000)
    for spec, hot in (({"x": "sum"}, 999), ({"w": "max"}, 1_000)):
        out = A.aggregate_parts(df, ["k"], [A.Part(spec)], seen=seen, hot_rows=hot)
        assert "MapInArrow" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 4
    none = A.aggregate_parts(df.limit(0), ["k"], [A.Part({"x": "sum"})], seen=A.key_counts(df.limit(0), ["k"]))
    assert none.columns == ["k", "X_SUM"] and none.count() == 0


def test_a_folded_sum_beyond_a_long_is_an_error(spark):
    df = spark.createDataFrame([(1, 2**62), (1, 2**62)], "k int, i long")
    with pytest.raises(Exception, match="range of a long"):
        A.aggregate_parts(df, ["k"], [A.Part({"i": "sum"})], seen=A.KeyCounts(2, 2)).collect()


def test_months_become_clients_without_wide_sql_aggregates(spark):
    """Hundreds of aggregates in SQL are code too long to be compiled."""
    months = spark.range(400).selectExpr(
        "id % 40 AS SK_ID_PREV", "id % 20 AS SK_ID_CURR", "cast(-floor(id / 40) as int) AS MONTHS_BALANCE", "cast(id as double) AS CNT_INSTALMENT",
        "cast(id % 7 as double) AS CNT_INSTALMENT_FUTURE", "id % 3 AS SK_DPD", "id % 2 AS SK_DPD_DEF", "if(id % 3 = 0, 'Active', 'Signed') AS NAME_CONTRACT_STATUS",
    )
    plan = SN.build_cash(months)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [" not in plan and plan.count("MapInArrow") == 3


def test_feature_tables_are_built_side_by_side(monkeypatch):
    """The client table's applications and feature tables wait for each other only where they meet."""
    calls = []
    monkeypatch.setattr(ML, "concurrently", lambda like, steps, workers=4: calls.append((len(steps), workers)) or [(None, None)] + [None] * (len(steps) - 1))
    monkeypatch.setattr(QP.PC, "finish_clients", lambda *_: (None, None, []))
    t = type("T", (), {"spark": type("S", (), {"sparkContext": type("C", (), {"applicationId": "none"})})(), "folder": "none", "customer": None})()
    QP.client_tables(t)
    assert calls[0] == (6, 6)


def test_kept_numbers_give_the_same_decisions(spark):
    """One kept array column serves medians, moments and correlations as the columns themselves do, before and after they are filled."""
    data = [(i, None if i % 3 == 0 else float(i % 17), NAN if i % 50 == 0 else i / 8, i % 5, None, 2.0 * (i % 17)) for i in range(400)]
    df = spark.createDataFrame(data, "id int, a double, b double, c int, d double, e double")
    df = df.selectExpr("id", "a", "b", "c", "d", "e", *[f"cast((id * {n}) % 31 as double) AS n{n}" for n in range(3, 24)])
    cs = df.columns[1:]
    numbers = kept_numbers(df, cs)
    assert len(numbers.table.columns) == 1
    medians = fit_medians(df, cs)
    assert fit_medians(df, cs, numbers) == medians and "d" not in medians
    filled = fill(df, medians)
    for table, kept in ((df, numbers), (filled, numbers.filled(medians))):
        of = [[(m.present, m.low, m.high, m.mean and round(m.mean, 9)) for m in column_moments(table, cs, k).values()] for k in (kept, None)]
        assert of[0] == of[1]
        assert correlated_columns(table, 0.7, ["id"], kept) == correlated_columns(table, 0.7, ["id"])
    # the filled NaN stays one; a column that has no value stays empty and is the sparse one
    assert column_moments(filled, ["b"])["b"].present == column_moments(filled, cs, numbers.filled(medians))["b"].present < 400
    train, _, gone = PC.finish_clients(df, df, ["id"])
    assert "d" in gone and "a" not in gone and "e" not in train.columns
