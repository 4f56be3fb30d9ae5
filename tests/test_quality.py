import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators import correlate as K
from riskloom.operators import encode as E
from riskloom.operators import impute as I
from riskloom.operators import metrics as M
from riskloom.operators import models as ML
from riskloom.operators import profile as P
from riskloom.operators.explain import explain
from riskloom.operators import neighbours as N
from riskloom.operators.neighbours import knn_target_mean
from riskloom.sources import tables as S


def test_correlated_multiples_are_dropped(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({f"col{i}": rng.integers(1, 1500, 200) for i in range(1, 11)})
    wide = pdf.assign(col12=3 * pdf.col10, col13=4 * pdf.col10, col14=5 * pdf.col10, col15=6 * pdf.col10)
    kept, gone = K.drop_correlated(spark.createDataFrame(wide), 0.7)
    assert gone == ["col12", "col13", "col14", "col15"] and kept.columns == list(pdf.columns)
    assert K.drop_correlated(spark.createDataFrame(wide), 0.7, protect=["col12"])[1] == ["col13", "col14", "col15"]


@pytest.mark.parametrize("narrow", [3, 100])
def test_pairwise_correlation_with_gaps(spark, narrow):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(400, 6)) + 1e6, columns=list("abcdef"))
    pdf.loc[rng.random(400) < 0.3, "b"] = np.nan
    pdf["f"] = 5.0
    got = K.correlation_matrix(C.nan_to_null(spark.createDataFrame(pdf)), list("abcdef"), narrow).collect()
    want = pdf.corr()
    for r in got:
        if "f" in (r["a"], r["b"]):
            assert r["r"] is None or np.isnan(r["r"])
        else:
            assert r["r"] == pytest.approx(want.loc[r["a"], r["b"]], abs=1e-9)


def test_correlation_of_1500_columns(spark, tmp_path):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 1500)) + 1e5
    x[:, 700:705] = 3 * x[:, :5]
    x[rng.random(x.shape) < 0.02] = np.nan
    x[:, 9] = 1.0
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(1500)])
    C.nan_to_null(spark.createDataFrame(pdf)).repartition(3).write.parquet(f"{tmp_path}/wide")
    df = spark.read.parquet(f"{tmp_path}/wide")
    assert K.correlated_columns(df, 0.9) == [f"c{i}" for i in range(700, 705)]
    got = K.correlation_matrix(df, list(pdf.columns))
    assert got.count() == 1500 * 1499 // 2
    some = got.filter("a IN ('c0', 'c140', 'c9') AND b IN ('c700', 'c1499', 'c141')").collect()
    assert len(some) == 9
    for r in some:
        if r["a"] == "c9":
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(pdf[r["a"]].corr(pdf[r["b"]]), abs=1e-9)


def test_phi_k_of_a_binned_normal_recovers_its_correlation(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=20_000)
    y = 0.6 * x + 0.8 * rng.normal(size=20_000)
    pdf = pd.DataFrame({"x": np.digitize(x, [-1, -0.3, 0.3, 1]), "y": np.digitize(y, [-1, 0, 1]), "z": rng.integers(0, 4, 20_000)})
    got = {(r["a"], r["b"]): r["phi_k"] for r in K.phi_k(spark.createDataFrame(pdf), [("x", "y"), ("x", "z"), ("x", "x")]).collect()}
    assert got["x", "y"] == pytest.approx(0.6, abs=0.04)
    assert got["x", "z"] < 0.05 and got["x", "x"] == 1.0


def test_first_seen_codes(spark):
    rows = [(3, "b"), (1, "a"), (2, None), (4, "a"), (5, "c")]
    out = E.label_encode_first_seen(spark.createDataFrame(rows, "o int, c string"), ["c"], ["o"]).orderBy("o").collect()
    assert [r["c"] for r in out] == [1, 2, 3, 1, 4]


def test_first_seen_codes_over_range_partitions(spark):
    df = spark.range(500).selectExpr("id AS o", "cast((id * 37) % 211 as string) AS a", "cast(id % 7 as string) AS b")
    few = E.first_seen_codes(df, ["a", "b"], ["o"])
    many = E.first_seen_codes(df, ["a", "b"], ["o"], window_levels=10)
    assert sorted(few.collect()) == sorted(many.collect()) and many.count() == 218


def test_response_shares(spark, monkeypatch):
    fit = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), (None, 1)], "c string, y int")
    new = spark.createDataFrame([("a",), ("b",), ("x",), (None,)], "c string")
    for limit in (200, 0):
        monkeypatch.setattr(E, "MAX_LITERAL_LEVELS", limit)
        (out,) = E.response_encode(fit, [new.withColumn("k", F.col("c"))], ["c"], "y")
        got = {r["k"]: (r["c_0"], r["c_1"]) for r in out.collect()}
        assert got == {"a": (0.5, 0.5), "b": (1.0, 0.0), "x": (None, None), None: (None, None)}


def test_modes_and_medians(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 4), ("a", None), (None, 9)], "c string, x int")
    assert I.fit_modes(df) == {"c": "a"}
    assert I.fit_medians(df) == {"x": 3.0}
    (out,) = I.impute(df, df)
    assert out.filter("c IS NULL OR x IS NULL").count() == 0
    assert I.fill(df, {"c": "it's \\ here"}).filter(F.col("c") == "it's \\ here").count() == 1


def test_scaling_with_constant_and_missing(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    out = E.standard_scale(df, E.fit_standard(df, ["a", "b"])).collect()
    assert [tuple(r) for r in out] == [(-1.0, 0.0), (1.0, 0.0), (0.0, 0.0)]


def test_scalar_rules(spark):
    df = spark.createDataFrame([(1.0, -1e-5), (None, 2.0), (-13.0, 0.0)], "a double, b double")
    got = df.select(
        C.safe_ratio("a", "b").alias("r"), C.plain_ratio("a", "b").alias("p"), C.floor_div("a", 12).alias("f"),
        C.row_sum(["a", "b"]).alias("s"), C.row_max(["a", "b"]).alias("m"), C.zero_flag("a").alias("z"),
        C.recode("a", {1.0: "one", None: "none"}).alias("c"), C.nullify_where("b", F.col("a") > 0).alias("n"),
    ).collect()
    assert got[0]["r"] is None and got[2]["p"] is None and got[2]["f"] == -2
    assert got[1]["s"] is None and got[1]["m"] is None and got[1]["z"] == 1
    assert [r["c"] for r in got] == ["one", "none", None]
    assert [r["n"] for r in got] == [None, 2.0, 0.0]


def test_bands_have_no_gaps(spark):
    df = spark.createDataFrame([(0.0,), (25.0,), (49.495,), (49.5,), (50.505,), (75.0,), (100.0,)], "s double")
    got = [r[0] for r in df.select(C.band("s")).collect()]
    assert got == ["green", "limegreen", "limegreen", "red", "orange", "crimson", "crimson"]


def test_ranking_metrics_with_ties_and_buckets(spark):
    rng = np.random.default_rng(2)
    p = rng.integers(0, 40, 1500) / 40
    y = (rng.random(1500) < p).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"p": p, "y": y}))
    wins = (p[y == 1][:, None] > p[y == 0][None, :]).mean() + 0.5 * (p[y == 1][:, None] == p[y == 0][None, :]).mean()
    for rows in (10**6, 100):
        assert M.ranking_metrics(df, "y", "p", rows_per_bucket=rows).first()["roc_auc"] == pytest.approx(wins)
    one_class = M.ranking_metrics(df.filter("y = 1"), "y", "p").first()
    assert one_class["roc_auc"] is None and one_class["average_precision"] == 1.0


def test_threshold_sweep_counts(spark):
    df = spark.createDataFrame([(0.0, 0), (0.29, 1), (0.57, 1), (0.999, 0), (1.0, 1)], "p double, y int")
    rows = {round(r["threshold"], 2): r for r in M.threshold_sweep(df, "y", "p").collect()}
    assert len(rows) == 100
    assert (rows[0.0]["tp"], rows[0.0]["fp"], rows[0.0]["tn"]) == (3, 1, 1)
    assert (rows[0.28]["tp"], rows[0.29]["tp"], rows[0.57]["tp"], rows[0.99]["fp"]) == (3, 2, 1, 1)


def test_narrow_types(spark):
    df = spark.createDataFrame([(126, 127, 40000, 1e39, 2.0), (0, 0, 0, 0.0, None)], "a int, b int, c long, d double, e double")
    assert S.narrow_plan(df) == {"a": "tinyint", "b": "smallint", "c": "int", "d": "double", "e": "float"}


def test_profile_of_odd_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "y"), (2, None, "x")], "a int, b double, c string")
    rows = {r["variable"]: r for r in P.table_profile(df).collect()}
    assert rows["a"]["repeated"] == 1 and rows["b"]["filled"] == 0 and rows["b"]["mean"] is None
    assert (rows["c"]["top"], rows["c"]["top_count"]) == ("x", 2)


@pytest.mark.parametrize(("cell_rows", "coarse", "chunk"), [(None, 4096, 50_000), (60, 4096, 50_000), (20, 3, 15)])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_neighbours_equal_brute_force_with_a_hot_point(spark, monkeypatch, cell_rows, coarse, chunk, exclude_self):
    monkeypatch.setattr(N, "COARSE_CELLS", coarse)
    monkeypatch.setattr(N, "CHUNK_ROWS", chunk)
    rng = np.random.default_rng(0)
    n, k = 600, 10
    pdf = pd.DataFrame(rng.integers(0, 12, (n, 3)).astype(float), columns=list("abc"))
    pdf.loc[: n // 3, list("abc")] = [1.0, 2.0, 3.0]
    pdf["id"], pdf["y"] = rng.permutation(n), rng.integers(0, 2, n)
    df = spark.createDataFrame(pdf)
    got = knn_target_mean(df, df, "id", list("abc"), "y", k, exclude_self, "m", cell_rows).toPandas().sort_values("id")
    pdf = pdf.sort_values("id")
    x, ids, y = pdf[list("abc")].to_numpy(), pdf.id.to_numpy(), pdf.y.to_numpy()
    for i, m in enumerate(got.m):
        order = np.lexsort((ids, ((x - x[i]) ** 2).sum(axis=1)))
        if exclude_self:
            order = order[ids[order] != ids[i]]
        assert m == pytest.approx(y[order[:k]].mean())


def test_attributions_add_up(spark):
    def linear(df):
        return df.withColumn("probability", 2 * F.col("a") - F.col("b") + 0.5)

    clients = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 0.0)], "k int, a double, b double")
    background = spark.createDataFrame([(0.0, 0.0), (2.0, 2.0)], "a double, b double")
    rows = explain(clients, "k", ["a", "b"], background, linear, draws=4).collect()
    got = {(r["k"], r["feature"]): r["contribution"] for r in rows}
    # a linear score has the exact attribution weight * (value - background mean)
    assert got[1, "a"] == pytest.approx(0.0) and got[1, "b"] == pytest.approx(-1.0)
    assert got[2, "a"] == pytest.approx(4.0) and got[2, "b"] == pytest.approx(1.0)
    for k in (1, 2):
        r = next(r for r in rows if r["k"] == k)
        assert got[k, "a"] + got[k, "b"] == pytest.approx(r["score"] - r["expected"])


def test_scoring_also_runs_on_a_stream(spark, tmp_path):
    df = spark.range(200).selectExpr("id", "cast(id % 10 as double) AS a", "cast(id % 10 > 4 as int) AS y")
    model = ML.fit_classifier(ML.balanced(df, "y"), ["a"], "y", ML.boosted_classifier("y", 2, 2))
    batch = ML.score(df, model, ["a"])
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = ML.score(stream, model, ["a"]).writeStream.format("memory").queryName("scored").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(spark.table("scored").collect()) == sorted(batch.collect())
