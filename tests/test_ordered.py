import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions.columns import nan_to_null
from riskloom.operators import ordered as O
from riskloom.operators import prefix as P
from riskloom.operators import quantiles as Q
from riskloom.operators.sampling import stratified_folds, stratified_sample, train_validation_split


@pytest.fixture(scope="module")
def history():
    rng = np.random.default_rng(0)
    n = 2000
    pdf = pd.DataFrame(
        {
            "k": rng.choice([1, 2, 3, 4, 5], n, p=[0.6, 0.1, 0.1, 0.1, 0.1]).astype(int),
            "o": rng.permutation(n),
            "x": rng.normal(size=n) * 100,
            "y": rng.normal(size=n),
        }
    )
    pdf.loc[rng.random(n) < 0.3, "x"] = np.nan
    # a missing run far longer than the weights reach, and a key without any value
    pdf.loc[(pdf.k == 1) & (pdf.o > 400) & (pdf.o < 1400), "y"] = np.nan
    pdf.loc[pdf.k == 5, "y"] = np.nan
    return pdf


def same(got, want):
    a, b = got.to_numpy(float), want.to_numpy(float)
    assert (np.isnan(a) == np.isnan(b)).all()
    assert np.nanmax(np.abs(a - b)) < 1e-9


@pytest.mark.parametrize("alpha", [0.8, 0.5, 0.05])
@pytest.mark.parametrize("hot_rows", [None, 500, 1])
def test_ewm_per_key(spark, history, alpha, hot_rows):
    want = history.sort_values(["k", "o"]).reset_index(drop=True)
    df = nan_to_null(spark.createDataFrame(history)).repartition(5)
    got = O.ewm_mean(df, ["x", "y"], ["k"], ["o"], alpha, hot_rows, "pos").toPandas().sort_values(["k", "o"])
    assert got.groupby("k").pos.is_monotonic_increasing.all() and not got.duplicated(["k", "pos"]).any()
    for c in ("x", "y"):
        same(got[f"EXP_{c}"], want.groupby("k")[c].transform(lambda v: v.ewm(alpha=alpha).mean()))


def test_ewm_global_and_row_order(spark, history):
    want = history.sort_values(["k", "o"])
    df = nan_to_null(spark.createDataFrame(history.sample(frac=1.0, random_state=3)))
    got = O.ewm_mean_global(df, {"e": "x"}, ["k", "o"], 0.5).toPandas().sort_values(["k", "o"])
    same(got["e"], want["x"].ewm(alpha=0.5).mean())


def test_ewm_worked_example(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, None), (1, 2, 3.0), (1, 3, None)], "k int, o int, x double")
    got = O.ewm_mean(df, ["x"], ["k"], ["o"], 0.5).orderBy("o").collect()
    assert [r["EXP_x"] for r in got] == pytest.approx([1.0, 1.0, 2.6, 2.6])


def test_ewm_needs_an_order(spark):
    with pytest.raises(ValueError):
        O.ewm_mean(spark.range(1), ["id"], ["id"], [], 0.5)


@pytest.mark.parametrize("sample_rows", [10_000, 50])
def test_exact_quantiles(spark, history, sample_rows):
    df = nan_to_null(spark.createDataFrame(history)).withColumn("same", F.lit(4.0)).withColumn(
        "hot", F.when(F.col("o") % 3 == 0, F.lit(7.0)).otherwise(F.col("x"))
    ).withColumn("none", F.lit(None).cast("double"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    got = Q.exact_quantiles(df, ["x", "y", "o", "same", "hot", "none"], probs, sample_rows)
    assert got["none"] == [None] * len(probs)
    pdf = df.toPandas()
    for c in ("x", "y", "o", "same", "hot"):
        assert got[c] == pytest.approx(list(np.nanpercentile(pdf[c].astype(float), [100 * p for p in probs])), abs=1e-9)
    assert Q.exact_quantiles(df.limit(0), ["x"], [0.5]) == {"x": [None]}


def test_a_rank_outside_its_bracket_is_found_again(spark, history, monkeypatch):
    monkeypatch.setattr(Q, "REACH", 0.01)
    df = spark.createDataFrame(history)
    want = np.percentile(history.o, [25, 50, 75])
    assert Q.exact_quantiles(df, ["o"], [0.25, 0.5, 0.75], 5)["o"] == pytest.approx(list(want))


def test_quantiles_of_1500_columns(spark, tmp_path):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(np.round(rng.normal(size=(600, 1500)) * 50), columns=[f"c{i}" for i in range(1500)])
    pdf = pdf.mask(rng.random(pdf.shape) < 0.1)
    pdf["c7"] = np.nan
    folder = f"{tmp_path}/wide"
    nan_to_null(spark.createDataFrame(pdf)).repartition(4).write.mode("overwrite").parquet(folder)
    df = spark.read.parquet(folder)
    for rows in (100, 100_000):
        got = Q.exact_quantiles(df, list(pdf.columns), [0.5], rows)
        assert got["c7"] == [None]
        assert all(got[c][0] == np.nanmedian(pdf[c]) for c in pdf.columns if c != "c7")


@pytest.mark.parametrize("rows_per_bucket", [10**6, 97])
def test_running_totals(spark, history, rows_per_bucket):
    df = spark.createDataFrame(history.assign(v=history.o // 3))
    got = P.running_totals(df, "v", {"n": F.lit(1)}, ["k"], rows_per_bucket, next_value=True).toPandas().sort_values(["k", "v"])
    want = history.assign(v=history.o // 3).groupby(["k", "v"]).size().reset_index(name="n")
    want["cum"] = want.groupby("k").n.cumsum()
    want["next"] = want.groupby("k").v.shift(-1)
    assert got.cum_n.tolist() == want.cum.tolist()
    assert got.next_value.fillna(-1).astype(int).tolist() == want.next.fillna(-1).astype(int).tolist()


def test_empirical_cdf(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 5.0), ("b", 3.0)], "g string, v double")
    rows = {(r["g"], r["v"]): (r["cdf_low"], r["cdf_high"]) for r in P.empirical_cdf(df, "v", ["g"]).collect()}
    assert rows["a", 2.0] == pytest.approx((1 / 3, 2 / 3))
    assert rows["a", 5.0] == (1.0, 1.0)
    assert rows["b", 3.0] == (None, None)


def test_folds_are_balanced(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    counts = stratified_folds(df, "y", "id", 10, rows_per_bucket=100).groupBy("y", "fold").count().collect()
    assert {r["count"] for r in counts if r["y"] == 1} == {10}
    assert {r["count"] for r in counts if r["y"] == 0} == {90}


def test_split_and_sample_are_stable(spark):
    df = spark.range(2000).withColumn("y", (F.col("id") % 7 == 0).cast("int"))
    train, valid = train_validation_split(df, "id", 0.25, 3)
    a, b = {r["id"] for r in train.collect()}, {r["id"] for r in valid.collect()}
    assert not a & b and len(a | b) == 2000 and 400 < len(b) < 600
    one = stratified_sample(df, "y", "id", 100, 84).collect()
    two = stratified_sample(df.repartition(11), "y", "id", 100, 84).collect()
    assert sorted(one) == sorted(two) and len(one) == 200
