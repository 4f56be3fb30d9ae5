import pytest
from pyspark.sql import functions as F

from riskloom.operators import aggregate as A

SCHEMA = "k int, o int, c string, x double"
# one-row key, key with only missing values, key absent from a subset, key with only missing values in
# a subset, tied and missing order values, missing key
ROWS = [
    (1, 1, "A", 5.0),
    (2, 1, "A", None), (2, 2, "B", None),
    (3, 1, "A", 1.0), (3, 2, "A", 2.0), (3, None, "B", None),
    (4, 1, "B", 7.0), (4, 1, None, 9.0),
    (None, 1, "A", 100.0),
]
SPEC = {"x": "mean sum max min first last"}


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "id int, " + SCHEMA)


def by_key(out):
    return {r["k"]: r.asDict() for r in out.collect()}


def test_missing_value_rules(df):
    got = by_key(A.group_agg(df, ["k"], SPEC, ["o", "id"]))
    assert set(got) == {1, 2, 3, 4}
    assert got[2]["X_SUM"] == 0 and got[2]["X_MEAN"] is None and got[2]["X_LAST"] is None
    assert (got[3]["X_FIRST"], got[3]["X_LAST"]) == (1.0, 2.0)
    assert (got[4]["X_FIRST"], got[4]["X_LAST"]) == (7.0, 9.0)


def test_empty_subset_is_missing_but_all_missing_subset_sums_to_zero(df):
    got = by_key(A.subset_agg(df, ["k"], SPEC, A.categories("c", ["A", "B"]), ["o", "id"]))
    assert got[1]["X_SUM_A"] == 5.0 and got[1]["X_SUM_B"] is None
    assert got[2]["X_SUM_A"] == 0.0 and got[3]["X_SUM_B"] == 0.0
    assert got[4]["X_SUM_REST"] == 9.0 and got[4]["X_SUM_A"] is None


def test_subsets_equal_filtered_groups_joined(df):
    fused = A.subset_agg(df, ["k"], SPEC, {"_A": F.col("c") == "A", "_B": F.col("c") == "B"}, ["o", "id"])
    parts = [A.group_agg(df.filter(F.col("c") == v), ["k"], SPEC, ["o", "id"], f"_{v}") for v in "AB"]
    joined = parts[0].join(parts[1], "k", "outer").select(*fused.columns)
    assert sorted(map(str, fused.collect())) == sorted(map(str, joined.collect()))


def test_ends(df):
    last = A.take_last(df, ["k"], ["o", "id"], 1).collect()
    assert {r["k"]: r["id"] for r in last}[3] == 5  # the missing order value counts as the latest
    out = by_key(A.agg_with_ends(df, ["k"], {"x": "sum"}, ["o", "id"], last=2, first=1))
    assert out[3]["X_SUM_LAST_2"] == 2.0 and out[3]["X_SUM_FIRST_1"] == 1.0 and out[3]["X_SUM_ALL"] == 3.0


def test_result_does_not_depend_on_partitions(df):
    a = A.group_agg(df, ["k"], SPEC, ["o", "id"]).collect()
    b = A.group_agg(df.orderBy(F.desc("id")).repartition(7), ["k"], SPEC, ["o", "id"]).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_order_is_required(df):
    with pytest.raises(ValueError):
        A.group_agg(df, ["k"], {"x": "last"})
    with pytest.raises(ValueError):
        A.take_first(df, ["k"], [], 2)


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = A.take_first(df, ["k"], ["id"], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_merge_renames_clashes_and_checks_keys(spark):
    base = spark.createDataFrame([(1, 10)], "k int, v int")
    other = spark.createDataFrame([(1, 20)], "k int, v int")
    assert A.merge_client_tables(base, {"t": other}, "k").columns == ["k", "v", "t_v"]
    with pytest.raises(ValueError):
        A.merge_client_tables(base, {"t": other.union(other)}, "k", check=True)


def test_first_and_last_keep_the_aggregate_hash_based(spark):
    df = spark.range(100).selectExpr("id % 5 AS k", "cast(id as double) AS o", "cast(id as double) AS x")
    plan = A.group_agg(df, ["k"], {"x": "mean last"}, ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_whole_number_order_above_2_53_stays_exact(spark):
    base = 8192 << 40
    rows = [("a", base + i, float(i)) for i in range(4)] + [("a", None, 9.0), ("b", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, o long, v double")
    got = {r["k"]: r for r in A.group_agg(df, ["k"], {"v": "first last"}, order=["o"]).collect()}
    assert (got["a"]["V_FIRST"], got["a"]["V_LAST"]) == (0.0, 9.0)
    assert got["b"]["V_FIRST"] == 1.0


def test_infinity_sorts_before_missing(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", float("inf"), 2.0), ("a", 1.0, 3.0)], "k string, o double, v double")
    row = A.group_agg(df, ["k"], {"v": "first last"}, order=["o"]).first()
    assert (row["V_FIRST"], row["V_LAST"]) == (3.0, 1.0)


def test_levels_with_like_names_get_columns_of_their_own(spark):
    df = spark.createDataFrame([("a", "x-y"), ("a", "x y"), ("a", "X y")], "k string, c string")
    row = A.category_shares(df, ["k"], "c", "C", ["x-y", "x y"]).first()
    assert row.asDict() == {"k": "a", "C_x_y": 1 / 3, "C_x_y_2": 1 / 3}
    assert list(A.categories("c", ["x y", "X y"])) == ["_X Y", "_X Y_2", "_REST"]


def test_ends_take_one_scan_and_hash_aggregates(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 50 AS k", "id AS o", "cast(id % 7 as double) AS x")
    df.write.parquet(f"{tmp_path}/rows")
    spec = {"x": "mean sum last first"}
    rows = spark.read.parquet(f"{tmp_path}/rows")
    out = A.agg_with_ends(rows, ["k"], spec, ["o"], last=5, first=2, hot_rows=None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan
    # clients beyond the bound are limited before the shuffle; the result is the same
    same = A.agg_with_ends(rows.withColumn("k", F.when(F.col("o") < 400, F.lit(0)).otherwise(F.col("k"))), ["k"], spec, ["o"], last=5, first=2, hot_rows=None)
    cut = A.agg_with_ends(rows.withColumn("k", F.when(F.col("o") < 400, F.lit(0)).otherwise(F.col("k"))), ["k"], spec, ["o"], last=5, first=2, hot_rows=100)
    assert sorted(map(tuple, same.select(sorted(same.columns)).collect())) == sorted(map(tuple, cut.select(sorted(cut.columns)).collect()))
