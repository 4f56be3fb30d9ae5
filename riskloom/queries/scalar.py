"""Queries for scans, stages, projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators.sampling import train_validation_split
from riskloom.operators.selection import align_columns
from riskloom.plans.application import add_application_features, add_expected_interest, clean_application
from riskloom.plans.bureau import add_bureau_features, clean_bureau
from riskloom.plans.client_table import add_cross_table_features
from riskloom.plans.installments import add_installment_features
from riskloom.plans.previous import add_previous_features, clean_previous
from riskloom.plans.snapshots import add_card_features, clean_card
from riskloom.queries.base import Tables, all_rounded, query, rounded, scratch, shift
from riskloom.queries.loan_tables import LOAN_TABLES, oracle_text
from riskloom.sources import tables as S

# -- sources and sinks ---------------------------------------------------------------------------


@query("a1_scan_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def a1(t: Tables):
    path = scratch(t.spark)
    t.customer.write.csv(path, header=True)
    return S.scan_csv(
        t.spark, path, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    )


@query(
    "a2_stage_round_trip",
    "SELECT o_orderstatus, count(*) AS n, sum(o_orderkey) AS keys, max(o_totalprice) AS highest FROM orders GROUP BY o_orderstatus",
)
def a2(t: Tables):
    path = scratch(t.spark)
    S.stage_write(t.orders, path)
    return (
        S.stage_read(t.spark, path)
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.max("o_totalprice").alias("highest"))
    )


@query(
    "a3_nan_to_null",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders",
)
def a3(t: Tables):
    nan = F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    return C.nan_to_null(t.orders.select("o_orderkey", nan.alias("price")))


@query(
    "a5_align_columns",
    "SELECT 'customer' AS side, c_custkey AS id, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier",
)
def a5(t: Tables):
    a = t.customer.withColumnsRenamed({"c_custkey": "id", "c_acctbal": "balance"})
    b = t.supplier.withColumnsRenamed({"s_suppkey": "id", "s_acctbal": "balance"})
    a, b = align_columns(a, b)
    return a.withColumn("side", F.lit("customer")).unionByName(b.withColumn("side", F.lit("supplier")))


@query(
    "a6_train_validation_split",
    "SELECT *, CASE WHEN ('0x' || substr(md5('7:' || o_orderkey), 1, 13))::BIGINT / 4503599627370496.0 >= 0.25 THEN 'train' ELSE 'validation' END AS side FROM orders",
)
def a6(t: Tables):
    train, validation = train_validation_split(t.orders, "o_orderkey", 0.25, 7)
    return train.withColumn("side", F.lit("train")).unionByName(validation.withColumn("side", F.lit("validation")))


def _narrow_case(c: str) -> str:
    cases = " ".join(
        f"WHEN min({c}) > {low} AND max({c}) < {high} THEN '{name}'" for name, low, high in S.WHOLE_TYPES
    )
    return f"SELECT '{c}' AS variable, CASE {cases} END AS narrow_type FROM lineitem"


@query(
    "a7_narrow_types",
    " UNION ALL ".join(
        [
            *[_narrow_case(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
            *[f"SELECT '{c}', 'float'" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        ]
    ),
)
def a7(t: Tables):
    narrow = S.narrow_types(t.lineitem)
    kinds = [(f.name, f.dataType.simpleString()) for f in narrow.schema.fields if f.name.startswith("l_")]
    kinds = [k for k in kinds if k[1] not in ("string", "timestamp", "timestamp_ntz")]
    return t.spark.createDataFrame(kinds, "variable string, narrow_type string")


@query(
    "a8_scoring_export",
    "SELECT c_custkey, to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey})::VARCHAR AS document FROM customer",
)
def a8(t: Tables):
    return S.json_rows(t.customer.select("c_custkey", "c_name", "c_nationkey"), "c_custkey")


# -- arithmetic ----------------------------------------------------------------------------------

LINES = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, {} FROM lineitem"
LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


def lines(t: Tables, **columns):
    return t.lineitem.select(*LINE_KEYS, *[c.alias(n) for n, c in columns.items()])


@query(
    "b1_safe_ratio",
    LINES.format(
        "round(l_extendedprice / (l_quantity + 0.00001), 4) AS price_ratio, "
        "round(l_tax / nullif(l_discount, 0), 6) AS plain, round(l_quantity / (l_linenumber + 1), 6) AS plus_one"
    ),
)
def b1(t: Tables):
    return lines(
        t,
        price_ratio=F.round(C.safe_ratio("l_extendedprice", "l_quantity"), 4),
        plain=F.round(C.plain_ratio("l_tax", "l_discount"), 6),
        plus_one=F.round(C.safe_ratio("l_quantity", "l_linenumber", 1.0), 6),
    )


@query(
    "b2_differences_products",
    LINES.format(
        "l_quantity - l_linenumber AS diff, l_quantity * l_linenumber AS product, "
        "2 * l_quantity + 3 * l_linenumber + 4 * l_suppkey AS weighted"
    ),
)
def b2(t: Tables):
    return lines(
        t,
        diff=F.col("l_quantity") - F.col("l_linenumber"),
        product=F.col("l_quantity") * F.col("l_linenumber"),
        weighted=C.weighted_sum({"l_quantity": 2.0, "l_linenumber": 3.0, "l_suppkey": 4.0}),
    )


THREE = "CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END"


@query(
    "b3_row_sum",
    LINES.format(f"({THREE}) + l_linenumber + l_suppkey AS total"),
)
def b3(t: Tables):
    some = C.nullify_where("l_quantity", F.col("l_quantity") > 45)
    return lines(t, total=C.row_sum([some, "l_linenumber", "l_suppkey"]))


@query(
    "b4_row_statistics",
    "SELECT *, CASE WHEN q IS NOT NULL THEN greatest(q, l_linenumber, l_suppkey) END AS hi, "
    "CASE WHEN q IS NOT NULL THEN least(q, l_linenumber, l_suppkey) END AS lo, "
    "round((q + l_linenumber + l_suppkey) / 3, 6) AS mean, "
    "round(((q - m) ^ 2 + (l_linenumber - m) ^ 2 + (l_suppkey - m) ^ 2) / 3, 5) AS var "
    "FROM (SELECT *, (q + l_linenumber + l_suppkey) / 3 AS m FROM (SELECT l_orderkey, l_linenumber, l_suppkey, "
    f"{THREE} AS q FROM lineitem))",
)
def b4(t: Tables):
    cs = ["q", "l_linenumber", "l_suppkey"]
    some = C.nullify_where("l_quantity", F.col("l_quantity") > 45)
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", some.alias("q"))
    return df.select(
        "*", C.row_max(cs).alias("hi"), C.row_min(cs).alias("lo"), F.round(C.row_mean(cs), 6).alias("mean"),
        F.round(C.row_var(cs), 5).alias("var"), ((F.col("q") + F.col("l_linenumber") + F.col("l_suppkey")) / 3).alias("m"),
    )


@query(
    "b5_interest",
    "SELECT SK_ID_PREV, AMT_ANNUITY * CNT_PAYMENT - AMT_CREDIT AS amount, "
    "round((AMT_ANNUITY * CNT_PAYMENT - AMT_CREDIT) / (AMT_CREDIT + 0.00001), 6) + 0.0 AS share, "
    "round((AMT_ANNUITY * CNT_PAYMENT - AMT_CREDIT) * 24 / (AMT_CREDIT * (CNT_PAYMENT + 1)), 6) + 0.0 AS rate "
    f"FROM ({oracle_text('previous')})",
)
def b5(t: Tables):
    parts = C.interest("AMT_ANNUITY", "CNT_PAYMENT", "AMT_CREDIT")
    return rounded(t.sql(LOAN_TABLES["previous"]).select("SK_ID_PREV", *[c.alias(n) for n, c in parts.items()]))


# -- feature builders of each loan table ---------------------------------------------------------

APP_CLEAN = (
    "SELECT * REPLACE (CASE WHEN EMERGENCYSTATE_MODE = 'No' THEN 1 ELSE 0 END AS EMERGENCYSTATE_MODE, "
    "CASE WHEN FLAG_OWN_CAR = 'N' THEN 1 ELSE 0 END AS FLAG_OWN_CAR, "
    "CASE WHEN FLAG_OWN_REALTY = 'N' THEN 1 ELSE 0 END AS FLAG_OWN_REALTY, "
    "DAYS_BIRTH * -1 / 365 AS DAYS_BIRTH, nullif(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED, "
    "CASE WHEN OBS_30_CNT_SOCIAL_CIRCLE > 30 THEN NULL ELSE OBS_30_CNT_SOCIAL_CIRCLE END AS OBS_30_CNT_SOCIAL_CIRCLE, "
    "CASE WHEN OBS_60_CNT_SOCIAL_CIRCLE > 30 THEN NULL ELSE OBS_60_CNT_SOCIAL_CIRCLE END AS OBS_60_CNT_SOCIAL_CIRCLE) "
    f"FROM ({oracle_text('application')})"
)
HOUSE_SUM = {
    kind: " + ".join(
        f"{p}_{kind}"
        for p in (
            "APARTMENTS BASEMENTAREA YEARS_BEGINEXPLUATATION YEARS_BUILD ELEVATORS ENTRANCES FLOORSMAX FLOORSMIN "
            "LANDAREA LIVINGAREA NONLIVINGAREA"
        ).split()
    )
    for kind in ("AVG", "MODE", "MEDI")
}
E1, E2, E3 = "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"
EXT_OK = f"{E1} IS NOT NULL AND {E2} IS NOT NULL AND {E3} IS NOT NULL"
OBS30, OBS60, DEF30, DEF60 = (f"{a}_{n}_CNT_SOCIAL_CIRCLE" for a in ("OBS", "DEF") for n in (30, 60))
APP_FEATURES = {
    "CREDIT_INCOME_RATIO": "AMT_CREDIT / (AMT_INCOME_TOTAL + 0.00001)",
    "CREDIT_ANNUITY_RATIO": "AMT_CREDIT / (AMT_ANNUITY + 0.00001)",
    "ANNUITY_INCOME_RATIO": "AMT_ANNUITY / (AMT_INCOME_TOTAL + 0.00001)",
    "INCOME_ANNUITY_DIFF": "AMT_INCOME_TOTAL - AMT_ANNUITY",
    "CREDIT_GOODS_RATIO": "AMT_CREDIT / (AMT_GOODS_PRICE + 0.00001)",
    "CREDIT_GOODS_DIFF": "AMT_CREDIT - AMT_GOODS_PRICE + 0.00001",
    "GOODS_INCOME_RATIO": "AMT_GOODS_PRICE / (AMT_INCOME_TOTAL + 0.00001)",
    "EMPLOYED_TO_AGE_RATIO": "DAYS_EMPLOYED / (DAYS_BIRTH + 0.00001)",
    "AGE_EMPLOYED_DIFF": "DAYS_BIRTH - DAYS_EMPLOYED",
    "CAR_EMPLOYED_DIFF": "OWN_CAR_AGE - DAYS_EMPLOYED",
    "CAR_AGE_DIFF": "DAYS_BIRTH - OWN_CAR_AGE",
    "CAR_AGE_RATIO": "OWN_CAR_AGE / (DAYS_BIRTH + 0.00001)",
    "FLAG_CONTACTS_SUM": "FLAG_MOBIL + FLAG_EMP_PHONE + FLAG_WORK_PHONE + FLAG_CONT_MOBILE + FLAG_PHONE + FLAG_EMAIL",
    "HOUR_PROCESS_CREDIT_MUL": "AMT_CREDIT * HOUR_APPR_PROCESS_START",
    "CNT_NON_CHILDREN": "CNT_FAM_MEMBERS - CNT_CHILDREN",
    "CHILDREN_INCOME_RATIO": "CNT_CHILDREN / (AMT_INCOME_TOTAL + 0.00001)",
    "PER_CAPITA_INCOME": "AMT_INCOME_TOTAL / (CNT_FAM_MEMBERS + 1)",
    "REGIONS_RATING_INCOME_MUL": "(REGION_RATING_CLIENT + REGION_RATING_CLIENT_W_CITY) * AMT_INCOME_TOTAL / 2",
    "REGION_RATING_MAX": "greatest(REGION_RATING_CLIENT, REGION_RATING_CLIENT_W_CITY)",
    "REGION_RATING_MIN": "least(REGION_RATING_CLIENT, REGION_RATING_CLIENT_W_CITY)",
    "REGION_RATING_MEAN": "(REGION_RATING_CLIENT + REGION_RATING_CLIENT_W_CITY) / 2",
    "REGION_RATING_MUL": "REGION_RATING_CLIENT * REGION_RATING_CLIENT_W_CITY",
    "FLAG_REGIONS": "REG_REGION_NOT_LIVE_REGION + REG_REGION_NOT_WORK_REGION + LIVE_REGION_NOT_WORK_REGION + "
    "REG_CITY_NOT_LIVE_CITY + REG_CITY_NOT_WORK_CITY + LIVE_CITY_NOT_WORK_CITY",
    "EXT_SOURCE_MEAN": f"({E1} + {E2} + {E3}) / 3",
    "EXT_SOURCE_MUL": f"{E1} * {E2} * {E3}",
    "EXT_SOURCE_MAX": f"CASE WHEN {EXT_OK} THEN greatest({E1}, {E2}, {E3}) END",
    "EXT_SOURCE_MIN": f"CASE WHEN {EXT_OK} THEN least({E1}, {E2}, {E3}) END",
    "EXT_SOURCE_VAR": f"({E1}*{E1} + {E2}*{E2} + {E3}*{E3}) / 3 - (({E1} + {E2} + {E3}) / 3) ^ 2",
    "WEIGHTED_EXT_SOURCE": f"{E1} * 2 + {E2} * 3 + {E3} * 4",
    "APARTMENTS_SUM_AVG": HOUSE_SUM["AVG"],
    "APARTMENTS_SUM_MODE": HOUSE_SUM["MODE"] + " + TOTALAREA_MODE",
    "APARTMENTS_SUM_MEDI": HOUSE_SUM["MEDI"],
    "INCOME_APARTMENT_AVG_MUL": f"({HOUSE_SUM['AVG']}) * AMT_INCOME_TOTAL",
    "INCOME_APARTMENT_MODE_MUL": f"({HOUSE_SUM['MODE']} + TOTALAREA_MODE) * AMT_INCOME_TOTAL",
    "INCOME_APARTMENT_MEDI_MUL": f"({HOUSE_SUM['MEDI']}) * AMT_INCOME_TOTAL",
    "OBS_30_60_SUM": f"{OBS30} + {OBS60}",
    "DEF_30_60_SUM": f"{DEF30} + {DEF60}",
    "OBS_DEF_30_MUL": f"{OBS30} * {DEF30}",
    "OBS_DEF_60_MUL": f"{OBS60} * {DEF60}",
    "SUM_OBS_DEF_ALL": f"{OBS30} + {DEF30} + {OBS60} + {DEF60}",
    "SUM_FLAGS_DOCUMENTS": " + ".join(f"FLAG_DOCUMENT_{n}" for n in (3, 5, 6, 7, 8, 9, 11, 13, 14, 15, 16, 17, 18, 19, 21)),
    "DAYS_DETAILS_CHANGE_SUM": "DAYS_LAST_PHONE_CHANGE + DAYS_REGISTRATION + DAYS_ID_PUBLISH",
    "AMT_ENQ_SUM": " + ".join(f"AMT_REQ_CREDIT_BUREAU_{p}" for p in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR")),
    "ENQ_CREDIT_RATIO": "(" + " + ".join(f"AMT_REQ_CREDIT_BUREAU_{p}" for p in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR"))
    + ") / (AMT_CREDIT + 0.00001)",
}
# ratios whose denominator may be zero are divided by the guard alone and reach 1e9; they are
# compared on a coarser grid
APP_LARGE = {
    "INCOME_EXT_RATIO": "AMT_INCOME_TOTAL / (EXT_SOURCE_3 + 0.00001)",
    "CREDIT_EXT_RATIO": "AMT_CREDIT / (EXT_SOURCE_3 + 0.00001)",
    "CAR_EMPLOYED_RATIO": "OWN_CAR_AGE / (DAYS_EMPLOYED + 0.00001)",
    "OBS_30_CREDIT_RATIO": f"AMT_CREDIT / ({OBS30} + 0.00001)",
    "OBS_60_CREDIT_RATIO": f"AMT_CREDIT / ({OBS60} + 0.00001)",
    "DEF_30_CREDIT_RATIO": f"AMT_CREDIT / ({DEF30} + 0.00001)",
    "DEF_60_CREDIT_RATIO": f"AMT_CREDIT / ({DEF60} + 0.00001)",
}


def sql_features(source: str, keys: list[str], fine: dict[str, str], coarse: dict[str, str] | None = None) -> str:
    cols = [*keys, *[f"round(CAST({e} AS DOUBLE) + {shift(6)}, 6) + 0.0 AS {n}" for n, e in fine.items()]]
    cols += [f"round(CAST({e} AS DOUBLE), 2) + 0.0 AS {n}" for n, e in (coarse or {}).items()]
    return f"SELECT {', '.join(cols)} FROM ({source}) AS src"


def features(df, keys: list[str], fine, coarse=()):
    out = all_rounded(df.select(*keys, *fine, *coarse), [*keys, *coarse], 6)
    return out.withColumns({c: F.round(F.col(c).cast("double"), 2) + F.lit(0.0) for c in coarse}) if coarse else out


@query("b6_application_features", sql_features(APP_CLEAN, ["SK_ID_CURR"], APP_FEATURES, APP_LARGE))
def b6(t: Tables):
    df = add_application_features(clean_application(t.sql(LOAN_TABLES["application"])))
    return features(df, ["SK_ID_CURR"], APP_FEATURES, APP_LARGE)


@query(
    "b6_expected_interest",
    sql_features(
        f"SELECT *, 6.0 * (1 + HOUR_APPR_PROCESS_START) AS n FROM ({APP_CLEAN})",
        ["SK_ID_CURR"],
        {
            "EXPECTED_INTEREST": "AMT_ANNUITY * n - AMT_CREDIT",
            "EXPECTED_INTEREST_SHARE": "(AMT_ANNUITY * n - AMT_CREDIT) / (AMT_CREDIT + 0.00001)",
            "EXPECTED_INTEREST_RATE": "24 * (AMT_ANNUITY * n - AMT_CREDIT) / (AMT_CREDIT * (n + 1))",
        },
    ),
)
def b6b(t: Tables):
    df = clean_application(t.sql(LOAN_TABLES["application"]))
    df = df.withColumn("EXPECTED_CNT_PAYMENT", (F.col("HOUR_APPR_PROCESS_START") + 1) * F.lit(6.0))
    names = ["EXPECTED_INTEREST", "EXPECTED_INTEREST_SHARE", "EXPECTED_INTEREST_RATE"]
    return features(add_expected_interest(df), ["SK_ID_CURR"], names)


BUREAU_CLEAN = (
    "SELECT * REPLACE (" + ", ".join(
        f"CASE WHEN {c} < -18250 THEN NULL ELSE {c} END AS {c}"
        for c in ("DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "DAYS_CREDIT_UPDATE")
    ) + f") FROM ({oracle_text('bureau')})"
)
SPAN = "abs(DAYS_CREDIT - DAYS_CREDIT_ENDDATE)"
BUREAU_FEATURES = {
    "CREDIT_DURATION": SPAN,
    "FLAG_OVERDUE_RECENT": "CASE WHEN CREDIT_DAY_OVERDUE = 0 THEN 0 ELSE 1 END",
    "CNT_PROLONGED_MAX_OVERDUE_MUL": "CNT_CREDIT_PROLONG * AMT_CREDIT_MAX_OVERDUE",
    "CURRENT_CREDIT_DEBT_DIFF": "AMT_CREDIT_SUM - AMT_CREDIT_SUM_DEBT",
    "CREDIT_ENDDATE_UPDATE_DIFF": "abs(DAYS_CREDIT_UPDATE - DAYS_CREDIT_ENDDATE)",
}
BUREAU_RATIOS = {
    "MAX_AMT_OVERDUE_DURATION_RATIO": f"AMT_CREDIT_MAX_OVERDUE / ({SPAN} + 0.00001)",
    "CURRENT_AMT_OVERDUE_DURATION_RATIO": f"AMT_CREDIT_SUM_OVERDUE / ({SPAN} + 0.00001)",
    "AMT_OVERDUE_DURATION_LEFT_RATIO": "AMT_CREDIT_SUM_OVERDUE / (DAYS_CREDIT_ENDDATE + 0.00001)",
    "CNT_PROLONGED_DURATION_RATIO": f"CNT_CREDIT_PROLONG / ({SPAN} + 0.00001)",
    "CURRENT_DEBT_TO_CREDIT_RATIO": "AMT_CREDIT_SUM_DEBT / (AMT_CREDIT_SUM + 0.00001)",
    "AMT_ANNUITY_CREDIT_RATIO": "AMT_ANNUITY / (AMT_CREDIT_SUM + 0.00001)",
}


@query("b7_bureau_features", sql_features(BUREAU_CLEAN, ["SK_ID_BUREAU"], BUREAU_FEATURES, BUREAU_RATIOS))
def b7(t: Tables):
    df = add_bureau_features(clean_bureau(t.sql(LOAN_TABLES["bureau"])))
    return features(df, ["SK_ID_BUREAU"], BUREAU_FEATURES, BUREAU_RATIOS)


PREV_CLEAN = (
    "SELECT * REPLACE (" + ", ".join(
        f"nullif({c}, 365243) AS {c}"
        for c in ("DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION")
    ) + f", nullif(SELLERPLACE_AREA, 4000000) AS SELLERPLACE_AREA) FROM ({oracle_text('previous')})"
)
YIELD = "CASE NAME_YIELD_GROUP WHEN 'XNA' THEN 0 WHEN 'low_action' THEN 1 WHEN 'low_normal' THEN 2 WHEN 'middle' THEN 3 WHEN 'high' THEN 4 END"
INTEREST = "(CNT_PAYMENT * AMT_ANNUITY - AMT_CREDIT)"
PREV_FEATURES = {
    "AMT_DECLINED": "AMT_APPLICATION - AMT_CREDIT",
    "AMT_CREDIT_GOODS_RATIO": "AMT_CREDIT / (AMT_GOODS_PRICE + 0.00001)",
    "AMT_CREDIT_GOODS_DIFF": "AMT_CREDIT - AMT_GOODS_PRICE",
    "AMT_CREDIT_APPLICATION_RATIO": "AMT_APPLICATION / (AMT_CREDIT + 0.00001)",
    "CREDIT_DOWNPAYMENT_RATIO": "AMT_DOWN_PAYMENT / (AMT_CREDIT + 0.00001)",
    "GOOD_DOWNPAYMET_RATIO": "AMT_DOWN_PAYMENT / (AMT_GOODS_PRICE + 0.00001)",
    "INTEREST_DOWNPAYMENT": "RATE_DOWN_PAYMENT * AMT_DOWN_PAYMENT",
    "INTEREST_CREDIT": "AMT_CREDIT * RATE_INTEREST_PRIMARY",
    "INTEREST_CREDIT_PRIVILEGED": "AMT_CREDIT * RATE_INTEREST_PRIVILEGED",
    "APPLICATION_AMT_TO_DECISION_RATIO": "AMT_APPLICATION / (DAYS_DECISION + 0.00001) * -1",
    "AMT_APPLICATION_TO_SELLERPLACE_AREA": "AMT_APPLICATION / (SELLERPLACE_AREA + 0.00001)",
    "ANNUITY": "AMT_CREDIT / (CNT_PAYMENT + 0.00001)",
    "ANNUITY_GOODS": "AMT_GOODS_PRICE / (CNT_PAYMENT + 0.00001)",
    "DAYS_FIRST_LAST_DUE_DIFF": "DAYS_LAST_DUE - DAYS_FIRST_DUE",
    "AMT_CREDIT_HOUR_PROCESS_START": "AMT_CREDIT * HOUR_APPR_PROCESS_START",
    "AMT_CREDIT_NFLAG_LAST_APPL_DAY": "AMT_CREDIT * NFLAG_LAST_APPL_IN_DAY",
    "AMT_CREDIT_YIELD_GROUP": f"AMT_CREDIT * {YIELD}",
    "AMT_INTEREST": INTEREST,
    "INTEREST_SHARE": f"{INTEREST} / (AMT_CREDIT + 0.00001)",
    "INTEREST_RATE": f"24 * {INTEREST} / (AMT_CREDIT * (CNT_PAYMENT + 1))",
}


@query("b8_previous_features", sql_features(PREV_CLEAN, ["SK_ID_PREV"], PREV_FEATURES))
def b8(t: Tables):
    df = clean_previous(t.sql(LOAN_TABLES["previous"]))
    codes = {"XNA": 0, "low_action": 1, "low_normal": 2, "middle": 3, "high": 4}
    df = add_previous_features(df.withColumn("NAME_YIELD_GROUP", C.recode("NAME_YIELD_GROUP", codes)))
    return features(df, ["SK_ID_PREV"], PREV_FEATURES)


INST_KEYS = ["SK_ID_PREV", "NUM_INSTALMENT_NUMBER"]
INST_NULLS = " + ".join(
    f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in ("DAYS_ENTRY_PAYMENT", "AMT_PAYMENT")
)
INST_FEATURES = {
    "MISSING_VALS_TOTAL_INSTAL": INST_NULLS,
    "DAYS_PAYMENT_RATIO": "DAYS_INSTALMENT / (DAYS_ENTRY_PAYMENT + 0.00001)",
    "DAYS_PAYMENT_DIFF": "DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT",
    "AMT_PAYMENT_RATIO": "AMT_PAYMENT / (AMT_INSTALMENT + 0.00001)",
    "AMT_PAYMENT_DIFF": "AMT_INSTALMENT - AMT_PAYMENT",
}


@query("b9_installment_features", sql_features(oracle_text("installments"), INST_KEYS, INST_FEATURES))
def b9a(t: Tables):
    return features(add_installment_features(t.sql(LOAN_TABLES["installments"])), INST_KEYS, INST_FEATURES)


CARD_FEATURES = {
    "MISSING_VALS_TOTAL_CC": " + ".join(
        f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END"
        for c in [
            *[f"{a}_DRAWINGS_{d}" for a in ("AMT", "CNT") for d in ("ATM_CURRENT", "CURRENT", "OTHER_CURRENT", "POS_CURRENT")],
            "AMT_INST_MIN_REGULARITY", "CNT_INSTALMENT_MATURE_CUM",
        ]
    ) + " + CASE WHEN AMT_PAYMENT_CURRENT > 4000000 THEN 1 ELSE 0 END",
    "AMT_DRAWING_SUM": "AMT_DRAWINGS_ATM_CURRENT + AMT_DRAWINGS_CURRENT + AMT_DRAWINGS_OTHER_CURRENT + AMT_DRAWINGS_POS_CURRENT",
    "CNT_DRAWING_SUM": "CNT_DRAWINGS_ATM_CURRENT + CNT_DRAWINGS_CURRENT + CNT_DRAWINGS_OTHER_CURRENT + CNT_DRAWINGS_POS_CURRENT "
    "+ CNT_INSTALMENT_MATURE_CUM",
    "PAYMENT_MIN_DIFF": "AMT_PAYMENT_TOTAL_CURRENT - AMT_INST_MIN_REGULARITY",
    "AMT_INTEREST_RECEIVABLE": "AMT_TOTAL_RECEIVABLE - AMT_RECEIVABLE_PRINCIPAL",
}
CARD_RATIOS = {
    "BALANCE_LIMIT_RATIO": "AMT_BALANCE / (AMT_CREDIT_LIMIT_ACTUAL + 0.00001)",
    "MIN_PAYMENT_RATIO": "CASE WHEN AMT_PAYMENT_CURRENT <= 4000000 THEN AMT_PAYMENT_CURRENT END / (AMT_INST_MIN_REGULARITY + 0.0001)",
    "MIN_PAYMENT_TOTAL_RATIO": "AMT_PAYMENT_TOTAL_CURRENT / (AMT_INST_MIN_REGULARITY + 0.00001)",
    "SK_DPD_RATIO": "SK_DPD / (SK_DPD_DEF + 0.00001)",
}


@query(
    "b9_card_features",
    sql_features(
        f"SELECT * EXCLUDE (MONTHS_BALANCE), -MONTHS_BALANCE AS MONTHS_BALANCE FROM ({oracle_text('card')})",
        ["SK_ID_PREV", "MONTHS_BALANCE"], CARD_FEATURES, CARD_RATIOS,
    ),
)
def b9b(t: Tables):
    df = add_card_features(clean_card(t.sql(LOAN_TABLES["card"])))
    return features(df, ["SK_ID_PREV", "MONTHS_BALANCE"], CARD_FEATURES, CARD_RATIOS)


@query(
    "b10_row_null_count",
    f"SELECT SK_ID_PREV, NUM_INSTALMENT_NUMBER, {INST_NULLS} AS missing FROM ({oracle_text('installments')})",
)
def b10(t: Tables):
    df = t.sql(LOAN_TABLES["installments"])
    return df.select("SK_ID_PREV", "NUM_INSTALMENT_NUMBER", C.row_null_count(df.columns).alias("missing"))


@query(
    "b11_nullify_where",
    "SELECT l_orderkey, l_linenumber, l_suppkey, nullif(l_quantity, 50) AS no_sentinel, "
    "CASE WHEN l_extendedprice > 90000 THEN NULL ELSE l_extendedprice END AS no_outlier FROM lineitem",
)
def b11(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        C.nullify_where("l_quantity", F.col("l_quantity") == 50).alias("no_sentinel"),
        C.nullify_where("l_extendedprice", F.col("l_extendedprice") > 90000).alias("no_outlier"),
    )


@query(
    "b12_map_values",
    "SELECT SK_ID_PREV, CASE WHEN NAME_TYPE_SUITE = 'Family' THEN 1 WHEN NAME_TYPE_SUITE IS NULL THEN 0 END AS mapped, "
    "CASE NAME_GOODS_CATEGORY WHEN 'XNA' THEN 'Unknown' ELSE NAME_GOODS_CATEGORY END AS replaced "
    f"FROM ({oracle_text('previous')})",
)
def b12(t: Tables):
    return t.sql(LOAN_TABLES["previous"]).select(
        "SK_ID_PREV",
        C.recode("NAME_TYPE_SUITE", {"Family": 1, None: 0}).alias("mapped"),
        C.recode("NAME_GOODS_CATEGORY", {"XNA": "Unknown"}, keep_unmapped=True).alias("replaced"),
    )


@query(
    "b13_binary_flag",
    f"SELECT SK_ID_PREV, CASE WHEN AMT_DOWN_PAYMENT = 0 THEN 0 ELSE 1 END AS flag FROM ({oracle_text('previous')})",
)
def b13(t: Tables):
    return t.sql(LOAN_TABLES["previous"]).select("SK_ID_PREV", C.zero_flag("AMT_DOWN_PAYMENT").alias("flag"))


@query(
    "b14_time_arithmetic",
    "SELECT SK_ID_CURR, abs(DAYS_REGISTRATION) AS age, CAST(floor(DAYS_REGISTRATION / 12) AS BIGINT) AS floored, "
    "round(DAYS_BIRTH * -1 / 365, 6) AS years, CAST(trunc(abs(DAYS_EMPLOYED / 365)) AS INT) AS whole "
    f"FROM ({oracle_text('application')})",
)
def b14(t: Tables):
    return t.sql(LOAN_TABLES["application"]).select(
        "SK_ID_CURR",
        F.abs("DAYS_REGISTRATION").alias("age"),
        C.floor_div("DAYS_REGISTRATION", 12).alias("floored"),
        F.round(F.col("DAYS_BIRTH") * -1 / 365, 6).alias("years"),
        C.whole_years("DAYS_EMPLOYED").alias("whole"),
    )


@query(
    "b15_decayed_weight",
    f"SELECT SK_ID_PREV, MONTHS_BALANCE, round(SK_DPD / (abs(MONTHS_BALANCE) + 1), 6) AS weighted FROM ({oracle_text('cash')})",
)
def b15(t: Tables):
    return t.sql(LOAN_TABLES["cash"]).select(
        "SK_ID_PREV", "MONTHS_BALANCE", F.round(C.recency_weighted("SK_DPD", F.abs("MONTHS_BALANCE")), 6).alias("weighted")
    )


@query("b16_drop_rename_project", "SELECT o_orderkey AS loan, o_custkey AS client, o_totalprice FROM orders")
def b16(t: Tables):
    dropped = t.orders.drop("o_orderstatus", "o_orderdate", "o_orderpriority")
    return dropped.withColumnsRenamed({"o_orderkey": "loan", "o_custkey": "client"}).select("loan", "client", "o_totalprice")


CROSS = f"SELECT a.*, b.* EXCLUDE (SK_ID_CURR) FROM ({APP_CLEAN}) a LEFT JOIN (SELECT SK_ID_CURR, avg(AMT_ANNUITY) AS AMT_ANNUITY_MEAN_ALL, " \
    "max(AMT_GOODS_PRICE) AS AMT_GOODS_PRICE_MAX_ALL, avg(DAYS_DECISION) AS DAYS_CREDIT_MEAN, max(AMT_DOWN_PAYMENT) AS AMT_PAYMENT_MAX " \
    f"FROM ({oracle_text('previous')}) GROUP BY SK_ID_CURR) b ON a.SK_ID_CURR = b.SK_ID_CURR"


@query(
    "b17_cross_table_ratios",
    sql_features(
        CROSS,
        ["SK_ID_CURR"],
        {
            "PREV_AMT_ANNUITY_MEAN_ALL_INCOME_RATIO": "AMT_ANNUITY_MEAN_ALL / (AMT_INCOME_TOTAL + 0.00001)",
            "PREV_AMT_GOODS_PRICE_MAX_ALL_INCOME_RATIO": "AMT_GOODS_PRICE_MAX_ALL / (AMT_INCOME_TOTAL + 0.00001)",
            "INSTALLMENTS_AMT_PAYMENT_MAX_INCOME_RATIO": "AMT_PAYMENT_MAX / (AMT_INCOME_TOTAL + 0.00001)",
            "BUREAU_DAYS_CREDIT_MEAN_EMPLOYED_DIFF": "DAYS_CREDIT_MEAN - DAYS_EMPLOYED",
            "BUREAU_DAYS_CREDIT_MEAN_REGISTRATION_DIFF": "DAYS_CREDIT_MEAN - DAYS_REGISTRATION",
        },
    ),
)
def b17(t: Tables):
    prev = t.sql(LOAN_TABLES["previous"]).groupBy("SK_ID_CURR").agg(
        F.avg("AMT_ANNUITY").alias("AMT_ANNUITY_MEAN_ALL"), F.max("AMT_GOODS_PRICE").alias("AMT_GOODS_PRICE_MAX_ALL"),
        F.avg("DAYS_DECISION").alias("DAYS_CREDIT_MEAN"), F.max("AMT_DOWN_PAYMENT").alias("AMT_PAYMENT_MAX"),
    )
    base = clean_application(t.sql(LOAN_TABLES["application"])).join(prev, "SK_ID_CURR", "left")
    known = set(base.columns)
    tables = {
        "previous": ["AMT_ANNUITY_MEAN_ALL", "AMT_GOODS_PRICE_MAX_ALL"], "installments": ["AMT_PAYMENT_MAX"],
        "bureau": ["DAYS_CREDIT_MEAN"],
    }
    out = add_cross_table_features(base, tables)
    return features(out, ["SK_ID_CURR"], [c for c in out.columns if c not in known])


@query(
    "b18_row_filters",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 50000 AND 200000 "
    "AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P', 'O')",
)
def b18(t: Tables):
    return t.orders.filter(
        (F.col("o_orderstatus") == "F")
        & F.col("o_totalprice").between(50000, 200000)
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & ~F.col("o_orderstatus").isin("P", "O")
    ).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "b19_clip_to_range",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 10000 AND o_totalprice < 300000 THEN o_totalprice END AS clipped FROM orders",
)
def b19(t: Tables):
    return t.orders.select("o_orderkey", C.clip_to_range("o_totalprice", 10000, 300000).alias("clipped"))


@query(
    "b20_band_decide",
    "SELECT o_orderkey, round(100 * p, 2) AS score, CASE WHEN round(100 * p, 2) >= 75 THEN 'crimson' "
    "WHEN round(100 * p, 2) >= 50.5 THEN 'orange' WHEN round(100 * p, 2) >= 49.5 THEN 'red' "
    "WHEN round(100 * p, 2) >= 25 THEN 'limegreen' ELSE 'green' END AS band, "
    "CASE WHEN round(100 * p, 2) >= 50 THEN 'Credit denied' ELSE 'Credit approved' END AS decision "
    "FROM (SELECT o_orderkey, floor(o_totalprice / 500) / 1024 AS p FROM orders)",
)
def b20(t: Tables):
    p = F.floor(F.col("o_totalprice") / 500) / 1024
    return t.orders.select("o_orderkey", p.alias("p")).select(
        "o_orderkey",
        C.percent_score("p").alias("score"),
        C.band(C.percent_score("p")).alias("band"),
        C.decide("p").alias("decision"),
    )


@query(
    "b21_numeric_as_category",
    f"SELECT CAST(REGION_RATING_CLIENT AS VARCHAR) AS rating, count(*) AS n FROM ({oracle_text('application')}) GROUP BY 1",
)
def b21(t: Tables):
    rows = t.sql(LOAN_TABLES["application"]).select(C.as_category("REGION_RATING_CLIENT").alias("rating"))
    return rows.groupBy("rating").agg(F.count(F.lit(1)).alias("n"))
