"""Application table: cleaning, derived columns, model-based columns and category encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import (
    interest,
    nullify_where,
    numeric_columns,
    recode,
    row_max,
    row_mean,
    row_min,
    row_sum,
    row_var,
    safe_ratio,
    string_columns,
    weighted_sum,
)
from riskloom.operators.aggregate import group_statistics
from riskloom.operators.correlate import correlated_columns
from riskloom.operators.encode import response_encode
from riskloom.operators.impute import fill, fit_medians, fit_modes, sparse_columns
from riskloom.operators.models import chained_model_impute, expected_terms
from riskloom.operators.moments import kept_numbers
from riskloom.operators.neighbours import knn_target_mean
from riskloom.session import checkpointed

# Document flags without information, sentinel and outlier bounds, yes/no codes.
UNINFORMATIVE_FLAGS = ["FLAG_DOCUMENT_2", "FLAG_DOCUMENT_4", "FLAG_DOCUMENT_10", "FLAG_DOCUMENT_12", "FLAG_DOCUMENT_20"]
EMPLOYED_SENTINEL = 365243
SPARSE_LIMITS = (68.0, 67.0)  # percent missing in train and in test
SOCIAL_CIRCLE_LIMIT = 30
YES_NO_CODES = {
    "EMERGENCYSTATE_MODE": {"Yes": 0, "No": 1, None: 0},
    "FLAG_OWN_CAR": {"Y": 0, "N": 1, None: 0},
    "FLAG_OWN_REALTY": {"Y": 0, "N": 1, None: 0},
}
# Column groups that are added up.
CONTACT_FLAGS = ["FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL"]
REGION_FLAGS = [
    "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
    "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY",
]
HOUSING = [
    "APARTMENTS", "BASEMENTAREA", "YEARS_BEGINEXPLUATATION", "YEARS_BUILD", "ELEVATORS", "ENTRANCES", "FLOORSMAX",
    "FLOORSMIN", "LANDAREA", "LIVINGAREA", "NONLIVINGAREA",
]
DOCUMENTS = [f"FLAG_DOCUMENT_{n}" for n in (3, 5, 6, 7, 8, 9, 11, 13, 14, 15, 16, 17, 18, 19, 21)]
ENQUIRIES = [f"AMT_REQ_CREDIT_BUREAU_{p}" for p in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR")]
EXT = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
EXT_WEIGHTS = {"EXT_SOURCE_1": 2.0, "EXT_SOURCE_2": 3.0, "EXT_SOURCE_3": 4.0}
RATINGS = ["REGION_RATING_CLIENT", "REGION_RATING_CLIENT_W_CITY"]
# Fixed values: (new column, numerator, denominator) of the guarded ratios.
RATIOS = [
    ("CREDIT_INCOME_RATIO", "AMT_CREDIT", "AMT_INCOME_TOTAL"),
    ("CREDIT_ANNUITY_RATIO", "AMT_CREDIT", "AMT_ANNUITY"),
    ("ANNUITY_INCOME_RATIO", "AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    ("CREDIT_GOODS_RATIO", "AMT_CREDIT", "AMT_GOODS_PRICE"),
    ("GOODS_INCOME_RATIO", "AMT_GOODS_PRICE", "AMT_INCOME_TOTAL"),
    ("INCOME_EXT_RATIO", "AMT_INCOME_TOTAL", "EXT_SOURCE_3"),
    ("CREDIT_EXT_RATIO", "AMT_CREDIT", "EXT_SOURCE_3"),
    ("EMPLOYED_TO_AGE_RATIO", "DAYS_EMPLOYED", "DAYS_BIRTH"),
    ("CAR_EMPLOYED_RATIO", "OWN_CAR_AGE", "DAYS_EMPLOYED"),
    ("CAR_AGE_RATIO", "OWN_CAR_AGE", "DAYS_BIRTH"),
    ("CHILDREN_INCOME_RATIO", "CNT_CHILDREN", "AMT_INCOME_TOTAL"),
    ("OBS_30_CREDIT_RATIO", "AMT_CREDIT", "OBS_30_CNT_SOCIAL_CIRCLE"),
    ("OBS_60_CREDIT_RATIO", "AMT_CREDIT", "OBS_60_CNT_SOCIAL_CIRCLE"),
    ("DEF_30_CREDIT_RATIO", "AMT_CREDIT", "DEF_30_CNT_SOCIAL_CIRCLE"),
    ("DEF_60_CREDIT_RATIO", "AMT_CREDIT", "DEF_60_CNT_SOCIAL_CIRCLE"),
]
# Fixed values: (new column, minuend, subtrahend) of the differences.
DIFFERENCES = [
    ("INCOME_ANNUITY_DIFF", "AMT_INCOME_TOTAL", "AMT_ANNUITY"),
    ("AGE_EMPLOYED_DIFF", "DAYS_BIRTH", "DAYS_EMPLOYED"),
    ("CAR_EMPLOYED_DIFF", "OWN_CAR_AGE", "DAYS_EMPLOYED"),
    ("CAR_AGE_DIFF", "DAYS_BIRTH", "OWN_CAR_AGE"),
    ("CNT_NON_CHILDREN", "CNT_FAM_MEMBERS", "CNT_CHILDREN"),
]
# Key sets and statistics of the group features.
GROUP_KEYS = [
    ["NAME_CONTRACT_TYPE", "NAME_INCOME_TYPE", "OCCUPATION_TYPE"],
    ["CODE_GENDER", "NAME_FAMILY_STATUS", "NAME_INCOME_TYPE"],
    ["FLAG_OWN_CAR", "FLAG_OWN_REALTY", "NAME_INCOME_TYPE"],
    ["NAME_EDUCATION_TYPE", "NAME_INCOME_TYPE", "OCCUPATION_TYPE"],
    ["OCCUPATION_TYPE", "ORGANIZATION_TYPE"],
    ["CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY"],
]
GROUP_STATS = {
    "AMT_ANNUITY": "mean max min",
    "ANNUITY_INCOME_RATIO": "mean max min",
    "AGE_EMPLOYED_DIFF": "mean min",
    "AMT_INCOME_TOTAL": "mean max min",
    "APARTMENTS_SUM_AVG": "mean max min",
    "APARTMENTS_SUM_MEDI": "mean max min",
    "EXT_SOURCE_MEAN": "mean max min",
    "EXT_SOURCE_1": "mean max min",
    "EXT_SOURCE_2": "mean max min",
    "EXT_SOURCE_3": "mean max min",
}
NEIGHBOUR_FEATURES = [*EXT, "CREDIT_ANNUITY_RATIO"]


def clean_application(df: DataFrame, compat: bool = False) -> DataFrame:
    """Recode yes/no columns, turn the age into years and blank sentinels and outliers.

    ``compat=True`` leaves the social-circle outliers in.
    """
    changed = {c: recode(c, m, keep_unmapped=True).cast("int") for c, m in YES_NO_CODES.items() if c in df.columns}
    changed["DAYS_BIRTH"] = F.col("DAYS_BIRTH") * F.lit(-1.0) / F.lit(365.0)
    changed["DAYS_EMPLOYED"] = nullify_where("DAYS_EMPLOYED", F.col("DAYS_EMPLOYED") == EMPLOYED_SENTINEL)
    if not compat:
        for c in ("OBS_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE"):
            changed[c] = nullify_where(c, F.col(c) > SOCIAL_CIRCLE_LIMIT)
    return df.drop(*UNINFORMATIVE_FLAGS).withColumns(changed)


def drop_sparse_and_fill(
    train: DataFrame,
    test: DataFrame,
    key: str = "SK_ID_CURR",
    target: str = "TARGET",
    limits: tuple[float, float] = SPARSE_LIMITS,
    own_medians: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """What comes before the derived columns: sparse columns go, gaps get medians and modes.

    A column goes from a table where it misses more than that table's limit (train, test) in percent; columns
    that derived columns need stay. Fills are fitted on train; ``own_medians=True`` fits test's on test.
    """
    needed = {key, target, *derived_from()}
    train, test = (df.drop(*sparse_columns(df, limit, needed & set(df.columns))) for df, limit in zip((train, test), limits, strict=True))

    def fitted(df: DataFrame) -> dict:
        return fit_medians(df, numeric_columns(df, [key, target])) | fit_modes(df)

    on_train = fitted(train)
    on_test = fitted(test) if own_medians else on_train
    return fill(train, on_train), fill(test, {c: v for c, v in on_test.items() if c in test.columns})


def derived_from() -> list[str]:
    """Columns that the derived columns and the group features are made from."""
    pairs = [c for _, a, b in [*RATIOS, *DIFFERENCES] for c in (a, b)]
    circles = [f"{kind}_{n}_CNT_SOCIAL_CIRCLE" for kind in ("OBS", "DEF") for n in (30, 60)]
    housing = [f"{h}_{kind}" for h in HOUSING for kind in ("AVG", "MODE", "MEDI")]
    changed = ["HOUR_APPR_PROCESS_START", "DAYS_LAST_PHONE_CHANGE", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH", "TOTALAREA_MODE", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS"]
    groups = [c for keys in GROUP_KEYS for c in keys] + list(GROUP_STATS)
    return sorted({*pairs, *circles, *housing, *changed, *groups, *CONTACT_FLAGS, *RATINGS, *REGION_FLAGS, *EXT, *DOCUMENTS, *ENQUIRIES})


def prune_correlated(train: DataFrame, test: DataFrame, protect: Sequence[str], threshold: float = 0.7) -> tuple[DataFrame, DataFrame, list[str]]:
    """Columns that correlate with an earlier one in train go from both tables."""
    gone = correlated_columns(train, threshold, protect, kept_numbers(train, numeric_columns(train, protect)))
    return train.drop(*gone), test.drop(*gone), gone


def application_columns() -> tuple[dict, dict]:
    """Derived columns in two layers; the second uses the first."""
    income, credit = F.col("AMT_INCOME_TOTAL"), F.col("AMT_CREDIT")
    obs_def = {n: [f"OBS_{n}_CNT_SOCIAL_CIRCLE", f"DEF_{n}_CNT_SOCIAL_CIRCLE"] for n in (30, 60)}
    first = {name: safe_ratio(a, b) for name, a, b in RATIOS}
    first |= {name: F.col(a) - F.col(b) for name, a, b in DIFFERENCES}
    first |= {
        "CREDIT_GOODS_DIFF": credit - F.col("AMT_GOODS_PRICE") + F.lit(1e-5),
        "PER_CAPITA_INCOME": safe_ratio(income, "CNT_FAM_MEMBERS", 1.0),
        "FLAG_CONTACTS_SUM": row_sum(CONTACT_FLAGS),
        "HOUR_PROCESS_CREDIT_MUL": credit * F.col("HOUR_APPR_PROCESS_START"),
        "REGIONS_RATING_INCOME_MUL": row_sum(RATINGS) * income / F.lit(2.0),
        "REGION_RATING_MAX": row_max(RATINGS),
        "REGION_RATING_MIN": row_min(RATINGS),
        "REGION_RATING_MEAN": row_mean(RATINGS),
        "REGION_RATING_MUL": F.col(RATINGS[0]) * F.col(RATINGS[1]),
        "FLAG_REGIONS": row_sum(REGION_FLAGS),
        "EXT_SOURCE_MEAN": row_mean(EXT),
        "EXT_SOURCE_MUL": F.col(EXT[0]) * F.col(EXT[1]) * F.col(EXT[2]),
        "EXT_SOURCE_MAX": row_max(EXT),
        "EXT_SOURCE_MIN": row_min(EXT),
        "EXT_SOURCE_VAR": row_var(EXT),
        "WEIGHTED_EXT_SOURCE": weighted_sum(EXT_WEIGHTS),
        "APARTMENTS_SUM_AVG": row_sum([f"{h}_AVG" for h in HOUSING]),
        "APARTMENTS_SUM_MODE": row_sum([*(f"{h}_MODE" for h in HOUSING), "TOTALAREA_MODE"]),
        "APARTMENTS_SUM_MEDI": row_sum([f"{h}_MEDI" for h in HOUSING]),
        "OBS_30_60_SUM": row_sum([obs_def[30][0], obs_def[60][0]]),
        "DEF_30_60_SUM": row_sum([obs_def[30][1], obs_def[60][1]]),
        "OBS_DEF_30_MUL": F.col(obs_def[30][0]) * F.col(obs_def[30][1]),
        "OBS_DEF_60_MUL": F.col(obs_def[60][0]) * F.col(obs_def[60][1]),
        "SUM_OBS_DEF_ALL": row_sum([*obs_def[30], *obs_def[60]]),
        "SUM_FLAGS_DOCUMENTS": row_sum(DOCUMENTS),
        "DAYS_DETAILS_CHANGE_SUM": row_sum(["DAYS_LAST_PHONE_CHANGE", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH"]),
        "AMT_ENQ_SUM": row_sum(ENQUIRIES),
    }
    second = {f"INCOME_APARTMENT_{kind}_MUL": F.col(f"APARTMENTS_SUM_{kind}") * income for kind in ("AVG", "MODE", "MEDI")}
    second["ENQ_CREDIT_RATIO"] = safe_ratio("AMT_ENQ_SUM", credit)
    return first, second


def add_application_features(df: DataFrame) -> DataFrame:
    first, second = application_columns()
    return df.withColumns(first).withColumns(second)


def add_expected_interest(df: DataFrame) -> DataFrame:
    parts = interest("AMT_ANNUITY", "EXPECTED_CNT_PAYMENT", "AMT_CREDIT")
    return df.withColumns(
        {"EXPECTED_INTEREST": parts["amount"], "EXPECTED_INTEREST_SHARE": parts["share"], "EXPECTED_INTEREST_RATE": parts["rate"]}
    )


def build_application(
    train: DataFrame,
    test: DataFrame,
    previous: DataFrame | None = None,
    key: str = "SK_ID_CURR",
    target: str = "TARGET",
    impute_ext: bool = False,
    neighbours: int | None = 500,
    exclude_self: bool = True,
    categorical: Sequence[str] = (),
    impute_rounds: int = 1000,
    term_rounds: int = 5000,
    prepare: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Features of cleaned train and test applications; everything fitted is fitted on train only.

    The order is: model-based values, sparse columns and fills (unless ``prepare=False``), derived columns,
    expected terms, neighbours, group statistics, class shares.
    ``categorical`` names numeric columns to be treated as categories.
    """
    if impute_ext:
        train, test = chained_model_impute(
            train, [test], ["EXT_SOURCE_2", "EXT_SOURCE_3", "EXT_SOURCE_1"], exclude=[key, target, *EXT], rounds=impute_rounds
        )
    if prepare:
        train, test = drop_sparse_and_fill(train, test, key, target)
    train, test = add_application_features(train), add_application_features(test)
    if previous is not None:
        train, test = expected_terms(previous, [train, test], rounds=term_rounds)
        train, test = add_expected_interest(train), add_expected_interest(test)
    if impute_ext or previous is not None or neighbours:
        # several fits below read these tables again
        train, test = checkpointed(train), checkpointed(test)
    if neighbours:
        name = f"TARGET_NEIGHBORS_{neighbours}_MEAN"
        fit = train.select(key, target, *NEIGHBOUR_FEATURES)
        train, test = (
            knn_target_mean(fit, train, key, NEIGHBOUR_FEATURES, target, neighbours, exclude_self, name),
            knn_target_mean(fit, test, key, NEIGHBOUR_FEATURES, target, neighbours, False, name),
        )
        train, test = checkpointed(train), checkpointed(test)
    cats = [*string_columns(train), *categorical]
    # every key set and the class shares read the same few columns
    used = [target, *cats, *(c for keys in GROUP_KEYS for c in keys), *GROUP_STATS]
    fit = checkpointed(train.select(*dict.fromkeys(used)))
    wide = group_statistics(fit, [train, test], GROUP_KEYS, GROUP_STATS)
    train, test = response_encode(fit, wide, cats, target)
    return train, test
