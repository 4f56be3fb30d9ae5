"""Queries for the whole feature builds of each loan table and for what follows them."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import functions as F

from riskloom.functions.columns import DENIED, numeric_columns
from riskloom.operators import drift as D
from riskloom.operators import models as ML
from riskloom.operators import profile as P
from riskloom.operators.aggregate import stat_name, stats_of
from riskloom.operators.correlate import correlation_matrix
from riskloom.operators.moments import column_moments, kept_numbers
from riskloom.operators.impute import fill_own_medians, fit_medians
from riskloom.plans import application as PA
from riskloom.plans import bureau as PB
from riskloom.plans import client_table as PC
from riskloom.plans import installments as PI
from riskloom.plans import previous as PP
from riskloom.plans import scoring as PS
from riskloom.plans import snapshots as SN
from riskloom.queries.base import Tables, all_rounded, once, query, rounded, scratch, sql_all_rounded, sql_spec
from riskloom.queries.loan_tables import APPLICATION_NUMBERS, APPLICATION_TEXT, LOAN_TABLES, oracle_text
from riskloom.queries.quality import CATEGORY_SQL, TEST, TRAIN, _deciles, _distance_sql, _share_sql, sides
from riskloom.queries.scalar import (
    APP_CLEAN,
    APP_FEATURES,
    BUREAU_CLEAN,
    BUREAU_FEATURES,
    BUREAU_RATIOS,
    CARD_FEATURES,
    CARD_RATIOS,
    INST_FEATURES,
    PREV_CLEAN,
    PREV_FEATURES,
    YIELD,
)
from riskloom.queries.tables import REF_CAT, REF_NUM, REF_SQL, sql_ends
from riskloom.session import checkpointed
from riskloom.sources.tables import export_json, stage_read, stage_write


def table(t: Tables, name: str):
    return t.sql(LOAN_TABLES[name])


def names_of(spec, suffix: str = "") -> list[str]:
    return [stat_name(c, s, suffix) for c, s in stats_of(spec)]


def sql_ewm(source: str, key: str, order: str, alpha: float, outputs: dict[str, str]) -> str:
    """Weighted means by a self-join on row numbers."""
    numbered = f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM ({source})"
    w = f"pow({1 - alpha!r}, a.rn - b.rn)"
    sums = ", ".join(
        f"sum(b.{c} * {w}) / sum({w}) FILTER (WHERE b.{c} IS NOT NULL) AS {out}" for out, c in outputs.items()
    )
    return (
        f"SELECT n.*, e.* EXCLUDE ({key}, rn) FROM ({numbered}) n JOIN (SELECT a.{key}, a.rn, {sums} FROM ({numbered}) a "
        f"JOIN ({numbered}) b ON a.{key} = b.{key} AND b.rn <= a.rn GROUP BY 1, 2) e ON e.{key} = n.{key} AND e.rn = n.rn"
    )


def with_columns(source: str, columns: dict[str, str]) -> str:
    return "SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM ({source})"


def sql_filled(inner: str, key: str, columns: list[str]) -> str:
    """Every column but the key filled with its median."""
    medians = ", ".join(f"median({c}) AS {c}" for c in columns)
    picked = ", ".join(f"coalesce(src.{c}::DOUBLE, med.{c}::DOUBLE) AS {c}" for c in columns)
    return f"WITH src AS MATERIALIZED ({inner}), med AS MATERIALIZED (SELECT {medians} FROM src) SELECT src.{key}, {picked} FROM src, med"


def share_sql(column: str, levels: list[str], prefix: str, suffix: str = "") -> str:
    return ", ".join(
        f"avg(CASE WHEN {column} = '{v}' THEN 1.0 ELSE 0.0 END) AS {prefix}_{v.replace(' ', '_')}{suffix}" for v in levels
    )


# -- application ---------------------------------------------------------------------------------

APP_FILLED = (
    f"clean AS MATERIALIZED ({APP_CLEAN}), filled AS MATERIALIZED (SELECT * REPLACE ("
    + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM clean WHERE {TRAIN})) AS {c}" for c in APPLICATION_NUMBERS)
    + ", "
    + ", ".join(
        f"coalesce({c}, (SELECT {c} FROM clean WHERE {c} IS NOT NULL AND {TRAIN} GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"
        for c in APPLICATION_TEXT
        if c not in ("FLAG_OWN_CAR", "FLAG_OWN_REALTY", "EMERGENCYSTATE_MODE")
    )
    + ") FROM clean)"
)
APP_CATS = [
    "NAME_CONTRACT_TYPE", "CODE_GENDER", "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE",
    "OCCUPATION_TYPE", "ORGANIZATION_TYPE",
]


def _p1_sql() -> str:
    joins, picked = "", []
    for i, keys in enumerate(PA.GROUP_KEYS):
        k = ", ".join(keys)
        spec = sql_spec(PA.GROUP_STATS, "_AGG_" + "_".join(keys))
        on = " AND ".join(f"g{i}.{c} = a.{c}" for c in keys)
        joins += f" LEFT JOIN (SELECT {k}, {spec} FROM train GROUP BY ALL) g{i} ON {on}"
        picked.append(f"g{i}.* EXCLUDE ({k})")
    for i, c in enumerate(APP_CATS):
        joins += (
            f" LEFT JOIN (SELECT {c}, avg(1 - TARGET) AS {c}_0, avg(TARGET) AS {c}_1 FROM train WHERE {c} IS NOT NULL GROUP BY 1) r{i} ON r{i}.{c} = a.{c}"
        )
        picked.append(f"r{i}.{c}_0, r{i}.{c}_1")
    return f"WITH {APP_FILLED}, app AS ({with_columns('filled', APP_FEATURES)}), train AS (SELECT * FROM app WHERE {TRAIN}) SELECT a.SK_ID_CURR, {', '.join(picked)} FROM app a{joins}"


def application_tables(t: Tables, **options):
    clean = PA.clean_application(table(t, "application"))
    return PA.build_application(clean.filter(TRAIN).drop("SEGMENT"), clean.filter(TEST).drop("SEGMENT"), **options)


@query("p1_application", sql_all_rounded(_p1_sql(), ["SK_ID_CURR"], 4))
def p1(t: Tables):
    train, test = application_tables(t, neighbours=None)
    both = train.unionByName(test)
    made = [c for c in both.columns if "_AGG_" in c or c[:-2] in APP_CATS]
    return all_rounded(both.select("SK_ID_CURR", *made), ["SK_ID_CURR"], 4)


@query("p1_application_with_models")
def p1b(t: Tables):
    train, test = application_tables(
        t, previous=table(t, "previous"), impute_ext=True, neighbours=500
    )
    return train.unionByName(test)


# -- external loans ------------------------------------------------------------------------------

STATUS = "CASE STATUS WHEN 'C' THEN 0 WHEN '0' THEN 1 WHEN '1' THEN 2 WHEN '2' THEN 3 WHEN 'X' THEN 4 WHEN '3' THEN 5 WHEN '4' THEN 6 WHEN '5' THEN 7 END"
BALANCE_ROWS = (
    f"SELECT SK_ID_BUREAU, m, floor(age / 12) AS MONTHS_BALANCE, STATUS, STATUS / (age + 1) AS WEIGHTED_STATUS FROM (SELECT SK_ID_BUREAU, MONTHS_BALANCE AS m, "
    f"abs(MONTHS_BALANCE) AS age, {STATUS} AS STATUS FROM ({oracle_text('bureau_balance')}))"
)
YEARS = {"_YEAR_0": "{} = 0", "_YEAR_1": "{} = 1", "_YEAR_REST": "{} >= 2"}


def _p2_sql() -> str:
    rows = sql_ewm(BALANCE_ROWS, "SK_ID_BUREAU", "m", 0.8, {"EXP_WEIGHTED_STATUS": "WEIGHTED_STATUS", "EXP_ENCODED_STATUS": "STATUS"})
    parts = [sql_spec(PB.MONTH_STATS, "", None, "m")]
    parts += [sql_spec(PB.YEAR_STATS, s, w.format("MONTHS_BALANCE"), "m") for s, w in YEARS.items()]
    return f"SELECT SK_ID_BUREAU, {', '.join(parts)} FROM ({rows}) GROUP BY 1"


@query("p2_bureau_balance", sql_all_rounded(_p2_sql(), ["SK_ID_BUREAU"]))
def p2(t: Tables):
    return all_rounded(PB.build_bureau_balance(table(t, "bureau_balance")), ["SK_ID_BUREAU"])


BUREAU_LEVELS = {
    "CREDIT_CURRENCY": ["currency 1", "currency 2"],
    "CREDIT_ACTIVE": ["Active", "Bad debt", "Closed", "Sold"],
    "CREDIT_TYPE": ["Car loan", "Consumer credit", "Credit card", "Mortgage"],
}
BALANCE_COLUMNS = names_of(PB.MONTH_STATS) + [n for s in YEARS for n in names_of(PB.YEAR_STATS, s)]
BUREAU_NUMBERS = [
    "DAYS_CREDIT", "CREDIT_DAY_OVERDUE", "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "AMT_CREDIT_MAX_OVERDUE", "CNT_CREDIT_PROLONG",
    "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE", "DAYS_CREDIT_UPDATE", "AMT_ANNUITY",
    *BUREAU_FEATURES, *BUREAU_RATIOS,
    *BALANCE_COLUMNS,
]
ACTIVITY = {
    "_CREDITACTIVE_CLOSED": "CREDIT_ACTIVE = 'Closed'",
    "_CREDITACTIVE_ACTIVE": "CREDIT_ACTIVE = 'Active'",
    "_CREDITACTIVE_REST": "(CREDIT_ACTIVE IS NULL OR CREDIT_ACTIVE NOT IN ('Closed', 'Active'))",
}


def _p3_sql() -> str:
    rows = with_columns(
        f"SELECT b.*, s.* EXCLUDE (SK_ID_BUREAU) FROM ({BUREAU_CLEAN}) b LEFT JOIN ({sql_filled(_p2_sql(), 'SK_ID_BUREAU', BALANCE_COLUMNS)}) s ON s.SK_ID_BUREAU = b.SK_ID_BUREAU",
        BUREAU_FEATURES | BUREAU_RATIOS,
    )
    parts = [sql_spec(PB.LOAN_STATS, s, w, "SK_ID_BUREAU") for s, w in ACTIVITY.items()]
    parts.append(", ".join(f"avg({c}) AS {c}_MEAN_OVERALL" for c in BUREAU_NUMBERS))
    parts += [share_sql(c, levels, PB.ONE_HOT[c], "_MEAN_OVERALL") for c, levels in BUREAU_LEVELS.items()]
    return f"SELECT SK_ID_CURR, {', '.join(parts)} FROM ({rows}) GROUP BY 1"


def bureau_clients(t: Tables):
    # the loans' status statistics are finished and filled before they meet the loans
    balance = fill_own_medians(staged(t, PB.build_bureau_balance(table(t, "bureau_balance"))), ["SK_ID_BUREAU"])
    return PB.build_bureau(PB.clean_bureau(table(t, "bureau")), balance)


@query("p3_bureau", sql_all_rounded(_p3_sql(), ["SK_ID_CURR"], 3))
def p3(t: Tables):
    return all_rounded(bureau_clients(t), ["SK_ID_CURR"], 3)


# -- previous applications -----------------------------------------------------------------------

PREV_TEXT = [
    "NAME_CONTRACT_TYPE", "WEEKDAY_APPR_PROCESS_START", "NAME_CASH_LOAN_PURPOSE", "NAME_PAYMENT_TYPE", "CODE_REJECT_REASON", "NAME_TYPE_SUITE",
    "NAME_CLIENT_TYPE", "NAME_GOODS_CATEGORY", "NAME_PORTFOLIO", "NAME_PRODUCT_TYPE", "CHANNEL_TYPE", "NAME_SELLER_INDUSTRY", "PRODUCT_COMBINATION",
]
PREV_GAPS = [
    "AMT_ANNUITY", "AMT_DOWN_PAYMENT", "AMT_GOODS_PRICE", "RATE_DOWN_PAYMENT", "RATE_INTEREST_PRIMARY", "RATE_INTEREST_PRIVILEGED", "CNT_PAYMENT",
    "SELLERPLACE_AREA", "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION",
    "NFLAG_INSURED_ON_APPROVAL",
]
DUE = "(DAYS_FIRST_DUE IS NULL, coalesce(DAYS_FIRST_DUE, 0), SK_ID_PREV)"


def _p4_sql() -> str:
    joins = ""
    for i, c in enumerate(PREV_TEXT):
        seen = f"SELECT {c} AS v, row_number() OVER (ORDER BY seen_at) AS code FROM (SELECT {c}, min((SK_ID_CURR, {DUE})) AS seen_at FROM src GROUP BY 1)"
        joins += f" LEFT JOIN ({seen}) c{i} ON c{i}.v IS NOT DISTINCT FROM src.{c}"
    replaced = [f"c{i}.code AS {c}" for i, c in enumerate(PREV_TEXT)]
    replaced.append(
        "CASE NAME_CONTRACT_STATUS WHEN 'Approved' THEN 0 WHEN 'Refused' THEN 3 WHEN 'Canceled' THEN 2 WHEN 'Unused offer' THEN 1 END AS NAME_CONTRACT_STATUS"
    )
    replaced.append(f"{YIELD} AS NAME_YIELD_GROUP")
    replaced.append("CASE FLAG_LAST_APPL_PER_CONTRACT WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS FLAG_LAST_APPL_PER_CONTRACT")
    nulls = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in PREV_GAPS)
    derived = ", ".join(f"{e} AS {n}" for n, e in PREV_FEATURES.items())
    rows = (
        f"SELECT src.* REPLACE ({', '.join(replaced)}), {nulls} AS MISSING_VALUES_TOTAL_PREV, {derived} FROM src{joins}"
    )
    ends = sql_ends(
        "SK_ID_CURR", "DAYS_FIRST_DUE NULLS LAST, SK_ID_PREV", f"({rows})", PP.PREVIOUS_STATS, DUE,
        {"_LAST_5": "up > size - 5", "_FIRST_2": "up <= 2", "_ALL": "up > 0"},
    )
    return f"WITH src AS ({PREV_CLEAN}) {ends}"


def previous_clients(t: Tables):
    return PP.build_previous(PP.clean_previous(table(t, "previous")))


@query("p4_previous_application", sql_all_rounded(_p4_sql(), ["SK_ID_CURR"], 4))
def p4(t: Tables):
    return all_rounded(previous_clients(t), ["SK_ID_CURR"], 4)


# -- snapshots of previous loans -----------------------------------------------------------------

LOAN_STATES = {
    "_ACTIVE": "NAME_CONTRACT_STATUS = 'Active'",
    "_COMPLETED": "NAME_CONTRACT_STATUS = 'Completed'",
    "_REST": "(NAME_CONTRACT_STATUS IS NULL OR NAME_CONTRACT_STATUS NOT IN ('Active', 'Completed'))",
}
STATE_LEVELS = ["Active", "Completed", "Demand", "Signed"]


def _loan_sql(rows: str, overall: dict, part: dict) -> tuple[str, list[str]]:
    """Loan-level statistics and the names of their columns."""
    first = {k: v for k, v in overall.items() if k != "SK_ID_CURR"}
    subsets = LOAN_STATES | {s: w.format("yr") for s, w in YEARS.items()}
    parts = ["max(SK_ID_CURR) AS SK_ID_CURR", sql_spec(first, "", None, "m")]
    parts += [sql_spec(part, s, w, "m") for s, w in subsets.items()]
    parts.append(share_sql("NAME_CONTRACT_STATUS", STATE_LEVELS, "CONTRACT"))
    names = names_of(first) + [n for s in subsets for n in names_of(part, s)] + [f"CONTRACT_{v}" for v in STATE_LEVELS]
    return f"SELECT SK_ID_PREV, {', '.join(parts)} FROM ({rows}) GROUP BY 1", names


def _months_sql(source: str) -> str:
    return f"SELECT * EXCLUDE (MONTHS_BALANCE), MONTHS_BALANCE AS m, abs(MONTHS_BALANCE) AS MONTHS_BALANCE, floor(abs(MONTHS_BALANCE) / 12) AS yr FROM ({source})"


def _p5_sql() -> str:
    rows = sql_ewm(
        _months_sql(oracle_text("cash")), "SK_ID_PREV", "m", 0.6,
        {"EXP_CNT_INSTALMENT": "CNT_INSTALMENT", "EXP_CNT_INSTALMENT_FUTURE": "CNT_INSTALMENT_FUTURE"},
    )
    rows = with_columns(
        rows,
        {
            "SK_DPD_RATIO": "SK_DPD / (SK_DPD_DEF + 0.00001)",
            "TOTAL_TERM": "CNT_INSTALMENT + CNT_INSTALMENT_FUTURE",
            "EXP_POS_TOTAL_TERM": "EXP_CNT_INSTALMENT + EXP_CNT_INSTALMENT_FUTURE",
        },
    )
    loans, names = _loan_sql(rows, SN.CASH_STATS, SN.CASH_PART_STATS)
    roll = {n: "mean sum max" if "MEAN" in n else "mean" for n in names}
    return f"SELECT SK_ID_CURR, {sql_spec(roll)} FROM ({loans}) GROUP BY 1"


@query("p5_pos_cash", sql_all_rounded(_p5_sql(), ["SK_ID_CURR"], 4))
def p5(t: Tables):
    return all_rounded(SN.build_cash(table(t, "cash")), ["SK_ID_CURR"], 4)


def _p7_sql() -> str:
    source = f"SELECT * REPLACE (CASE WHEN AMT_PAYMENT_CURRENT <= 4000000 THEN AMT_PAYMENT_CURRENT END AS AMT_PAYMENT_CURRENT) FROM ({oracle_text('card')})"
    derived = dict(CARD_FEATURES | CARD_RATIOS)
    derived["MISSING_VALS_TOTAL_CC"] = derived["MISSING_VALS_TOTAL_CC"].replace(
        "CASE WHEN AMT_PAYMENT_CURRENT > 4000000 THEN 1 ELSE 0 END", "CASE WHEN AMT_PAYMENT_CURRENT IS NULL THEN 1 ELSE 0 END"
    )
    rows = sql_ewm(with_columns(_months_sql(source), derived), "SK_ID_PREV", "m", 0.7, {f"EXP_{c}": c for c in SN.CARD_AVERAGED})
    loans, names = _loan_sql(rows, SN.CARD_STATS, SN.CARD_PART_STATS)
    return f"SELECT SK_ID_CURR, {', '.join(f'avg({n}) AS {n}' for n in names)} FROM ({loans}) GROUP BY 1"


@query("p7_credit_card", sql_all_rounded(_p7_sql(), ["SK_ID_CURR"], 2))
def p7(t: Tables):
    return all_rounded(SN.build_card(table(t, "card")), ["SK_ID_CURR"], 2)


# -- installments --------------------------------------------------------------------------------


def _p6_sql() -> str:
    rows = with_columns(oracle_text("installments"), INST_FEATURES)
    rows = sql_ewm(rows, "SK_ID_PREV", "NUM_INSTALMENT_NUMBER", 0.5, {f"EXP_{c}": c for c in PI.AVERAGED})
    order = "NUM_INSTALMENT_NUMBER"
    recent, opening = "DAYS_INSTALMENT > -365", "rn <= 5"
    parts = [
        sql_spec(PI.PAYMENT_STATS, "", None, order), sql_spec(PI.PERIOD_STATS, "_LAST_1_YEAR", recent, order),
        sql_spec(PI.PERIOD_STATS, "_FIRST_5_INSTALLMENTS", opening, order),
    ]
    loans = f"SELECT SK_ID_PREV, SK_ID_CURR, {', '.join(parts)} FROM ({rows}) GROUP BY 1, 2"
    rest = names_of(PI.PERIOD_STATS, "_LAST_1_YEAR") + names_of(PI.PERIOD_STATS, "_FIRST_5_INSTALLMENTS")
    return f"SELECT SK_ID_CURR, {sql_spec(PI.CLIENT_STATS)}, {', '.join(f'avg({c}) AS {c}' for c in rest)} FROM ({loans}) GROUP BY 1"


@query("p6_installments", sql_all_rounded(_p6_sql(), ["SK_ID_CURR"], 5))
def p6(t: Tables):
    return all_rounded(PI.build_installments(table(t, "installments")), ["SK_ID_CURR"], 5)


# -- client table, selection, scoring ------------------------------------------------------------


FEATURE_TABLES = {
    "bureau": bureau_clients,
    "previous": previous_clients,
    "installments": lambda t: PI.build_installments(table(t, "installments")),
    "cash": lambda t: SN.build_cash(table(t, "cash")),
    "card": lambda t: SN.build_card(table(t, "card")),
}


def staged(t: Tables, df):
    """The table written once and read back."""
    path = scratch(t.spark)
    stage_write(df, path)
    return stage_read(t.spark, path)


def feature_table(t: Tables, name: str):
    """A feature table, filled with its medians and then pruned; staged because several decisions read it again."""
    return PC.filled_and_pruned(staged(t, FEATURE_TABLES[name](t)), ["SK_ID_CURR"])


def pruned_application(t: Tables):
    sides_ = [staged(t, side) for side in application_tables(t, neighbours=None)]
    return PA.prune_correlated(*sides_, protect=["SK_ID_CURR", "TARGET", *PC.BASE_NEEDED])[:2]


@once
def client_tables(t: Tables):
    """Finished client tables and the dropped columns; built once per session, since four queries start from them.

    The applications and the feature tables do not depend on each other. They are built side by side, so that one that
    is being planned leaves the cores to the others.
    """
    builds = [partial(pruned_application, t), *(partial(feature_table, t, name) for name in FEATURE_TABLES)]
    (train, test), *made = ML.concurrently(t.customer, builds, len(builds))
    features = dict(zip(FEATURE_TABLES, made, strict=True))
    merged = ML.concurrently(t.customer, [lambda base=base: staged(t, PC.merge_clients(base, features)) for base in (train, test)])
    train, test, gone = PC.finish_clients(*merged)
    # selection, fits and scores read the finished tables many times
    out = ML.concurrently(t.customer, [partial(staged, t, side) for side in (train, test)])
    return out[0], out[1], gone


@query("p8_client_table")
def p8(t: Tables):
    train, test, _ = client_tables(t)
    return train.unionByName(test)


@once
def selection(t: Tables):
    """Importances of both models on the client table, and the features that are the best of either."""
    train, test, _ = client_tables(t)
    importances, features = PS.select_features(train, test)
    return checkpointed(importances), features


@query("p9_feature_selection")
def p9(t: Tables):
    return selection(t)[0]


@query("p9_union_of_best", "SELECT 2 AS models, true AS sound")
def p9b(t: Tables):
    """The selected features are those among the best 25 of a model; each model's importances lie in 0 to 1 and reach both."""
    table = p9(t)
    best = (F.col("boosted_ranking") < 25) | (F.col("forest_ranking") < 25)
    ends = [F.min(f"{m}_normalized") == 0 for m in ("boosted", "forest")] + [F.max(f"{m}_normalized") == 1 for m in ("boosted", "forest")]
    sound = F.bool_and(best == (F.col("action") == "Select")) & reduce(lambda x, y: x & y, ends)
    return table.agg(F.lit(2).alias("models"), sound.alias("sound"))


@query("p8_filled_and_pruned", f"SELECT count(*) AS clients, 0 AS gaps, 0 AS strong_pairs FROM ({oracle_text('application')})")
def p8b(t: Tables):
    """Every client once, no gap in any number, and no two of the training table's columns that correlate above 0.7."""
    train, test, _ = client_tables(t)
    both, numbers = train.unionByName(test), numeric_columns(train, ["SK_ID_CURR", "TARGET"])
    clients, known = both.select("SK_ID_CURR").distinct().count(), column_moments(both, numbers)
    rows = both.count()
    gaps = sum(rows - m.present for m in known.values()) + rows - clients
    strong = correlation_matrix(train, numbers, numbers=kept_numbers(train, numbers)).filter(F.abs("r") > 0.7 + 1e-9).count()
    return t.spark.createDataFrame([(clients, gaps, strong)], "clients long, gaps int, strong_pairs int")


@once
def fitted_scoring(t: Tables) -> PS.FittedScoring:
    """The model on the selected features with the state that a later table needs."""
    train, _, gone = client_tables(t)
    _, features = selection(t)
    rows = ML.balanced(train, "TARGET")
    model = ML.fit_classifier(rows, features, "TARGET", ML.boosted_classifier("TARGET"))
    return PS.FittedScoring([c for c in gone if c not in set(features)], fit_medians(train, features), features, model)


@once
def scored_set(t: Tables):
    train, test, _ = client_tables(t)
    state = fitted_scoring(t)
    out = PS.scored_and_explained(train.unionByName(test), train, state.model, state.features)
    return checkpointed(PS.dashboard_set(out, PS.general_info(table(t, "application"))))


@query("p10_scoring_set")
def p10(t: Tables):
    return scored_set(t)


@query(
    "p10_sample_of_each_class",
    f"SELECT TARGET, least(count(*), 100) AS n, true AS sound FROM ({oracle_text('application')}) WHERE TARGET IS NOT NULL GROUP BY TARGET",
)
def p10b(t: Tables):
    """100 clients of each class; scores, decisions and contributions agree with each other."""
    out = p10(t)
    why = [c for c in out.columns if c.startswith("WHY_")]
    gap = reduce(lambda x, y: x + y, [F.col(c) for c in why]) - (F.col("proba") - F.col("expected"))
    sound = F.col("proba").between(0, 1) & (F.abs(gap) < 1e-6) & ((F.col("prediction") == DENIED) == (F.col("credit_score") >= 50))
    return out.groupBy("TARGET").agg(F.count(F.lit(1)).alias("n"), F.bool_and(sound).alias("sound"))


@query(
    "a8_scores_as_documents",
    f"SELECT count(*) AS documents, true AS complete FROM (SELECT row_number() OVER (PARTITION BY TARGET) AS i FROM ({oracle_text('application')}) WHERE TARGET IS NOT NULL) WHERE i <= 100",
)
def a8b(t: Tables):
    """The scored clients exported as JSON documents and read back: every column of every client."""
    out, path = p10(t), scratch(t.spark)
    export_json(out, path)
    back = t.spark.read.schema(out.schema).json(path)
    same = reduce(lambda x, y: x & y, [F.col(f"b.`{c}`").eqNullSafe(F.col(f"a.`{c}`")) for c in out.columns])
    return out.alias("a").join(back.alias("b"), F.col("a.SK_ID_CURR") == F.col("b.SK_ID_CURR")).agg(F.count(F.lit(1)).alias("documents"), F.bool_and(same).alias("complete"))


@query("a2_saved_scoring", f"SELECT SK_ID_CURR, true AS equal FROM ({oracle_text('application')}) WHERE {TEST}")
def a2b(t: Tables):
    """A later table is scored alike by the fitted state and by the state that was saved and read by another session."""
    _, test, _ = client_tables(t)
    state, path = fitted_scoring(t), scratch(t.spark)
    state.save(t.spark, path)
    again = PS.FittedScoring.load(t.spark.newSession(), path)
    a, b = (s.score(test).select("SK_ID_CURR", "credit_score", "prediction") for s in (state, again))
    b = b.select("SK_ID_CURR", F.col("credit_score").alias("c"), F.col("prediction").alias("p"))
    return a.join(b, "SK_ID_CURR").select("SK_ID_CURR", ((F.col("c") == F.col("credit_score")) & (F.col("p") == F.col("prediction"))).alias("equal"))


@query(
    "p11_client_comparison",
    f"WITH one AS MATERIALIZED (SELECT * FROM ({oracle_text('application')}) WHERE SK_ID_CURR = 7) SELECT variable, client_value, mean, median, mode FROM ({REF_SQL}) r JOIN ("
    + " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS client_value FROM one" for c in REF_NUM + REF_CAT)
    + ") c USING (variable)",
)
def p11(t: Tables):
    df = table(t, "application").select("SK_ID_CURR", *REF_NUM, *REF_CAT)
    return rounded(P.client_comparison(df, "SK_ID_CURR", 7, P.reference_table(df, exclude=["SK_ID_CURR"])))


def _view_number(c: str) -> str:
    return (
        f"SELECT '{c}' AS variable, (SELECT {c}::DOUBLE FROM one) AS client_number, NULL AS client_value, NULL AS percent, NULL AS rate, "
        f"count(*) FILTER (TARGET = 0 AND bin = own) AS negatives, count(*) FILTER (TARGET = 1 AND bin = own) AS positives, NULL AS mode, avg(x) AS mean, "
        "any_value(a) AS q25, any_value(m) AS median, any_value(b) AS q75, min(x) FILTER (x >= a - 3 * (b - a)) AS whisker_low, max(x) FILTER (x <= b + 3 * (b - a)) AS whisker_high "
        "FROM (SELECT *, least(floor((x - lo) / nullif((hi - lo) / 25, 0)), 24) AS bin_, coalesce(least(floor((x - lo) / nullif((hi - lo) / 25, 0)), 24), 0) AS bin, "
        "CASE WHEN v IS NOT NULL THEN coalesce(least(floor((v - lo) / nullif((hi - lo) / 25, 0)), 24), 0) END AS own FROM ("
        f"SELECT TARGET, {c}::DOUBLE AS x, (SELECT {c}::DOUBLE FROM one) AS v, min({c}::DOUBLE) OVER () AS lo, max({c}::DOUBLE) OVER () AS hi, "
        f"quantile_cont({c}::DOUBLE, 0.25) OVER () AS a, median({c}::DOUBLE) OVER () AS m, quantile_cont({c}::DOUBLE, 0.75) OVER () AS b FROM src) WHERE x IS NOT NULL)"
    )


def _view_category(c: str) -> str:
    mine = f"{c} = (SELECT {c} FROM one)"
    return (
        f"SELECT '{c}', NULL, (SELECT CAST({c} AS VARCHAR) FROM one), 100.0 * count(*) FILTER ({mine}) / count(*), 100.0 * count(*) FILTER ({mine} AND TARGET = 1) / nullif(count(*) FILTER ({mine}), 0), "
        f"count(*) FILTER ({mine} AND TARGET = 0), count(*) FILTER ({mine} AND TARGET = 1), (SELECT {c} FROM src WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1), "
        "NULL, NULL, NULL, NULL, NULL, NULL FROM src"
    )


VIEW_SQL = (
    f"WITH src AS MATERIALIZED ({oracle_text('application')}), one AS MATERIALIZED (SELECT * FROM src WHERE SK_ID_CURR = 7) SELECT variable, round(client_number, 6) + 0.0 AS client_number, client_value, "
    + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in ("percent", "rate"))
    + ", negatives, positives, mode, "
    + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in ("mean", "q25", "median", "q75", "whisker_low", "whisker_high"))
    + " FROM (" + " UNION ALL ".join([_view_number(c) for c in REF_NUM] + [_view_category(c) for c in REF_CAT]) + ")"
)


@query("p11_client_view", VIEW_SQL)
def p11b(t: Tables):
    """The client's page as one table: reference values, box, density and category rates of every column."""
    out = P.client_view(table(t, "application"), "SK_ID_CURR", 7, "TARGET", REF_NUM, REF_CAT)
    number = F.when(F.col("mean").isNotNull(), F.col("client_value").cast("double"))
    text = F.when(F.col("mean").isNull(), F.col("client_value"))
    return rounded(out.select("variable", number.alias("client_number"), text.alias("client_value"), *out.columns[2:]))


REPORT_SQL = (
    " UNION ALL ".join(
        f"SELECT d.variable, 'numeric' AS kind, ks, wasserstein, psi, jensen_shannon, NULL AS chi2, wasserstein >= 0.1 AS drifted FROM ({_distance_sql(c)}) d "
        f"JOIN ({_share_sql(c, _deciles(c))}) s ON s.variable = d.variable"
        for c in ("amount", "client")
    )
    + f" UNION ALL SELECT variable, 'category', NULL, NULL, psi, jensen_shannon, chi2, jensen_shannon >= 0.1 FROM ({CATEGORY_SQL})"
)


@query("p12_drift_report", REPORT_SQL)
def p12(t: Tables):
    return rounded(D.drift_report(*sides(t), ["amount", "client"], ["priority", "status"]))


@query(
    "p12_drift_share",
    f"SELECT count(*) AS n_columns, count(*) FILTER (WHERE drifted) AS n_drifted, avg(drifted::INT) AS share, avg(drifted::INT) >= 0.5 AS table_drifted FROM ({REPORT_SQL})",
)
def p12b(t: Tables):
    return D.drift_share(D.drift_report(*sides(t), ["amount", "client"], ["priority", "status"]))
