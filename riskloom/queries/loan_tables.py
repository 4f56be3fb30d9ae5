"""Loan tables derived from the driver tables, one SQL text per table for both engines.

Every row of the driver tables takes part, so the loan tables grow with them. Values are computed
from keys and measures by plain arithmetic (whole numbers and binary fractions, so that sums are
exact), with missing values, sentinels and rare levels mixed in.
"""

from __future__ import annotations

from collections.abc import Sequence

from riskloom.plans.application import CONTACT_FLAGS, DOCUMENTS, ENQUIRIES, HOUSING, REGION_FLAGS


def mix(key: str, i: int, m: int) -> str:
    """A spread-out whole number in [0, m) from a key."""
    return f"((({key} * {7919 + 104 * i} + {31 * i * i + 17}) % 10007) % {m})"


def num(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def gaps(expr: str, key: str, i: int, every: int) -> str:
    """Missing in one of ``every`` rows."""
    return f"CASE WHEN {mix(key, i + 500, every)} = 0 THEN NULL ELSE {expr} END"


def pick(key: str, i: int, levels: Sequence[str | None]) -> str:
    cases = " ".join(f"WHEN {n} THEN '{v}'" for n, v in enumerate(levels) if v is not None)
    return f"CASE {mix(key, i, len(levels))} {cases} END"


def select(source: str, columns: dict[str, str], tail: str = "") -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {source} {tail}"


def _application() -> str:
    k = "c_custkey"
    c = {
        "SK_ID_CURR": k,
        "SEGMENT": "c_mktsegment",
        "TARGET": f"CASE WHEN {mix(k, 1, 10)} + {mix(k, 4, 5)} < 5 THEN 1 ELSE 0 END",
        "NAME_CONTRACT_TYPE": pick(k, 2, ["Cash loans", "Revolving loans", "Cash loans"]),
        "CODE_GENDER": pick(k, 3, ["F", "M", "F", "XNA"]),
        "FLAG_OWN_CAR": pick(k, 4, ["Y", "N", None, "Y"]),
        "FLAG_OWN_REALTY": pick(k, 5, ["Y", "N"]),
        "NAME_INCOME_TYPE": pick(k, 6, ["Working", "Pensioner", "Student", "Working"]),
        "NAME_EDUCATION_TYPE": pick(k, 7, ["Higher", "Secondary", "Secondary", "Lower"]),
        "NAME_FAMILY_STATUS": pick(k, 8, ["Married", "Single", "Widow"]),
        "NAME_HOUSING_TYPE": pick(k, 9, ["House", "Rented", "Parents"]),
        "OCCUPATION_TYPE": pick(k, 10, ["Laborers", "Drivers", None, "Managers", "Cooks"]),
        "ORGANIZATION_TYPE": pick(k, 11, ["Bank", "School", "Police", "Trade", "XNA", "Hotel"]),
        "EMERGENCYSTATE_MODE": pick(k, 12, ["Yes", "No", None, "No", "No"]),
        "AMT_CREDIT": num(f"{mix(k, 13, 900)} + 100"),
        "AMT_INCOME_TOTAL": num("floor(c_acctbal / 16) + 80"),
        "AMT_ANNUITY": gaps(num(f"{mix(k, 14, 60)} + 5"), k, 14, 40),
        "AMT_GOODS_PRICE": gaps(num(f"{mix(k, 15, 800)} + 90"), k, 15, 50),
        "EXT_SOURCE_1": gaps(f"{num(mix(k, 16, 64))} / 64", k, 16, 3),
        "EXT_SOURCE_2": gaps(f"{num(mix(k, 17, 64))} / 64", k, 17, 20),
        "EXT_SOURCE_3": gaps(f"{num(mix(k, 18, 64))} / 64", k, 18, 6),
        "OWN_CAR_AGE": gaps(num(mix(k, 19, 30)), k, 19, 2),
        "DAYS_BIRTH": num(f"-365 * ({mix(k, 20, 45)} + 20)"),
        "DAYS_EMPLOYED": num(f"CASE WHEN {mix(k, 21, 7)} = 0 THEN 365243 ELSE -{mix(k, 22, 4000)} END"),
        "DAYS_REGISTRATION": num(f"-{mix(k, 23, 9000)}"),
        "DAYS_ID_PUBLISH": num(f"-{mix(k, 24, 5000)}"),
        "DAYS_LAST_PHONE_CHANGE": num(f"-{mix(k, 25, 3000)}"),
        "CNT_CHILDREN": mix(k, 26, 4),
        "CNT_FAM_MEMBERS": num(f"{mix(k, 26, 4)} + 1 + {mix(k, 27, 2)}"),
        "HOUR_APPR_PROCESS_START": mix(k, 28, 24),
        "REGION_RATING_CLIENT": f"{mix(k, 29, 3)} + 1",
        "REGION_RATING_CLIENT_W_CITY": f"{mix(k, 30, 3)} + 1",
        "REGION_POPULATION_RELATIVE": f"{num(mix(k, 31, 32))} / 1024",
    }
    for i, n in enumerate(("OBS_30", "DEF_30", "OBS_60", "DEF_60")):
        c[f"{n}_CNT_SOCIAL_CIRCLE"] = gaps(num(f"{mix(k, 40 + i, 36)}"), k, 40 + i, 30)
    for i, n in enumerate([*CONTACT_FLAGS, *REGION_FLAGS, *DOCUMENTS]):
        c[n] = mix(k, 50 + i, 2)
    for i, n in enumerate(ENQUIRIES):
        c[n] = gaps(num(mix(k, 90 + i, 9)), k, 90 + i, 8)
    for j, kind in enumerate(("AVG", "MODE", "MEDI")):
        for i, n in enumerate(HOUSING):
            c[f"{n}_{kind}"] = gaps(f"{num(mix(k, 100 + 20 * j + i, 128))} / 128", k, 100 + i, 25)
    c["TOTALAREA_MODE"] = f"{num(mix(k, 170, 128))} / 128"
    return select("{customer}", c)


def _previous() -> str:
    k = "o_orderkey"
    credit = "(floor(o_totalprice / 1000) + 1)"

    def day(i: int) -> str:
        return gaps(num(f"CASE WHEN {mix(k, i, 11)} = 0 THEN 365243 ELSE -{mix(k, i + 1, 2800)} - 1 END"), k, i, 9)

    def cat(i: int, *levels: str | None) -> str:
        return pick(k, i, levels)

    c = {
        "SK_ID_PREV": k,
        "SK_ID_CURR": "o_custkey",
        "NAME_CONTRACT_TYPE": cat(1, "Cash loans", "Consumer loans", "Revolving loans"),
        "AMT_ANNUITY": gaps(num(f"{mix(k, 2, 40)} + 2"), k, 2, 12),
        "AMT_APPLICATION": num(f"{credit} + {mix(k, 3, 40)} - 20"),
        "AMT_CREDIT": num(credit),
        "AMT_DOWN_PAYMENT": gaps(num(mix(k, 4, 50)), k, 4, 2),
        "AMT_GOODS_PRICE": gaps(num(f"{credit} + {mix(k, 5, 30)}"), k, 5, 5),
        "WEEKDAY_APPR_PROCESS_START": cat(6, "MONDAY", "TUESDAY", "FRIDAY", "SUNDAY"),
        "HOUR_APPR_PROCESS_START": mix(k, 7, 24),
        "FLAG_LAST_APPL_PER_CONTRACT": cat(8, "Y", "Y", "N"),
        "NFLAG_LAST_APPL_IN_DAY": mix(k, 9, 2),
        "RATE_DOWN_PAYMENT": gaps(f"{num(mix(k, 10, 32))} / 32", k, 10, 2),
        "RATE_INTEREST_PRIMARY": gaps(f"{num(mix(k, 11, 64))} / 64", k, 11, 2),
        "RATE_INTEREST_PRIVILEGED": gaps(f"{num(mix(k, 12, 64))} / 64", k, 12, 2),
        "NAME_CASH_LOAN_PURPOSE": cat(13, "XAP", "Repairs", "Other", None),
        "NAME_CONTRACT_STATUS": "CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE "
        + cat(14, "Canceled", "Unused offer") + " END",
        "DAYS_DECISION": num(f"-{mix(k, 15, 2900)} - 1"),
        "NAME_PAYMENT_TYPE": cat(16, "Cash", "XNA", "Account"),
        "CODE_REJECT_REASON": cat(17, "XAP", "HC", "LIMIT", "SCO"),
        "NAME_TYPE_SUITE": cat(18, "Family", None, "Other", None),
        "NAME_CLIENT_TYPE": cat(19, "New", "Repeater", "Refreshed"),
        "NAME_GOODS_CATEGORY": cat(20, "Mobile", "Audio", "XNA", "Furniture", "Medicine"),
        "NAME_PORTFOLIO": cat(21, "POS", "Cash", "Cards", "XNA"),
        "NAME_PRODUCT_TYPE": cat(22, "XNA", "walk-in", "x-sell"),
        "CHANNEL_TYPE": cat(23, "Stone", "Country-wide", "Contact center", "Local"),
        "SELLERPLACE_AREA": num(f"CASE WHEN {mix(k, 24, 29)} = 0 THEN 4000000 ELSE {mix(k, 25, 300)} + 1 END"),
        "NAME_SELLER_INDUSTRY": cat(26, "XNA", "Connectivity", "Clothing"),
        "CNT_PAYMENT": gaps(num(f"6 * ({mix(k, 27, 10)} + 1)"), k, 27, 7),
        "NAME_YIELD_GROUP": cat(28, "XNA", "low_action", "low_normal", "middle", "high"),
        "PRODUCT_COMBINATION": "o_orderpriority",
        "DAYS_FIRST_DRAWING": day(30),
        "DAYS_FIRST_DUE": day(33),
        "DAYS_LAST_DUE_1ST_VERSION": day(36),
        "DAYS_LAST_DUE": day(39),
        "DAYS_TERMINATION": day(42),
        "NFLAG_INSURED_ON_APPROVAL": gaps(num(mix(k, 45, 2)), k, 45, 4),
    }
    return select("{orders}", c)


def _bureau() -> str:
    k = "o_orderkey"
    c = {
        "SK_ID_CURR": "o_custkey",
        "SK_ID_BUREAU": k,
        "CREDIT_ACTIVE": "CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE "
        + pick(k, 60, ["Sold", "Bad debt", None]) + " END",
        "CREDIT_CURRENCY": pick(k, 61, ["currency 1", "currency 1", "currency 2"]),
        "CREDIT_TYPE": pick(k, 62, ["Consumer credit", "Credit card", "Car loan", "Mortgage"]),
        "DAYS_CREDIT": num(f"-{mix(k, 63, 2900)} - 1"),
        "CREDIT_DAY_OVERDUE": num(f"CASE WHEN {mix(k, 64, 4)} = 0 THEN {mix(k, 65, 90)} ELSE 0 END"),
        "DAYS_CREDIT_ENDDATE": gaps(num(f"CASE WHEN {mix(k, 66, 23)} = 0 THEN -41875 ELSE {mix(k, 67, 4000)} - 2000 END"), k, 66, 16),
        "DAYS_ENDDATE_FACT": gaps(num(f"-{mix(k, 68, 2500)}"), k, 68, 3),
        "AMT_CREDIT_MAX_OVERDUE": gaps(num(mix(k, 69, 200)), k, 69, 3),
        "CNT_CREDIT_PROLONG": num(mix(k, 70, 4)),
        "AMT_CREDIT_SUM": gaps(num("floor(o_totalprice / 1000)"), k, 71, 60),
        "AMT_CREDIT_SUM_DEBT": gaps(num(mix(k, 72, 300)), k, 72, 7),
        "AMT_CREDIT_SUM_LIMIT": gaps(num(mix(k, 73, 100)), k, 73, 3),
        "AMT_CREDIT_SUM_OVERDUE": num(f"CASE WHEN {mix(k, 74, 5)} = 0 THEN {mix(k, 75, 60)} ELSE 0 END"),
        "DAYS_CREDIT_UPDATE": num(f"-{mix(k, 76, 1500)}"),
        "AMT_ANNUITY": gaps(num(mix(k, 77, 40)), k, 77, 2),
    }
    return select("{orders}", c)


def _bureau_balance() -> str:
    k = "(l_orderkey * 7 + l_linenumber)"
    c = {
        "SK_ID_BUREAU": "l_orderkey",
        "MONTHS_BALANCE": "CAST(5 - 5 * l_linenumber AS INT)",
        "STATUS": pick(k, 80, ["C", "0", "1", "2", "X", "3", "4", "5", None]),
    }
    return select("{lineitem}", c, "GROUP BY l_orderkey, l_linenumber")


def _cash() -> str:
    k = "(l_orderkey * 7 + l_linenumber)"
    c = {
        "SK_ID_PREV": "l_orderkey",
        "SK_ID_CURR": "max(o_custkey)",
        "MONTHS_BALANCE": "CAST(5 - 5 * l_linenumber AS INT)",
        "CNT_INSTALMENT": gaps(num("sum(l_quantity)"), k, 200, 9),
        "CNT_INSTALMENT_FUTURE": gaps(num(mix(k, 201, 30)), k, 201, 9),
        "NAME_CONTRACT_STATUS": pick(k, 202, ["Active", "Completed", "Active", "Signed", "Demand"]),
        "SK_DPD": mix(k, 203, 12),
        "SK_DPD_DEF": mix(k, 204, 3),
    }
    return select("{lineitem} JOIN {orders} ON o_orderkey = l_orderkey", c, "GROUP BY l_orderkey, l_linenumber")


def _installments() -> str:
    k = "(l_orderkey * 7 + l_linenumber)"
    c = {
        "SK_ID_PREV": "l_orderkey",
        "SK_ID_CURR": "max(o_custkey)",
        "NUM_INSTALMENT_VERSION": num(mix(k, 210, 3)),
        "NUM_INSTALMENT_NUMBER": "CAST(l_linenumber AS INT)",
        "DAYS_INSTALMENT": num("-97 * l_linenumber"),
        "DAYS_ENTRY_PAYMENT": gaps(num(f"-97 * l_linenumber + {mix(k, 211, 20)} - 10"), k, 211, 15),
        "AMT_INSTALMENT": num("sum(l_quantity)"),
        "AMT_PAYMENT": gaps(num(f"sum(l_quantity) - {mix(k, 212, 7)}"), k, 211, 15),
    }
    return select("{lineitem} JOIN {orders} ON o_orderkey = l_orderkey", c, "GROUP BY l_orderkey, l_linenumber")


def _card() -> str:
    k = "(user_id * 40 + event_id % 40)"
    c = {
        "SK_ID_PREV": "user_id",
        "SK_ID_CURR": "user_id",
        "MONTHS_BALANCE": "CAST(-(event_id % 40) AS INT)",
        "AMT_BALANCE": num("sum(floor(value))"),
        "AMT_CREDIT_LIMIT_ACTUAL": num(f"45 * {mix(k, 220, 10)}"),
    }
    for i, d in enumerate(("ATM_CURRENT", "CURRENT", "OTHER_CURRENT", "POS_CURRENT")):
        c[f"AMT_DRAWINGS_{d}"] = gaps(num(mix(k, 221 + i, 90)), k, 221 + i, 7)
        c[f"CNT_DRAWINGS_{d}"] = gaps(num(mix(k, 231 + i, 6)), k, 231 + i, 7)
    c |= {
        "AMT_INST_MIN_REGULARITY": gaps(num(mix(k, 240, 30)), k, 240, 8),
        "AMT_PAYMENT_CURRENT": num(f"CASE WHEN {mix(k, 241, 31)} = 0 THEN 4500000 ELSE {mix(k, 242, 80)} END"),
        "AMT_PAYMENT_TOTAL_CURRENT": num(mix(k, 243, 80)),
        "AMT_RECEIVABLE_PRINCIPAL": num(mix(k, 244, 300)),
        "AMT_RECIVABLE": num(mix(k, 245, 300)),
        "AMT_TOTAL_RECEIVABLE": num(mix(k, 246, 300)),
        "CNT_INSTALMENT_MATURE_CUM": gaps(num(mix(k, 247, 40)), k, 247, 9),
        "NAME_CONTRACT_STATUS": pick(k, 248, ["Active", "Active", "Completed", "Demand", "Signed"]),
        "SK_DPD": mix(k, 249, 9),
        "SK_DPD_DEF": mix(k, 250, 3),
    }
    return select("{events}", c, "GROUP BY user_id, event_id % 40")


LOAN_TABLES = {
    "application": _application(),
    "previous": _previous(),
    "bureau": _bureau(),
    "bureau_balance": _bureau_balance(),
    "cash": _cash(),
    "installments": _installments(),
    "card": _card(),
}


def oracle_text(name: str) -> str:
    """The table's text for the oracle, where tables are plain names."""
    return LOAN_TABLES[name].format(
        customer="customer", orders="orders", lineitem="lineitem", events="events"
    )


# -- column lists of the derived tables --------------------------------------------------------------

APPLICATION_TEXT = """NAME_CONTRACT_TYPE CODE_GENDER FLAG_OWN_CAR FLAG_OWN_REALTY NAME_INCOME_TYPE NAME_EDUCATION_TYPE NAME_FAMILY_STATUS
NAME_HOUSING_TYPE OCCUPATION_TYPE ORGANIZATION_TYPE EMERGENCYSTATE_MODE""".split()
APPLICATION_WHOLE = [
    *"CNT_CHILDREN HOUR_APPR_PROCESS_START REGION_RATING_CLIENT REGION_RATING_CLIENT_W_CITY".split(),
    *"FLAG_MOBIL FLAG_EMP_PHONE FLAG_WORK_PHONE FLAG_CONT_MOBILE FLAG_PHONE FLAG_EMAIL".split(),
    *"REG_REGION_NOT_LIVE_REGION REG_REGION_NOT_WORK_REGION LIVE_REGION_NOT_WORK_REGION".split(),
    *"REG_CITY_NOT_LIVE_CITY REG_CITY_NOT_WORK_CITY LIVE_CITY_NOT_WORK_CITY".split(),
    *[f"FLAG_DOCUMENT_{n}" for n in (3, 5, 6, 7, 8, 9, 11, 13, 14, 15, 16, 17, 18, 19, 21)],
]
APPLICATION_REAL = [
    *"AMT_CREDIT AMT_INCOME_TOTAL AMT_ANNUITY AMT_GOODS_PRICE EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3 OWN_CAR_AGE".split(),
    *"DAYS_BIRTH DAYS_EMPLOYED DAYS_REGISTRATION DAYS_ID_PUBLISH DAYS_LAST_PHONE_CHANGE CNT_FAM_MEMBERS REGION_POPULATION_RELATIVE".split(),
    *[f"{kind}_{n}_CNT_SOCIAL_CIRCLE" for n in (30, 60) for kind in ("OBS", "DEF")],
    *[f"AMT_REQ_CREDIT_BUREAU_{unit}" for unit in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR")],
    *[f"{m}_{s}" for s in ("AVG", "MODE", "MEDI") for m in HOUSING],
    "TOTALAREA_MODE",
]
APPLICATION_NUMBERS = APPLICATION_WHOLE + APPLICATION_REAL
PREVIOUS_TEXT = """NAME_CONTRACT_TYPE WEEKDAY_APPR_PROCESS_START FLAG_LAST_APPL_PER_CONTRACT NAME_CASH_LOAN_PURPOSE NAME_CONTRACT_STATUS
NAME_PAYMENT_TYPE CODE_REJECT_REASON NAME_TYPE_SUITE NAME_CLIENT_TYPE NAME_GOODS_CATEGORY NAME_PORTFOLIO NAME_PRODUCT_TYPE CHANNEL_TYPE
NAME_SELLER_INDUSTRY NAME_YIELD_GROUP PRODUCT_COMBINATION""".split()
PREVIOUS_WHOLE = "SK_ID_PREV SK_ID_CURR HOUR_APPR_PROCESS_START NFLAG_LAST_APPL_IN_DAY".split()
PREVIOUS_REAL = """AMT_ANNUITY AMT_APPLICATION AMT_CREDIT AMT_DOWN_PAYMENT AMT_GOODS_PRICE RATE_DOWN_PAYMENT RATE_INTEREST_PRIMARY
RATE_INTEREST_PRIVILEGED DAYS_DECISION SELLERPLACE_AREA CNT_PAYMENT DAYS_FIRST_DRAWING DAYS_FIRST_DUE DAYS_LAST_DUE_1ST_VERSION
DAYS_LAST_DUE DAYS_TERMINATION NFLAG_INSURED_ON_APPROVAL""".split()
