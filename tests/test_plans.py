import pytest
from pyspark.sql import functions as F

from riskloom.operators.aggregate import stats_of
from riskloom.plans import application as PA
from riskloom.plans import bureau as PB
from riskloom.plans import client_table as PC
from riskloom.plans import installments as PI
from riskloom.plans import previous as PP
from riskloom.plans import scoring as PS
from riskloom.plans import snapshots as SN
from riskloom.queries.base import Tables
from riskloom.queries.loan_tables import LOAN_TABLES


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, "/root/testdata/sf0.001")


# number of statistics in each table of fixed values
WIDTHS = [
    (PB.MONTH_STATS, 10), (PB.YEAR_STATS, 10), (PB.LOAN_STATS, 52), (PP.PREVIOUS_STATS, 133), (SN.CASH_STATS, 20),
    (SN.CASH_PART_STATS, 17), (PI.PAYMENT_STATS, 30), (PI.PERIOD_STATS, 24), (PI.CLIENT_STATS, 52), (SN.CARD_STATS, 80),
    (SN.CARD_PART_STATS, 27), (PA.GROUP_STATS, 29),
]


@pytest.mark.parametrize(("spec", "width"), WIDTHS)
def test_spec_widths(spec, width):
    assert len(list(stats_of(spec))) == width


def test_application_has_all_derived_columns(spark):
    first, second = PA.application_columns()
    # the smallest rating is kept beside the largest; four more columns come from the expected term
    assert len(first) + len(second) == 51


def test_cleaning_options(t):
    raw = t.sql(LOAN_TABLES["application"])
    high = F.col("OBS_30_CNT_SOCIAL_CIRCLE") > 30
    assert raw.filter(high).count() > 0
    assert PA.clean_application(raw).filter(high).count() == 0
    assert PA.clean_application(raw, compat=True).filter(high).count() == raw.filter(high).count()
    bureau = t.sql(LOAN_TABLES["bureau"])
    assert PB.clean_bureau(bureau).agg(F.min("DAYS_CREDIT_ENDDATE")).first()[0] >= PB.OLDEST_DAY
    assert PB.clean_bureau(bureau, compat=True).agg(F.max("DAYS_CREDIT_ENDDATE")).first()[0] <= PB.OLDEST_DAY


def test_installments_through_the_whole_table(t):
    """The literal variant lets the weighted mean run on from loan to loan."""
    df = t.sql(LOAN_TABLES["installments"])
    order = ["SK_ID_CURR", "SK_ID_PREV", "NUM_INSTALMENT_NUMBER"]
    rows = PI.add_installment_features(df).toPandas().sort_values(order)
    want = rows.AMT_PAYMENT_DIFF.ewm(alpha=0.5).mean().groupby(rows.SK_ID_PREV).last()
    got = PI.installment_loans(df, compat=True).select("SK_ID_PREV", "EXP_AMT_PAYMENT_DIFF_LAST").toPandas()
    got = got.set_index("SK_ID_PREV").EXP_AMT_PAYMENT_DIFF_LAST.sort_index()
    assert (got - want.sort_index()).abs().max() < 1e-9
    assert "EXP_AMT_PAYMENT_DIFF_LAST" in PI.build_installments(df, compat=True).columns


def test_finished_client_table_has_no_gaps_and_no_strong_correlation(t, spark):
    base = PA.add_application_features(PA.clean_application(t.sql(LOAN_TABLES["application"]))).select(
        "SK_ID_CURR", "TARGET", "AMT_CREDIT", "AMT_ANNUITY", "EXT_SOURCE_1", "CREDIT_ANNUITY_RATIO", "APARTMENTS_SUM_AVG",
        "INCOME_APARTMENT_AVG_MUL", "OBS_30_60_SUM",
    )
    doubled = base.withColumn("TWICE", F.col("AMT_CREDIT") * 2)
    train, test, gone = PC.finish_clients(doubled, doubled.drop("TARGET"))
    assert "TWICE" in gone and {"SK_ID_CURR", "TARGET"} <= set(train.columns)
    for df in (train, test):
        assert df.filter(" OR ".join(f"{c} IS NULL" for c in df.columns)).count() == 0


def test_readable_client_information(t):
    raw = t.sql(LOAN_TABLES["application"]).withColumn("CODE_GENDER", F.lit(0))
    info = PS.general_info(raw)
    assert {r["GENDER"] for r in info.select("GENDER").distinct().collect()} == {"Woman"}
    assert info.agg(F.min("AGE")).first()[0] >= 20
