"""Applicants' features by hand: missing histories, sentinels, zero denominators, links, filters, order of rows, plans."""

import pytest
from pyspark.sql import functions as F

from creditloom.operators import applicant_features as af
from creditloom.operators.rules import Availability

BUREAU = "SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, CREDIT_TYPE string, DAYS_CREDIT long, DAYS_CREDIT_UPDATE long, DAYS_ENDDATE_FACT long, AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double, AMT_CREDIT_SUM_OVERDUE double, AMT_CREDIT_MAX_OVERDUE double, CREDIT_DAY_OVERDUE long, CNT_CREDIT_PROLONG long"
MONTHS = "SK_ID_BUREAU long, MONTHS_BALANCE long, STATUS string"
CARDS = "SK_ID_CURR long, SK_ID_PREV long, MONTHS_BALANCE long, SK_DPD long, AMT_BALANCE double, AMT_CREDIT_LIMIT_ACTUAL double, AMT_DRAWINGS_ATM_CURRENT double, AMT_PAYMENT_CURRENT double, AMT_INST_MIN_REGULARITY double"
PAID = "SK_ID_CURR long, DAYS_INSTALMENT long, DAYS_ENTRY_PAYMENT long, AMT_INSTALMENT double, AMT_PAYMENT double"
EARLIER = "SK_ID_CURR long, NAME_CONTRACT_STATUS string, AMT_APPLICATION double, AMT_CREDIT double, AMT_ANNUITY double, RATE_DOWN_PAYMENT double, CNT_PAYMENT double, DAYS_DECISION long, DAYS_TERMINATION long"
POS = "SK_ID_CURR long, SK_ID_PREV long, MONTHS_BALANCE long, SK_DPD long, CNT_INSTALMENT_FUTURE double, NAME_CONTRACT_STATUS string"
SCHEMAS = {"bureau": BUREAU, "bureau_balance": MONTHS, "previous_application": EARLIER, "pos_cash_balance": POS, "credit_card_balance": CARDS, "installments_payments": PAID}
KNOWN = {"bureau": "DAYS_CREDIT_UPDATE <= 0"}
LOANS = [
    (1, 10, "Active", "Car", -100, -5, -150, 100.0, 40.0, 0.0, None, 0, 1),
    (1, 11, None, "Car", -400, -5, -350, 0.1, None, 0.0, 7.0, 3, None),
    (1, 12, "Closed", None, -900, -5, None, 0.2, 0.0, None, 2.0, None, 2),
    (1, 13, "Active", "Home", -10, 5, None, 1e6, 1e6, 9.0, 9.0, 99, 9),  # changed after the application
    (2, 20, "Closed", "Car", -50, -1, None, None, None, None, None, None, None),
    (None, 30, "Active", "Car", -50, -1, None, 1.0, 1.0, 1.0, 1.0, 1, 1),
]


def one(df, who=1):
    return df.where(F.col(af.KEY) == who).first()


def made(spark, name, rows):
    return af.history_features(name, {name: spark.createDataFrame(rows, SCHEMAS[name])})


def test_bureau_by_hand(spark):
    got = af.history_features("bureau", {"bureau": spark.createDataFrame(LOANS, BUREAU)}, KNOWN)
    r = one(got)
    assert (r.BUR_COUNT, r.BUR_ACTIVE_COUNT, r.BUR_ACTIVE_RATE, r.BUR_COUNT_12M, r.BUR_CREDIT_TYPES) == (3, 1, 0.5, 1, 1)
    assert (r.BUR_DAYS_CREDIT_MAX, r.BUR_DAYS_CREDIT_MIN, round(r.BUR_DAYS_CREDIT_MEAN, 6), r.BUR_DAYS_ENDDATE_FACT_MAX) == (-100, -900, -466.666667, -350)
    assert (r.BUR_AMT_SUM, r.BUR_AMT_MAX, r.BUR_DEBT_SUM, r.BUR_DEBT_TO_CREDIT) == (100.3, 100.0, 40.0, 40 / 100.3)
    assert (r.BUR_OVERDUE_SUM, r.BUR_MAX_OVERDUE, r.BUR_DAY_OVERDUE_MAX, r.BUR_OVERDUE_RATE, r.BUR_PROLONG_SUM) == (0.0, 7.0, 3, 0.5, 3)
    empty = one(got, 2)
    assert (empty.BUR_COUNT, empty.BUR_ACTIVE_COUNT, empty.BUR_ACTIVE_RATE) == (1, 0, 0.0)
    assert all(empty[c] is None for c in ("BUR_AMT_SUM", "BUR_DEBT_TO_CREDIT", "BUR_OVERDUE_RATE", "BUR_PROLONG_SUM"))


def test_months_reach_the_applicant_through_known_loans(spark):
    months = [(10, -1, "0"), (10, -2, "2"), (10, -14, "3"), (11, -1, "C"), (11, -2, "X"), (12, -3, None), (13, -1, "5"), (99, -1, "5"), (None, -1, "5")]
    got = af.history_features("bureau_balance", {"bureau_balance": spark.createDataFrame(months, MONTHS), "bureau": spark.createDataFrame(LOANS, BUREAU)}, KNOWN)
    r = one(got)
    assert (r.BB_MONTHS, r.BB_DPD_LEVEL_MAX, r.BB_DPD_MONTHS, r.BB_DPD_MONTHS_12M) == (6, 3, 2, 1)
    assert (r.BB_DPD_MONTH_RATE, r.BB_CLOSED_RATE, r.BB_UNKNOWN_RATE) == (2 / 3, 1 / 5, 1 / 5)
    assert got.where(F.col(af.KEY) == 2).isEmpty()


def test_reducing_before_the_join_changes_nothing(spark):
    rows = spark.range(4000).selectExpr("id % 300 as loan", "id % 7 as x", "if(id % 5 = 0, null, id % 11 / 4) as y")
    link = spark.range(260).selectExpr("id as loan", "if(id % 3 = 0, 1, id % 17) as who")  # one holds a third of all loans
    wanted = {"n": af.rows("x > 2"), "s": af.total("y"), "m": af.mean("y", "x < 5"), "top": af.highest("y"), "low": af.lowest("x"), "q": af.quotient("x", "y"), "part": af.share("y > 1")}
    early = af.measured(rows, "who", wanted, link, "loan")
    late = af.measured(rows.join(link, "loan"), "who", wanted)
    assert sorted(map(tuple, early.collect())) == sorted(map(tuple, late.collect()))
    with pytest.raises(ValueError, match="distinct"):
        af.measured(rows, "who", {"k": af.kinds("x")}, link, "loan")


def test_cards_instalments_and_earlier_applications(spark):
    r = one(made(spark, "credit_card_balance", [(1, 5, -1, 0, 50.0, 100.0, 5.0, 10.0, 0.0), (1, 5, -13, 4, 90.0, 100.0, None, 30.0, 10.0), (1, 6, -2, 2, 70.0, 0.0, 7.0, None, 5.0)]))
    assert (r.CC_MONTHS, r.CC_CARDS, r.CC_UTILISATION_MEAN, r.CC_UTILISATION_MAX, r.CC_UTILISATION_MEAN_12M) == (3, 2, 0.7, 0.9, 0.5)
    assert (r.CC_ATM_DRAWINGS_MEAN, r.CC_PAYMENT_TO_MINIMUM_MEAN, r.CC_SK_DPD_MAX, r.CC_DPD_MONTH_RATE, r.CC_DPD_MONTHS_12M) == (6.0, 3.0, 4, 2 / 3, 1)
    r = one(made(spark, "installments_payments", [(1, -10, -5, 100.0, 100.0), (1, -400, -401, 100.0, 99.995), (1, -20, None, 100.0, None), (1, -30, -30, 0.0, 5.0)]))
    assert (r.INS_COUNT, r.INS_NO_PAYMENT_RECORD, round(r.INS_DAYS_LATE_MEAN, 6), r.INS_DAYS_LATE_MAX) == (4, 1, 1.333333, 5)
    assert (r.INS_LATE_RATE, r.INS_LATE_RATE_12M, r.INS_UNDERPAY_RATE) == (1 / 3, 1 / 2, 0.0)
    assert (r.INS_AMT_SHORT_SUM, r.INS_AMT_PAID_SUM, r.INS_PAYMENT_RATIO_MEAN) == (-4.995, 204.995, 0.999975)
    r = one(made(spark, "previous_application", [(1, "Approved", 0.0, 10.0, 1.0, 0.1, 12.0, -3, af.NO_DATE), (1, "Refused", 20.0, 10.0, None, None, None, -400, -7), (1, None, None, None, None, None, None, -5, None)]))
    assert (r.PREV_COUNT, r.PREV_COUNT_12M, r.PREV_APPROVED_RATE, r.PREV_REFUSED_RATE, r.PREV_CANCELED_RATE) == (3, 2, 0.5, 0.5, 0.0)
    assert (r.PREV_CREDIT_TO_APPLICATION, r.PREV_AMT_CREDIT_MEAN, r.PREV_DAYS_TERMINATION_MAX, r.PREV_TERMINATION_UNKNOWN_RATE) == (0.5, 10.0, -7, 0.5)


def people(spark):
    columns = "SK_ID_CURR long, {} AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double, AMT_GOODS_PRICE double, CNT_FAM_MEMBERS double, DAYS_BIRTH long, DAYS_EMPLOYED long, LATER string"
    train = spark.createDataFrame([(1, 1, 0.0, 100.0, 10.0, 90.0, 2.0, -7305, -730, "x"), (2, 0, 50.0, 0.0, None, 1.0, 0.0, -3652, af.NO_DATE, "y")], columns.format("TARGET int,"))
    return train, spark.createDataFrame([(3, 50.0, 100.0, 10.0, 90.0, 2.0, -7305, -730, None)], columns.format(""))


def matrix(**skipped):
    rules = {"LATER": {"timing": "after", "use": False}, af.LABEL: {"timing": "outcome", "use": False}}
    return {"application_train": Availability(rules, {"timing": "application", "use": True}), **{n: Availability({}, {"use": True}, skipped.get(n, True)) for n in af.SETS}}


def test_application_ratios_and_populations(spark):
    got = af.application_features(*people(spark), matrix()["application_train"])
    rows = {r.SK_ID_CURR: r for r in got.collect()}
    assert "LATER" not in got.columns and got.columns.count("DAYS_EMPLOYED") == 1
    assert [(rows[k].population, rows[k].TARGET) for k in (1, 2, 3)] == [("train", 1), ("train", 0), ("test", None)]
    assert (rows[1].APP_CREDIT_TO_INCOME, rows[1].APP_ANNUITY_TO_CREDIT, rows[1].APP_AGE_YEARS, rows[1].APP_NOT_EMPLOYED_FLAG) == (None, 0.1, 20.0, 0)
    assert (rows[2].DAYS_EMPLOYED, rows[2].APP_EMPLOYED_TO_AGE, rows[2].APP_NOT_EMPLOYED_FLAG, rows[2].APP_GOODS_TO_CREDIT, rows[2].APP_INCOME_PER_FAMILY_MEMBER) == (None, None, 1, None, None)


def tables(spark, loans=LOANS):
    empty = {n: spark.createDataFrame([], s) for n, s in SCHEMAS.items()}
    return {**empty, "bureau": spark.createDataFrame(loans, BUREAU), "bureau_balance": spark.createDataFrame([(10, -1, "0")], MONTHS)}


def test_no_history_is_null_and_not_zero(spark):
    got = af.modelling_table(*people(spark), tables(spark), matrix(), KNOWN)
    rows = {r.SK_ID_CURR: r for r in got.collect()}
    assert len(rows) == 3 and got.count() == 3
    assert [(rows[k].HAS_BUR_HISTORY, rows[k].HAS_BB_HISTORY, rows[k].HAS_CC_HISTORY) for k in (1, 2, 3)] == [(1, 1, 0), (1, 0, 0), (0, 0, 0)]
    assert rows[3].BUR_COUNT is None and rows[3].BUR_ACTIVE_COUNT is None and rows[2].BB_MONTHS is None
    assert sum(len(s.features) for s in af.SETS.values()) == 68


def test_tables_that_may_not_be_used_leave_nothing(spark):
    got = af.modelling_table(*people(spark), tables(spark), matrix(bureau_balance=False), KNOWN)
    assert not [c for c in got.columns if c.startswith(("BB_", "HAS_BB"))] and "HAS_BUR_HISTORY" in got.columns


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    rows = spark.range(5000).selectExpr("1L as SK_ID_CURR", "id as SK_ID_PREV", "-(id % 20) as MONTHS_BALANCE", "id % 3 as SK_DPD", "id * 0.1D as AMT_BALANCE", "1 + id % 90 * 0.3D as AMT_CREDIT_LIMIT_ACTUAL", "id * 0.7D as AMT_DRAWINGS_ATM_CURRENT", "id * 0.01D as AMT_PAYMENT_CURRENT", "id % 7 * 0.3D as AMT_INST_MIN_REGULARITY")
    a, b = (af.history_features("credit_card_balance", {"credit_card_balance": r}).first() for r in (rows, rows.orderBy(F.rand(7)).repartition(5)))
    assert a == b


def test_histories_are_not_shuffled_again_for_the_joins(spark):
    got = af.modelling_table(*people(spark), tables(spark), matrix(pos_cash_balance=False, credit_card_balance=False), KNOWN)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the applicants, three tables once each, distinct kinds once more, and the months by loan with the link
    assert plan.count("Exchange hashpartitioning(SK_ID_CURR") <= 6 and plan.count("Exchange hashpartitioning(SK_ID_BUREAU") == 2
