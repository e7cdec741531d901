"""The modelling table of applicants, over stand-ins for its history tables made of the whole tables at hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.operators import applicant_features as applicants
from creditloom.operators.rules import Availability
from creditloom.plans.frames import read
from creditloom.plans.registry import query

R, SUMS = 9, 6  # decimals: no mean, share or sum of these tables ends in a 5 right behind them


def _days(date: str) -> str:
    """Days from the application to a date, with months of 30 days."""
    return f"cast(year({date}) * 365 + month({date}) * 30 + day({date}) - 729301 as bigint)"


_LATE = "case when l_returnflag = 'R' then l_partkey % 40 else 0 end"
_PAID = "l_partkey % 20 <> 0"
_STARTED = f"({_days('o_orderdate')} - 700)"
# what each table stands for: the rows, and expressions that Spark and DuckDB read alike
STAND_INS = {
    "application": ("customer", {
        "SK_ID_CURR": "c_custkey", "TARGET": "cast(c_acctbal < 0 as int)", "NAME_CONTRACT_TYPE": "c_mktsegment", "AMT_INCOME_TOTAL": "case when c_custkey % 11 = 0 then 0 else abs(c_acctbal) end", "AMT_CREDIT": "100000 + c_custkey % 50 * 1000",
        "AMT_ANNUITY": "case when c_custkey % 8 <> 0 then 5000 + c_custkey % 7 * 100 end", "AMT_GOODS_PRICE": "90000 + c_custkey % 30 * 1000", "CNT_FAM_MEMBERS": "c_custkey % 4", "DAYS_BIRTH": "-(7300 + c_custkey % 15000)",
        "DAYS_EMPLOYED": "case when c_custkey % 6 = 0 then 365243 else -(c_custkey % 4000) end",
    }),
    "bureau": ("orders", {
        "SK_ID_CURR": "o_custkey", "SK_ID_BUREAU": "o_orderkey", "CREDIT_ACTIVE": "case o_orderstatus when 'O' then 'Active' when 'F' then 'Closed' end", "CREDIT_TYPE": "o_orderpriority", "DAYS_CREDIT": _STARTED, "DAYS_CREDIT_UPDATE": f"{_STARTED} + o_orderkey % 300",
        "DAYS_ENDDATE_FACT": f"case when o_orderkey % 3 = 0 then {_STARTED} + o_orderkey % 500 - 60 end", "AMT_CREDIT_SUM": "o_totalprice", "AMT_CREDIT_SUM_DEBT": "case when o_orderkey % 4 < 3 then o_totalprice * (o_orderkey % 11) / 10 end",
        "AMT_CREDIT_SUM_OVERDUE": "case when o_orderkey % 13 = 0 then o_totalprice / 8 else 0 end", "AMT_CREDIT_MAX_OVERDUE": "case when o_orderkey % 7 = 0 then o_totalprice / 5 end", "CREDIT_DAY_OVERDUE": "case when o_orderkey % 13 = 0 then o_orderkey % 90 else 0 end",
        "CNT_CREDIT_PROLONG": "case when o_orderkey % 5 <> 0 then o_orderkey % 3 end",
    }),
    "bureau_balance": ("lineitem", {
        "SK_ID_BUREAU": "l_orderkey", "MONTHS_BALANCE": "-(l_linenumber * 3 + l_partkey % 5)", "STATUS": "case when l_returnflag = 'R' then substr('012345', cast(l_suppkey % 6 as int) + 1, 1) when l_linestatus = 'F' then 'C' else 'X' end",
    }),
    "previous_application": ("events", {
        "SK_ID_CURR": "user_id", "NAME_CONTRACT_STATUS": "case event_type when 'purchase' then 'Approved' when 'error' then 'Refused' when 'click' then 'Canceled' else 'Unused offer' end", "AMT_APPLICATION": "case when event_id % 9 = 0 then 0 else value * (8 + event_id % 5) end",
        "AMT_CREDIT": "value * 10", "AMT_ANNUITY": "case when event_id % 6 <> 0 then value end", "RATE_DOWN_PAYMENT": "case when event_id % 4 = 0 then cast(event_id % 10 as double) / 20 end", "CNT_PAYMENT": "6 + event_id % 30", "DAYS_DECISION": "-(event_id % 900)",
        "DAYS_TERMINATION": "case when event_id % 5 = 0 then 365243 when event_id % 5 > 1 then 30 - event_id % 700 end",
    }),
    "pos_cash_balance": ("lines", {
        "SK_ID_CURR": "o_custkey", "SK_ID_PREV": "l_orderkey", "MONTHS_BALANCE": "-(l_linenumber * 4)", "SK_DPD": _LATE, "CNT_INSTALMENT_FUTURE": "case when l_partkey % 8 <> 0 then l_quantity end", "NAME_CONTRACT_STATUS": "case l_linestatus when 'O' then 'Active' else 'Completed' end",
    }),
    "credit_card_balance": ("lines", {
        "SK_ID_CURR": "o_custkey", "SK_ID_PREV": "l_suppkey % 9", "MONTHS_BALANCE": "-(l_linenumber * 5)", "SK_DPD": _LATE, "AMT_BALANCE": "l_extendedprice", "AMT_CREDIT_LIMIT_ACTUAL": "case when l_suppkey % 5 = 0 then 0 else 997 * (1 + l_suppkey % 50) end",
        "AMT_DRAWINGS_ATM_CURRENT": "case when l_partkey % 3 = 0 then l_quantity * 10 end", "AMT_PAYMENT_CURRENT": "l_extendedprice * l_discount", "AMT_INST_MIN_REGULARITY": "l_quantity * (l_partkey % 4)",
    }),
    "installments_payments": ("lines", {
        "SK_ID_CURR": "o_custkey", "DAYS_INSTALMENT": _days("o_orderdate"), "DAYS_ENTRY_PAYMENT": f"case when {_PAID} then {_days('l_shipdate')} end", "AMT_INSTALMENT": "l_extendedprice", "AMT_PAYMENT": f"case when {_PAID} then l_extendedprice * (1 - l_discount / 2) end",
    }),
}
ROW_FILTERS = {"bureau": "DAYS_CREDIT_UPDATE <= 0"}
MATRIX = {"application_train": Availability({"SK_ID_CURR": {"timing": "key", "use": False}, "TARGET": {"timing": "outcome", "use": False}}, {"timing": "application", "use": True}), **{n: Availability({}, {"timing": "application", "use": True}) for n in applicants.SETS}}


def table(spark, d, name):
    source, columns = STAND_INS[name]
    if source == "lines":
        rows = read(spark, d, "lineitem").join(read(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    else:
        rows = read(spark, d, source)
    return rows.selectExpr(*(f"{e} as {c}" for c, e in columns.items()))


def rounded(df):
    return df.withColumns({c: F.round(c, SUMS if c.endswith("_SUM") else R) for c, kind in df.dtypes if kind == "double"})


def populations(spark, d):
    people = table(spark, d, "application")
    return people.where("SK_ID_CURR % 5 <> 0"), people.where("SK_ID_CURR % 5 = 0").drop("TARGET")


def _stand_in(name: str) -> str:
    source, columns = STAND_INS[name]
    return f"t_{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {'lineitem JOIN orders ON o_orderkey = l_orderkey' if source == 'lines' else source})"


def _sum(x: str) -> str:
    return f"sum(CAST({x} AS DECIMAL(28,10)))::DOUBLE"


def _avg(x: str) -> str:
    return f"round({_sum(x)} / nullif(count({x}), 0), {R})"


def _rate(condition: str) -> str:
    return f"round(avg(({condition})::INTEGER), {R})"


def _count(condition: str) -> str:
    return f"(count(*) FILTER ({condition}))::BIGINT"


# the same features in SQL
SQL = {
    "bureau": f"""SELECT SK_ID_CURR, count(*)::BIGINT AS BUR_COUNT, {_count("CREDIT_ACTIVE = 'Active'")} AS BUR_ACTIVE_COUNT, {_rate("CREDIT_ACTIVE = 'Active'")} AS BUR_ACTIVE_RATE, {_count("DAYS_CREDIT >= -365")} AS BUR_COUNT_12M,
  count(DISTINCT CREDIT_TYPE)::BIGINT AS BUR_CREDIT_TYPES, max(DAYS_CREDIT)::BIGINT AS BUR_DAYS_CREDIT_MAX, min(DAYS_CREDIT)::BIGINT AS BUR_DAYS_CREDIT_MIN, {_avg("DAYS_CREDIT")} AS BUR_DAYS_CREDIT_MEAN,
  (max(DAYS_ENDDATE_FACT) FILTER (DAYS_ENDDATE_FACT >= DAYS_CREDIT))::BIGINT AS BUR_DAYS_ENDDATE_FACT_MAX, round({_sum("AMT_CREDIT_SUM")}, {SUMS}) AS BUR_AMT_SUM, round(max(AMT_CREDIT_SUM), {R}) AS BUR_AMT_MAX, round({_sum("AMT_CREDIT_SUM_DEBT")}, {SUMS}) AS BUR_DEBT_SUM,
  round({_sum("AMT_CREDIT_SUM_DEBT")} / nullif({_sum("AMT_CREDIT_SUM")}, 0), {R}) AS BUR_DEBT_TO_CREDIT, round({_sum("AMT_CREDIT_SUM_OVERDUE")}, {SUMS}) AS BUR_OVERDUE_SUM, round(max(AMT_CREDIT_MAX_OVERDUE), {R}) AS BUR_MAX_OVERDUE,
  max(CREDIT_DAY_OVERDUE)::BIGINT AS BUR_DAY_OVERDUE_MAX, {_rate("CREDIT_DAY_OVERDUE > 0")} AS BUR_OVERDUE_RATE, sum(CNT_CREDIT_PROLONG)::BIGINT AS BUR_PROLONG_SUM FROM t_bureau WHERE DAYS_CREDIT_UPDATE <= 0 GROUP BY 1""",
    "bureau_balance": f"""SELECT SK_ID_CURR, count(*)::BIGINT AS BB_MONTHS, max(level) AS BB_DPD_LEVEL_MAX, {_rate("level > 0")} AS BB_DPD_MONTH_RATE, {_count("level > 0")} AS BB_DPD_MONTHS, {_count("level > 0 AND MONTHS_BALANCE >= -12")} AS BB_DPD_MONTHS_12M,
  {_rate("STATUS = 'C'")} AS BB_CLOSED_RATE, {_rate("STATUS = 'X'")} AS BB_UNKNOWN_RATE FROM (SELECT *, TRY_CAST(STATUS AS INTEGER) AS level FROM t_bureau_balance) m JOIN (SELECT SK_ID_BUREAU, SK_ID_CURR FROM t_bureau WHERE DAYS_CREDIT_UPDATE <= 0) b USING (SK_ID_BUREAU) GROUP BY 1""",
    "previous_application": f"""SELECT SK_ID_CURR, count(*)::BIGINT AS PREV_COUNT, {_count("DAYS_DECISION >= -365")} AS PREV_COUNT_12M, {_rate("NAME_CONTRACT_STATUS = 'Approved'")} AS PREV_APPROVED_RATE, {_rate("NAME_CONTRACT_STATUS = 'Refused'")} AS PREV_REFUSED_RATE,
  {_rate("NAME_CONTRACT_STATUS = 'Canceled'")} AS PREV_CANCELED_RATE, max(DAYS_DECISION)::BIGINT AS PREV_DAYS_DECISION_MAX, min(DAYS_DECISION)::BIGINT AS PREV_DAYS_DECISION_MIN, {_avg("AMT_CREDIT")} AS PREV_AMT_CREDIT_MEAN,
  round(max(AMT_CREDIT), {R}) AS PREV_AMT_CREDIT_MAX, round({_sum("AMT_CREDIT")}, {SUMS}) AS PREV_AMT_CREDIT_SUM, {_avg("AMT_CREDIT / nullif(AMT_APPLICATION, 0)")} AS PREV_CREDIT_TO_APPLICATION, {_avg("AMT_ANNUITY")} AS PREV_AMT_ANNUITY_MEAN,
  {_avg("RATE_DOWN_PAYMENT")} AS PREV_DOWN_PAYMENT_RATE_MEAN, {_avg("CNT_PAYMENT")} AS PREV_CNT_PAYMENT_MEAN, (max(DAYS_TERMINATION) FILTER (DAYS_TERMINATION <> 365243))::BIGINT AS PREV_DAYS_TERMINATION_MAX,
  {_rate("DAYS_TERMINATION = 365243")} AS PREV_TERMINATION_UNKNOWN_RATE FROM t_previous_application GROUP BY 1""",
    "pos_cash_balance": f"""SELECT SK_ID_CURR, count(*)::BIGINT AS POS_MONTHS, count(DISTINCT SK_ID_PREV)::BIGINT AS POS_CONTRACTS, max(SK_DPD)::BIGINT AS POS_SK_DPD_MAX, {_rate("SK_DPD > 0")} AS POS_DPD_MONTH_RATE,
  {_count("SK_DPD > 0 AND MONTHS_BALANCE >= -12")} AS POS_DPD_MONTHS_12M, {_avg("CNT_INSTALMENT_FUTURE")} AS POS_INSTALMENTS_LEFT_MEAN, {_rate("NAME_CONTRACT_STATUS = 'Active'")} AS POS_ACTIVE_MONTH_RATE FROM t_pos_cash_balance GROUP BY 1""",
    "credit_card_balance": f"""SELECT SK_ID_CURR, count(*)::BIGINT AS CC_MONTHS, count(DISTINCT SK_ID_PREV)::BIGINT AS CC_CARDS, {_avg("used")} AS CC_UTILISATION_MEAN, round(max(used), {R}) AS CC_UTILISATION_MAX,
  {_avg("CASE WHEN MONTHS_BALANCE >= -12 THEN used END")} AS CC_UTILISATION_MEAN_12M, {_avg("AMT_DRAWINGS_ATM_CURRENT")} AS CC_ATM_DRAWINGS_MEAN, {_avg("AMT_PAYMENT_CURRENT / nullif(AMT_INST_MIN_REGULARITY, 0)")} AS CC_PAYMENT_TO_MINIMUM_MEAN,
  max(SK_DPD)::BIGINT AS CC_SK_DPD_MAX, {_rate("SK_DPD > 0")} AS CC_DPD_MONTH_RATE, {_count("SK_DPD > 0 AND MONTHS_BALANCE >= -12")} AS CC_DPD_MONTHS_12M FROM (SELECT *, AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0) AS used FROM t_credit_card_balance) GROUP BY 1""",
    "installments_payments": f"""SELECT SK_ID_CURR, count(*)::BIGINT AS INS_COUNT, {_count("AMT_PAYMENT IS NULL")} AS INS_NO_PAYMENT_RECORD, {_avg("late")} AS INS_DAYS_LATE_MEAN, max(late)::BIGINT AS INS_DAYS_LATE_MAX, {_rate("late > 0")} AS INS_LATE_RATE,
  round(avg((late > 0)::INTEGER) FILTER (DAYS_INSTALMENT >= -365), {R}) AS INS_LATE_RATE_12M, {_rate("short > 0.01")} AS INS_UNDERPAY_RATE, round({_sum("short")}, {SUMS}) AS INS_AMT_SHORT_SUM, {_avg("AMT_PAYMENT / nullif(AMT_INSTALMENT, 0)")} AS INS_PAYMENT_RATIO_MEAN,
  round({_sum("AMT_PAYMENT")}, {SUMS}) AS INS_AMT_PAID_SUM FROM (SELECT *, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS late, AMT_INSTALMENT - AMT_PAYMENT AS short FROM t_installments_payments) GROUP BY 1""",
}
APPLICATION_SQL = f"""SELECT SK_ID_CURR, CASE WHEN SK_ID_CURR % 5 <> 0 THEN 'train' ELSE 'test' END AS population, CASE WHEN SK_ID_CURR % 5 <> 0 THEN TARGET END AS TARGET, NAME_CONTRACT_TYPE, round(AMT_INCOME_TOTAL, {R}) AS AMT_INCOME_TOTAL, AMT_CREDIT, AMT_ANNUITY, AMT_GOODS_PRICE,
  CNT_FAM_MEMBERS, DAYS_BIRTH, nullif(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED, (DAYS_EMPLOYED = 365243)::INTEGER AS APP_NOT_EMPLOYED_FLAG, round(-DAYS_BIRTH / 365.25::DOUBLE, {R}) AS APP_AGE_YEARS, round(nullif(DAYS_EMPLOYED, 365243) / nullif(DAYS_BIRTH, 0), {R}) AS APP_EMPLOYED_TO_AGE,
  round(AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0), {R}) AS APP_CREDIT_TO_INCOME, round(AMT_ANNUITY / nullif(AMT_INCOME_TOTAL, 0), {R}) AS APP_ANNUITY_TO_INCOME, round(AMT_ANNUITY / nullif(AMT_CREDIT, 0), {R}) AS APP_ANNUITY_TO_CREDIT,
  round(AMT_GOODS_PRICE / nullif(AMT_CREDIT, 0), {R}) AS APP_GOODS_TO_CREDIT, round(AMT_INCOME_TOTAL / nullif(CNT_FAM_MEMBERS, 0), {R}) AS APP_INCOME_PER_FAMILY_MEMBER FROM t_application"""
ALL_SETS = f"""WITH {", ".join(map(_stand_in, STAND_INS))}, app AS ({APPLICATION_SQL}), {", ".join(f"f_{n} AS ({sql})" for n, sql in SQL.items())},
joined AS (SELECT app.*, {", ".join(f"f_{n}.* EXCLUDE (SK_ID_CURR), (f_{n}.SK_ID_CURR IS NOT NULL)::INTEGER AS {applicants.SETS[n].flag}" for n in SQL)} FROM app {" ".join(f"LEFT JOIN f_{n} ON f_{n}.SK_ID_CURR = app.SK_ID_CURR" for n in SQL)})"""


def _register(name: str, short: str) -> None:
    needed = [name, *([applicants.SETS[name].through] if applicants.SETS[name].through else [])]

    @query(f"{short}_features", f"WITH {', '.join(map(_stand_in, needed))} {SQL[name]}")
    def history(spark, d):
        return rounded(applicants.history_features(name, {n: table(spark, d, n) for n in needed}, ROW_FILTERS))


for _name, _short in {"bureau": "bureau", "bureau_balance": "bureau_balance", "previous_application": "previous_application", "pos_cash_balance": "pos_cash", "credit_card_balance": "credit_card", "installments_payments": "installment"}.items():
    _register(_name, _short)


@query("application_features", f"WITH {_stand_in('application')} {APPLICATION_SQL}")
def application_features(spark, d):
    return rounded(applicants.application_features(*populations(spark, d), MATRIX["application_train"]))


def everything(spark, d):
    return applicants.modelling_table(*populations(spark, d), {n: table(spark, d, n) for n in applicants.SETS}, MATRIX, ROW_FILTERS)


@query("modelling_table", f"{ALL_SETS} SELECT * FROM joined")
def modelling_table(spark, d):
    return rounded(everything(spark, d))
