"""The modelling table: one row an applicant, with what six history tables say about them.

A feature is a :class:`Measure`: sums, extremes or distinct counts of the rows, and how they give its value. The sums
that several features of a table need are computed once. Where rows reach the applicant only through another table (the
months of a bureau loan), they are first reduced by the link's key, so that the join moves one row a loan and not one a
month; the reduced rows are then merged by applicant. No table is gathered by applicant before it is reduced, so an
applicant with a large share of the rows costs no more than others.

What is missing stays missing: an applicant without rows in a table has null features and a flag of 0. Sums and means are
exact (in decimals) and do not depend on the order of rows. Rows with a null key belong to nobody."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.exprs import EXACT
from creditloom.operators.rules import Availability

# The applicant, the loan of the bureau, the label, the number that means "no such date"; what is recent
KEY, BUREAU_KEY, LABEL = "SK_ID_CURR", "SK_ID_BUREAU", "TARGET"
NO_DATE = 365243
RECENT_DAYS, RECENT_MONTHS = 365, 12
CENT = 0.01
DAYS_A_YEAR = 365.25

PARTS = {"sum": F.sum, "max": F.max, "min": F.min, "distinct": F.count_distinct}
MERGED = {"sum": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class Measure:
    """A feature of many rows: ``parts`` are (kind, SQL expression), ``value`` takes the columns they give."""

    parts: tuple[tuple[str, str], ...]
    value: Callable[..., Column]


def _same(x: Column) -> Column:
    return x


def _over(x: Column, n: Column) -> Column:
    return x.cast("double") / F.nullif(n.cast("double"), F.lit(0.0))


def _one_if(condition: str) -> str:
    return f"cast(coalesce({condition}, false) as int)"


def rows(where: str = "true") -> Measure:
    """The number of rows of which the condition holds."""
    return Measure((("sum", _one_if(where)),), _same)


def share(condition: str, where: str = "true") -> Measure:
    """The share of the rows of which the condition holds among those where it is not null."""
    known = f"({where}) and ({condition}) is not null"
    return Measure((("sum", _one_if(f"({where}) and ({condition})")), ("sum", _one_if(known))), _over)


def kinds(value: str) -> Measure:
    return Measure((("distinct", value),), _same)


def highest(value: str) -> Measure:
    return Measure((("max", value),), _same)


def lowest(value: str) -> Measure:
    return Measure((("min", value),), _same)


def whole_total(value: str) -> Measure:
    """The sum of whole numbers, null where all are null."""
    return Measure((("sum", f"cast({value} as bigint)"),), _same)


def total(value: str) -> Measure:
    return Measure((("sum", f"cast({value} as {EXACT})"),), lambda s: s.cast("double"))


def mean(value: str, where: str = "true") -> Measure:
    kept = value if where == "true" else f"case when {where} then {value} end"
    return Measure((("sum", f"cast({kept} as {EXACT})"), ("sum", _one_if(f"({kept}) is not null"))), _over)


def quotient(above: str, below: str) -> Measure:
    """The ratio of two sums, null where the lower one is 0."""
    return Measure((("sum", f"cast({above} as {EXACT})"), ("sum", f"cast({below} as {EXACT})")), _over)


@dataclass(frozen=True)
class HistorySet:
    """The features of one table. ``clean`` puts new columns in place of those of the same name, or beside them."""

    prefix: str
    features: Mapping[str, Measure]
    clean: Mapping[str, str] = field(default_factory=dict)
    through: str | None = None  # the table that knows the applicant, joined by BUREAU_KEY

    @property
    def flag(self) -> str:
        return f"HAS_{self.prefix}_HISTORY"


def _not_before_start(end: str) -> str:
    return f"case when {end} < DAYS_CREDIT then null else {end} end"


_RECENT_MONTH = f"MONTHS_BALANCE >= -{RECENT_MONTHS}"
_LATE_MONTH = f"SK_DPD > 0 and {_RECENT_MONTH}"

# The features' names and what each one measures
SETS: dict[str, HistorySet] = {
    "bureau": HistorySet(
        "BUR",
        {
            "BUR_COUNT": rows(),
            "BUR_ACTIVE_COUNT": rows("CREDIT_ACTIVE = 'Active'"),
            "BUR_ACTIVE_RATE": share("CREDIT_ACTIVE = 'Active'"),
            "BUR_COUNT_12M": rows(f"DAYS_CREDIT >= -{RECENT_DAYS}"),
            "BUR_CREDIT_TYPES": kinds("CREDIT_TYPE"),
            "BUR_DAYS_CREDIT_MAX": highest("DAYS_CREDIT"),
            "BUR_DAYS_CREDIT_MIN": lowest("DAYS_CREDIT"),
            "BUR_DAYS_CREDIT_MEAN": mean("DAYS_CREDIT"),
            "BUR_DAYS_ENDDATE_FACT_MAX": highest("DAYS_ENDDATE_FACT"),
            "BUR_AMT_SUM": total("AMT_CREDIT_SUM"),
            "BUR_AMT_MAX": highest("AMT_CREDIT_SUM"),
            "BUR_DEBT_SUM": total("AMT_CREDIT_SUM_DEBT"),
            "BUR_DEBT_TO_CREDIT": quotient("AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM"),
            "BUR_OVERDUE_SUM": total("AMT_CREDIT_SUM_OVERDUE"),
            "BUR_MAX_OVERDUE": highest("AMT_CREDIT_MAX_OVERDUE"),
            "BUR_DAY_OVERDUE_MAX": highest("CREDIT_DAY_OVERDUE"),
            "BUR_OVERDUE_RATE": share("CREDIT_DAY_OVERDUE > 0"),
            "BUR_PROLONG_SUM": whole_total("CNT_CREDIT_PROLONG"),
        },
        {"DAYS_ENDDATE_FACT": _not_before_start("DAYS_ENDDATE_FACT")},
    ),
    "bureau_balance": HistorySet(
        "BB",
        {
            "BB_MONTHS": rows(),
            "BB_DPD_LEVEL_MAX": highest("DPD_LEVEL"),
            "BB_DPD_MONTH_RATE": share("DPD_LEVEL > 0"),
            "BB_DPD_MONTHS": rows("DPD_LEVEL > 0"),
            "BB_DPD_MONTHS_12M": rows(f"DPD_LEVEL > 0 and {_RECENT_MONTH}"),
            "BB_CLOSED_RATE": share("STATUS = 'C'"),
            "BB_UNKNOWN_RATE": share("STATUS = 'X'"),
        },
        {"DPD_LEVEL": "try_cast(STATUS as int)"},
        through="bureau",
    ),
    "previous_application": HistorySet(
        "PREV",
        {
            "PREV_COUNT": rows(),
            "PREV_COUNT_12M": rows(f"DAYS_DECISION >= -{RECENT_DAYS}"),
            "PREV_APPROVED_RATE": share("NAME_CONTRACT_STATUS = 'Approved'"),
            "PREV_REFUSED_RATE": share("NAME_CONTRACT_STATUS = 'Refused'"),
            "PREV_CANCELED_RATE": share("NAME_CONTRACT_STATUS = 'Canceled'"),
            "PREV_DAYS_DECISION_MAX": highest("DAYS_DECISION"),
            "PREV_DAYS_DECISION_MIN": lowest("DAYS_DECISION"),
            "PREV_AMT_CREDIT_MEAN": mean("AMT_CREDIT"),
            "PREV_AMT_CREDIT_MAX": highest("AMT_CREDIT"),
            "PREV_AMT_CREDIT_SUM": total("AMT_CREDIT"),
            "PREV_CREDIT_TO_APPLICATION": mean("(AMT_CREDIT / nullif(AMT_APPLICATION, 0))"),
            "PREV_AMT_ANNUITY_MEAN": mean("AMT_ANNUITY"),
            "PREV_DOWN_PAYMENT_RATE_MEAN": mean("RATE_DOWN_PAYMENT"),
            "PREV_CNT_PAYMENT_MEAN": mean("CNT_PAYMENT"),
            "PREV_DAYS_TERMINATION_MAX": highest("DAYS_ENDED"),
            "PREV_TERMINATION_UNKNOWN_RATE": share(f"DAYS_TERMINATION = {NO_DATE}"),
        },
        {"DAYS_ENDED": f"nullif(DAYS_TERMINATION, {NO_DATE})"},
    ),
    "pos_cash_balance": HistorySet(
        "POS",
        {
            "POS_MONTHS": rows(),
            "POS_CONTRACTS": kinds("SK_ID_PREV"),
            "POS_SK_DPD_MAX": highest("SK_DPD"),
            "POS_DPD_MONTH_RATE": share("SK_DPD > 0"),
            "POS_DPD_MONTHS_12M": rows(_LATE_MONTH),
            "POS_INSTALMENTS_LEFT_MEAN": mean("CNT_INSTALMENT_FUTURE"),
            "POS_ACTIVE_MONTH_RATE": share("NAME_CONTRACT_STATUS = 'Active'"),
        },
    ),
    "credit_card_balance": HistorySet(
        "CC",
        {
            "CC_MONTHS": rows(),
            "CC_CARDS": kinds("SK_ID_PREV"),
            "CC_UTILISATION_MEAN": mean("UTILISATION"),
            "CC_UTILISATION_MAX": highest("UTILISATION"),
            "CC_UTILISATION_MEAN_12M": mean("UTILISATION", _RECENT_MONTH),
            "CC_ATM_DRAWINGS_MEAN": mean("AMT_DRAWINGS_ATM_CURRENT"),
            "CC_PAYMENT_TO_MINIMUM_MEAN": mean("(AMT_PAYMENT_CURRENT / nullif(AMT_INST_MIN_REGULARITY, 0))"),
            "CC_SK_DPD_MAX": highest("SK_DPD"),
            "CC_DPD_MONTH_RATE": share("SK_DPD > 0"),
            "CC_DPD_MONTHS_12M": rows(_LATE_MONTH),
        },
        {"UTILISATION": "AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0)"},
    ),
    "installments_payments": HistorySet(
        "INS",
        {
            "INS_COUNT": rows(),
            "INS_NO_PAYMENT_RECORD": rows("AMT_PAYMENT is null"),
            "INS_DAYS_LATE_MEAN": mean("DAYS_LATE"),
            "INS_DAYS_LATE_MAX": highest("DAYS_LATE"),
            "INS_LATE_RATE": share("DAYS_LATE > 0"),
            "INS_LATE_RATE_12M": share("DAYS_LATE > 0", f"DAYS_INSTALMENT >= -{RECENT_DAYS}"),
            "INS_UNDERPAY_RATE": share(f"AMT_SHORT > {CENT}"),
            "INS_AMT_SHORT_SUM": total("AMT_SHORT"),
            "INS_PAYMENT_RATIO_MEAN": mean("(AMT_PAYMENT / nullif(AMT_INSTALMENT, 0))"),
            "INS_AMT_PAID_SUM": total("AMT_PAYMENT"),
        },
        {"DAYS_LATE": "DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT", "AMT_SHORT": "AMT_INSTALMENT - AMT_PAYMENT"},
    ),
}


def measured(table: DataFrame, key: str, features: Mapping[str, Measure], link: DataFrame | None = None, by: str | None = None) -> DataFrame:
    """One row a ``key`` with the features; with a ``link`` (by, key), rows are reduced by its key ``by`` before they meet it.

    Rows that the link lacks belong to nobody. Distinct counts cannot be merged, so none is allowed with a link."""
    parts = list(dict.fromkeys(p for m in features.values() for p in m.parts))
    names = {p: f"part{i}" for i, p in enumerate(parts)}
    if link is not None and any(kind not in MERGED for kind, _ in parts):
        raise ValueError("distinct counts cannot be merged through a link")
    out = table.groupBy(key if link is None else by).agg(*(PARTS[p[0]](F.expr(p[1])).alias(names[p]) for p in parts))
    if link is not None:
        out = out.join(link.select(by, key), by).groupBy(key).agg(*(MERGED[p[0]](names[p]).alias(names[p]) for p in parts))
    return out.select(key, *(m.value(*(F.col(names[p]) for p in m.parts)).alias(name) for name, m in features.items()))


def history_features(name: str, tables: Mapping[str, DataFrame], row_filters: Mapping[str, str] | None = None) -> DataFrame:
    """The features of one history table; ``row_filters`` say which rows of a table were known at the application."""
    wanted = SETS[name]
    known = lambda t: tables[t].where(F.expr((row_filters or {}).get(t, "true")))
    cleaned = known(name).withColumns({c: F.expr(e) for c, e in wanted.clean.items()})
    link = known(wanted.through) if wanted.through else None
    return measured(cleaned, KEY, wanted.features, link, BUREAU_KEY)


def application_features(train: DataFrame, test: DataFrame, availability: Availability) -> DataFrame:
    """Both populations with the columns that may be used, the cleaned employment and the ratios of amounts.

    Columns of one population only are null in the other; neither the key nor the label is ever a feature."""
    both = train.withColumn("population", F.lit("train")).unionByName(test.withColumn("population", F.lit("test")), allowMissingColumns=True)
    kept = [c for c in availability.usable(train.columns) if c not in (KEY, LABEL, "DAYS_EMPLOYED")]
    part_of = lambda a, b: F.expr(f"cast({a} as double) / nullif(cast({b} as double), 0)")
    both = both.withColumns({"APP_NOT_EMPLOYED_FLAG": F.expr(f"cast(DAYS_EMPLOYED = {NO_DATE} as int)"), "DAYS_EMPLOYED": F.expr(f"nullif(DAYS_EMPLOYED, {NO_DATE})")})
    # The ratios' names
    ratios = {
        "APP_EMPLOYED_TO_AGE": ("DAYS_EMPLOYED", "DAYS_BIRTH"),
        "APP_CREDIT_TO_INCOME": ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "APP_ANNUITY_TO_INCOME": ("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        "APP_ANNUITY_TO_CREDIT": ("AMT_ANNUITY", "AMT_CREDIT"),
        "APP_GOODS_TO_CREDIT": ("AMT_GOODS_PRICE", "AMT_CREDIT"),
        "APP_INCOME_PER_FAMILY_MEMBER": ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
    }
    age = (-F.col("DAYS_BIRTH") / DAYS_A_YEAR).alias("APP_AGE_YEARS")
    return both.select(KEY, "population", LABEL, *kept, "DAYS_EMPLOYED", "APP_NOT_EMPLOYED_FLAG", age, *(part_of(*ab).alias(n) for n, ab in ratios.items()))


def modelling_table(train: DataFrame, test: DataFrame, tables: Mapping[str, DataFrame], availability: Mapping[str, Availability], row_filters: Mapping[str, str] | None = None) -> DataFrame:
    """One row an applicant: the application's columns, the features and the flag of each history that may be used."""
    used = [n for n in SETS if availability[n].use_table]
    parts = [history_features(n, tables, row_filters).withColumn(SETS[n].flag, F.lit(1)) for n in used]
    joined = reduce(lambda a, b: a.join(b, KEY, "left"), parts, application_features(train, test, availability["application_train"]))
    return joined.withColumns({SETS[n].flag: F.coalesce(SETS[n].flag, F.lit(0)) for n in used})
