"""Column expressions: encodings, exact sums, safe ratios, months, bins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,10)"

# Delinquency codes and exit codes of the loan tables.
STATUS_BUCKETS = {"00": "current", "01": "dpd30", "02": "dpd60", "RA": "dpd90plus"}
EXIT_TYPES = {"01": "payoff", "02": "liquidation", "03": "liquidation", "09": "liquidation"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_index(date: Column | str) -> Column:
    """Months since year 0: differences count calendar months whatever the days."""
    d = _col(date)
    return F.year(d) * 12 + F.month(d) - 1


def month(date: Column | str) -> Column:
    """The first day of the month."""
    return F.trunc(_col(date), "MM")


def months_before(date: Column, k: int) -> Column:
    return F.add_months(date, -k)


def days_before(date: Column, k: int) -> Column:
    return F.date_sub(date, k)


def exact_sum(value: Column | str, where: Column | None = None) -> Column:
    """A sum that does not depend on the order of rows: in decimals, returned as double."""
    v = _col(value).cast(EXACT)
    return F.sum(F.when(where, v) if where is not None else v).cast("double")


def exact_avg(value: Column | str, where: Column | None = None) -> Column:
    """A mean from an exact sum; null where nothing is counted."""
    v = _col(value) if where is None else F.when(where, _col(value))
    return exact_sum(v) / F.nullif(F.count(v), F.lit(0))


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, null where den is 0 or null."""
    return _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def rate_of_positive(num: Column | str, den: Column | str) -> Column:
    """num / den, null where den is not positive."""
    return F.when(_col(den) > 0, _col(num).cast("double") / _col(den))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def sentinel_to_null(value: Column | str, sentinel: float) -> Column:
    return F.nullif(_col(value), F.lit(sentinel))


def is_sentinel(value: Column | str, sentinel: float) -> Column:
    return (_col(value) == sentinel).cast("int")


def valid_end(start: Column | str, end: Column | str) -> Column:
    """The end, or null where it lies before the start."""
    return F.when(_col(end) < _col(start), None).otherwise(_col(end))


def status_bucket(status: Column | str) -> Column:
    """Delinquency code -> bucket; numbers from 3 on are 90 days or more, anything unknown is null."""
    code = F.trim(_col(status))
    out = F.when(code.isNull(), None)
    for key, bucket in STATUS_BUCKETS.items():
        out = out.when(code == key, bucket)
    return out.when(code.rlike("^[0-9]{1,9}$") & (code.try_cast("int") >= 3), "dpd90plus")


def exit_type(code: Column | str) -> Column:
    """Zero-balance code -> kind of exit; other codes are other_exit, none is null."""
    c = _col(code)
    out = F.when(c.isNull(), None)
    for key, kind in EXIT_TYPES.items():
        out = out.when(c == key, kind)
    return out.otherwise("other_exit")


def band(value: Column | str, bands: Sequence[tuple[str, float | None, float | None]], missing: str = "missing") -> Column:
    """The label of the first band that holds the value, both ends included; no end is open."""
    v = _col(value)
    out = F.when(v.isNull(), missing)
    for label, low, high in bands:
        inside = F.lit(True)
        if low is not None:
            inside = inside & (v >= low)
        if high is not None:
            inside = inside & (v <= high)
        out = out.when(inside, label)
    return out.otherwise(missing)


def segment_of(date: Column | str, bounds: Mapping[str, tuple[str, str]]) -> Column:
    """The name of the span of dates that holds the date, null where none does."""
    out = None
    for name, (first, last) in bounds.items():
        inside = _col(date).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return out


def regime(date: Column | str, starts: Sequence[tuple[str, str]], first: str) -> Column:
    """Period by the last start date reached."""
    out = F.lit(first)
    for name, start in starts:
        out = F.when(_col(date) >= F.lit(start).cast("date"), name).otherwise(out)
    return out


def vintage(loan_id: Column | str, quarter: bool = False) -> Column:
    """Year (and quarter) of origination from the characters 2-5 of a loan id such as F19Q1..."""
    year = (F.substring(_col(loan_id), 2, 2).cast("int") + 2000).cast("string")
    return F.concat(year, F.substring(_col(loan_id), 4, 2)) if quarter else year


def right_closed_bin(value: Column | str, edges: Sequence[float]) -> Column:
    """Number of inner edges below the value: bins (a, b]."""
    v = _col(value)
    return sum(((v > e).cast("int") for e in edges), F.lit(0))


def left_closed_bin(value: Column | str, edges: Sequence[float]) -> Column:
    """Number of inner edges at or below the value: bins [a, b)."""
    v = _col(value)
    return sum(((v >= e).cast("int") for e in edges), F.lit(0))


def missing_pattern(columns: Sequence[str], none: str = "none") -> Column:
    """The names of the columns that are null, joined by +."""
    names = F.concat_ws("+", *(F.when(F.col(c).isNull(), c) for c in columns))
    return F.when(names == "", none).otherwise(names)


def logit(p: Column | str) -> Column:
    return F.ln(_col(p) / (1 - _col(p)))


def sigmoid(x: Column | str) -> Column:
    return 1 / (1 + F.exp(-_col(x)))


def light(value: Column | str, amber: float, red: float, inclusive: bool = True) -> Column:
    """green, amber or red by thresholds; null stays null."""
    v = _col(value)
    over = (lambda x: v >= x) if inclusive else (lambda x: v > x)
    return F.when(v.isNull(), None).when(over(red), "red").when(over(amber), "amber").otherwise("green")
