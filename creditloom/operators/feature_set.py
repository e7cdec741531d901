"""Early-warning features by name: what each reads, how it is computed, and the dataset that joins them to the labels.

A feature over the panel is an expression over three frames of one window: all of them share one partitioning by loan
and one sort by month, so any number of features costs one pass. No frame reaches beyond the row's own month. A feature
that also needs the loan's origination is finished after that join. Lineage is part of a feature's definition and is
held against an availability matrix before anything is read."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.exprs import band, month_index, ratio, status_bucket
from creditloom.operators.checks import check_row, check_rows
from creditloom.operators.rules import Availability

SCORING = "scoring"
INCOMPLETE = "incomplete_performance_window"
# Months since the last delinquency of a loan without any; flags that count; the order of the buckets
NEVER = 999
MODIFIED, DEFERRED, DISASTER = ("Y", "P"), ("P", "C"), ("Y",)
BUCKETS = ("current", "dpd30", "dpd60", "dpd90plus")


@dataclass(frozen=True)
class Frames:
    """The last months up to the row's own, all rows up to it, and the row's neighbours, in one order."""

    months: Window
    past: Window
    order: Window


@dataclass(frozen=True)
class Feature:
    reads: tuple[str, ...]  # table.column
    over: Callable[[Frames], Column] | None = None  # over the panel, in the one pass
    at: Callable[[Column], Column] | None = None  # after the join, from the panel's part
    categorical: bool = False


def _flag(column: str, values: Sequence[str]) -> Callable[[Frames], Column]:
    return lambda w: F.coalesce(F.col(column).isin(*values), F.lit(False)).cast("int")


def _own(column: str, categorical: bool = False) -> Feature:
    return Feature((f"origination.{column}",), None, lambda _: F.col(f"o.{column}"), categorical)


def _panel(*columns: str) -> tuple[str, ...]:
    return tuple(f"performance.{c}" for c in columns)


_STATUS = _panel("delinquency_status")
ORIGINATION_NUMBERS = ("fico", "orig_ltv", "orig_cltv", "orig_dti", "orig_interest_rate", "orig_upb", "orig_loan_term", "mi_pct", "num_borrowers", "num_units")
ORIGINATION_CLASSES = ("occupancy_status", "loan_purpose", "channel", "property_type", "first_time_homebuyer", "harp_indicator", "property_state")


def registry() -> dict[str, Feature]:
    """All features by name."""
    late, month = F.col("level") >= 1, F.col("month")
    out = {c: _own(c) for c in ORIGINATION_NUMBERS}
    out |= {
        "mob": Feature(_panel("loan_age"), lambda w: F.col("loan_age")),
        "bucket_num": Feature(_STATUS, lambda w: F.col("level")),
        "bucket_change_1m": Feature(_STATUS, lambda w: F.when(F.lag("month").over(w.order) == month - 1, F.col("level") - F.lag("level").over(w.order)).otherwise(0)),
        "months_30plus_window": Feature(_STATUS, lambda w: F.count(F.when(late, 1)).over(w.months)),
        "max_bucket_window": Feature(_STATUS, lambda w: F.max("level").over(w.months)),
        "months_since_delinquent": Feature(_STATUS, lambda w: F.coalesce(month - F.max(F.when(late, month)).over(w.past), F.lit(NEVER))),
        "ever_90plus_before_t": Feature(_STATUS, None, lambda _: F.col("l.ever_bad_before").cast("int")),
        "history_months_window": Feature(_panel("loan_age"), lambda w: F.count("*").over(w.months)),
        "upb_ratio": Feature((*_panel("current_upb"), "origination.orig_upb"), lambda w: F.col("current_upb"), lambda x: ratio(x, F.col("o.orig_upb"))),
        "paydown_window": Feature((*_panel("current_upb"), "origination.orig_upb"), lambda w: F.first("current_upb").over(w.months) - F.col("current_upb"), lambda x: ratio(x, F.col("o.orig_upb"))),
        "rate_change": Feature((*_panel("current_interest_rate"), "origination.orig_interest_rate"), lambda w: F.col("current_interest_rate"), lambda x: x - F.col("o.orig_interest_rate")),
        "non_interest_bearing_share": Feature(_panel("current_non_interest_bearing_upb", "current_upb"), lambda w: F.coalesce(ratio("current_non_interest_bearing_upb", "current_upb"), F.lit(0.0))),
        "assistance_months_window": Feature(_panel("borrower_assistance_plan"), lambda w: F.count("borrower_assistance_plan").over(w.months)),
        "modified": Feature(_panel("modification_flag"), _flag("modification_flag", MODIFIED)),
        "payment_deferral": Feature(_panel("payment_deferral_flag"), _flag("payment_deferral_flag", DEFERRED)),
        "disaster": Feature(_panel("delinquency_due_to_disaster"), _flag("delinquency_due_to_disaster", DISASTER)),
    }
    out |= {c: _own(c, True) for c in ORIGINATION_CLASSES}
    out["assistance_plan_at_t"] = Feature(_panel("borrower_assistance_plan"), lambda w: F.coalesce("borrower_assistance_plan", F.lit("none")), None, True)
    return out


def chosen(names: Sequence[str] | None, matrix: Availability | None = None) -> dict[str, Feature]:
    """The named features, all by default; an error for a name that is unknown or given twice, or for a column that the
    matrix does not allow."""
    known = registry()
    names = list(known) if names is None else list(names)
    if (unknown := sorted(set(names) - set(known))) or len(set(names)) != len(names):
        raise ValueError(f"unknown features {unknown}" if unknown else "a feature is named twice")
    if matrix is not None:
        matrix.gate({n: known[n].reads for n in names})
    return {n: known[n] for n in names}


def lineage(features: Mapping[str, Feature]) -> list[tuple[str, str]]:
    """(feature, table.column), by feature."""
    return sorted((name, column) for name, f in features.items() for column in f.reads)


def panel_features(performance: DataFrame, features: Mapping[str, Feature], months: int) -> DataFrame:
    """(loan_id, period, current_upb, _<feature>): the panel's part of every feature, in one window pass.

    Flags and plans are trimmed, blanks are null; a status that is no code has no level."""
    text = [c for c in ("modification_flag", "payment_deferral_flag", "delinquency_due_to_disaster", "borrower_assistance_plan") if c in performance.columns]
    level = F.array_position(F.array(*map(F.lit, BUCKETS)), status_bucket("delinquency_status")).cast("int") - 1
    rows = performance.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in text} | {"level": level, "month": month_index("period")})
    order = Window.partitionBy("loan_id").orderBy("month")
    frames = Frames(order.rangeBetween(-(months - 1), 0), order.rowsBetween(Window.unboundedPreceding, 0), order)
    return rows.select("loan_id", "period", "current_upb", *(f.over(frames).alias(f"_{name}") for name, f in features.items() if f.over))


def dataset(performance: DataFrame, origination: DataFrame, labels: DataFrame, months: int, scoring_month: date, names: Sequence[str] | None = None, matrix: Availability | None = None,
            bands: Mapping[str, Sequence[tuple]] | None = None) -> DataFrame:
    """Labelled rows of the splits, and the rows to be scored in ``scoring_month``, with their features.

    performance and labels: one row a (loan_id, period); labels: split, regime, y, event_offset, bucket_at_t,
    ever_bad_before, exclusion_reason. A row of the scoring month is scored if nothing but its open window excludes it.
    ``bands`` names bands of origination columns that are carried along."""
    features = chosen(names, matrix)
    scoring = F.col("period") == F.lit(scoring_month)
    asked = (F.col("split").isNotNull() & F.col("y").isNotNull()) | (scoring & (F.col("exclusion_reason").isNull() | (F.col("exclusion_reason") == INCOMPLETE)))
    kept = labels.where(asked).withColumn("scoring_row", scoring).alias("l")
    panel = panel_features(performance, features, months).alias("w")
    joined = kept.join(panel, ["loan_id", "period"]).join(origination.alias("o"), "loan_id", "left")
    finished = [(f.at(F.col(f"w._{n}") if f.over else None) if f.at else F.col(f"w._{n}")).alias(n) for n, f in features.items()]
    split = F.when(F.col("scoring_row") & F.col("l.y").isNull(), SCORING).otherwise(F.col("l.split"))
    context = [split.alias("split"), *(F.col(f"l.{c}") for c in ("regime", "y", "event_offset", "bucket_at_t", "scoring_row")), F.col("w.current_upb").alias("upb")]
    return joined.select("loan_id", "period", *context, *(band(F.col(f"o.{c}"), b).alias(f"{c}_band") for c, b in (bands or {}).items()), *finished)


def dataset_checks(data: DataFrame, labels: DataFrame) -> DataFrame:
    """Checks of a dataset against its labels: rows and events by split, unique keys, rows to score, and their states."""
    known = labels.where("split IS NOT NULL AND y IS NOT NULL").groupBy("split").agg(F.count("*").alias("rows"), F.sum("y").alias("events"))
    got = data.where(F.col("split") != SCORING).groupBy(F.col("split").alias("_split")).agg(F.count("*").alias("_rows"), F.sum("y").alias("_events"))
    both = known.join(got, F.col("split") == F.col("_split"), "full").withColumn("name", F.coalesce("split", "_split"))
    by_split = [
        F.struct(F.concat("name", F.lit(f": {what}")).alias("check"), F.coalesce(F.col(a), F.lit(0)).cast("double").alias("claimed"), F.coalesce(F.col(b), F.lit(0)).cast("double").alias("recounted"), F.lit("labels").alias("source"))
        for what, a, b in (("rows", "rows", "_rows"), ("events", "events", "_events"))
    ]
    splits = both.select(F.explode(F.array(*by_split)).alias("c")).select("c.*").withColumn("ok", F.col("claimed") == F.col("recounted"))
    bad = F.col("scoring_row") & (F.col("bucket_at_t").isNull() | (F.col("bucket_at_t") == BUCKETS[-1]))
    keys = data.groupBy("loan_id", "period").agg(F.count("*").alias("n"), F.max(F.col("scoring_row").cast("int")).alias("scoring"), F.max(bad.cast("int")).alias("bad"))
    sums = keys.agg(F.sum(F.col("n") - 1).alias("again"), F.least(F.coalesce(F.sum("scoring"), F.lit(0)), F.lit(1)).alias("some"), F.sum("bad").alias("bad"))
    zero = F.lit(0)
    return splits.unionByName(check_rows(sums, check_row("repeated keys", zero, F.coalesce("again", zero), "dataset"), check_row("there are rows to score", F.lit(1), F.coalesce("some", zero), "dataset"), check_row("rows to score that are bad or unknown", zero, F.coalesce("bad", zero), "dataset")))
