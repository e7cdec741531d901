"""Flows of a book: who is there at a period's start, leaves, enters and is there at its end; alerts over monthly tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.exprs import count_if, days_before, light, ratio
from creditloom.operators.checks import check_row, check_rows

WORSE = ("higher", "lower")


def flows(panel: DataFrame, key: str, exits: str, before: Callable[[Column, int], Column] = days_before) -> DataFrame:
    """One row a period; ``exits`` is the condition of a row that leaves. start_loans were active in the period just before and report in this one; exits_from_start and
    exits_outside_start leave in it, entries_active are active without having been so before; end_loans are active.

    gone_unseen is the number of active loans of the period before that do not report in this one, null where that
    period is missing. A row whose exit is not known is active. One shuffle by loan; the last window has a row a period."""
    along = Window.partitionBy(key).orderBy("period")
    leaves = F.coalesce(F.expr(exits), F.lit(False))
    seen = panel.select(key, "period", leaves.alias("_exit"))
    was = F.coalesce((F.lag("period").over(along) == before(F.col("period"), 1)) & ~F.lag("_exit").over(along), F.lit(False))
    seen = seen.withColumn("_was", was)
    here, gone = F.col("_was"), F.col("_exit")
    out = seen.groupBy("period").agg(
        count_if(here).alias("start_loans"), count_if(here & gone).alias("exits_from_start"), count_if(~here & gone).alias("exits_outside_start"),
        count_if(~here & ~gone).alias("entries_active"), count_if(~gone).alias("end_loans"),
    )
    by_period = Window.orderBy("period")
    follows = F.lag("period").over(by_period) == before(F.col("period"), 1)
    return out.withColumn("gone_unseen", F.when(follows, F.lag("end_loans").over(by_period) - F.col("start_loans")))


def flow_checks(monthly: DataFrame, panel: DataFrame, exits: str) -> DataFrame:
    """Exits recounted from the rows, the roll-forward identity of every period, and no loan at a start that was not at the end before."""
    c = F.col
    rolled = c("start_loans") - c("exits_from_start") + c("entries_active")
    sums = monthly.agg(F.sum(c("exits_from_start") + c("exits_outside_start")).alias("exits"), count_if(rolled != c("end_loans")).alias("broken"), count_if(c("gone_unseen") < 0).alias("negative"))
    raw = panel.agg(count_if(F.expr(exits)).alias("raw"))
    return check_rows(
        sums.crossJoin(raw), check_row("exits of all periods", c("raw"), c("exits"), "panel"), check_row("end = start - exits + entries", F.lit(0), c("broken"), "flows"),  # one row each
        check_row("periods that begin with more than was left", F.lit(0), c("negative"), "flows"),
    )


def with_flow_rates(book: DataFrame, monthly: DataFrame) -> DataFrame:
    """The book's metrics with the flows' rates of the same period; a period without flows keeps null rates."""
    rates = monthly.select("period", ratio("exits_from_start", "start_loans").alias("exit_rate"), ratio("entries_active", "end_loans").alias("entry_rate"), ratio("gone_unseen", F.col("start_loans") + F.col("gone_unseen")).alias("unseen_rate"))
    return book.join(rates, "period", "left")


def trailing_alerts(table: DataFrame, watched: Mapping[str, str], trailing: int, amber: float, red: float) -> DataFrame:
    """(period, metric, value, baseline, periods_before, change, light): each metric against its mean of the ``trailing``
    periods before it. ``watched`` says of each metric whether higher or lower is worse; a change for the better is green,
    and one that has no baseline, or one of 0, has no light."""
    unknown, wrong = sorted(set(watched) - set(table.columns)), sorted({w for w in watched.values() if w not in WORSE})
    if unknown or wrong:
        raise ValueError(f"unknown metrics: {unknown}" if unknown else f"neither higher nor lower: {wrong}")
    long = table.select("period", *(F.col(m).cast("double").alias(m) for m in watched)).unpivot(["period"], list(watched), "metric", "value")
    w = Window.partitionBy("metric").orderBy("period").rowsBetween(-trailing, -1)
    long = long.withColumns({"baseline": F.avg("value").over(w), "periods_before": F.count("*").over(w)})
    long = long.withColumn("change", ratio("value", "baseline") - 1)
    worse = F.when(F.col("metric").isin(*(m for m, w in watched.items() if w == "lower")), -F.col("change")).otherwise(F.col("change"))
    return long.select("period", "metric", "value", "baseline", "periods_before", "change", light(worse, amber, red, inclusive=False).alias("light"))
