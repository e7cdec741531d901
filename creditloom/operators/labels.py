"""Look-ahead labels and look-back features of a panel."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def label_windows(panel: DataFrame, key: str, state: str, horizon: int, after: Callable[[Column, int], Column], bad: str = "B", paid: str = "P", unknown: str = "X", active: str = "N", exclude_prior_bad: bool = False) -> DataFrame:
    """Label of each (entity, period): does it turn bad within ``horizon`` periods?

    Month k ahead is the row among the next ones whose date is exactly k periods later; a month without a row is a gap.
    The first informative month decides: bad gives 1, an exit without loss 0, a gap or an unknown state leaves the label
    open; active months throughout give 0. Rows at or after an exit, at a bad month, of unknown state and, if asked for,
    after a bad month are excluded with a reason. (key, period) must be unique."""
    along = Window.partitionBy(key).orderBy("period")
    # the same order with a full frame: all of it is one window over one sort
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = lambda s: F.min(F.when(F.col(state) == s, F.col("period"))).over(whole)
    steps = range(1, horizon + 1)
    ahead_of = [c for j in steps for c in (F.lead("period", j).over(along).alias(f"_p{j}"), F.lead(state, j).over(along).alias(f"_s{j}"))]
    led = panel.select("*", first(bad).alias("_bad"), first(paid).alias("_exit"), *ahead_of)
    led = led.withColumn("ever_bad_before", F.coalesce(F.col("period") > F.col("_bad"), F.lit(False)))
    ahead = []
    for k in steps:
        target = after(F.col("period"), k)
        month = F.lit(None).cast("string")
        for j in range(k, 0, -1):
            month = F.when(F.col(f"_p{j}") == target, F.col(f"_s{j}")).otherwise(month)
        ahead.append(month)
    y, offset = F.lit(0), F.lit(None).cast("int")
    for k in reversed(steps):
        m = ahead[k - 1]
        y = F.when(m == bad, 1).when(m == paid, 0).when(m == active, y)
        offset = F.when(m == bad, k).when(m == active, offset)
    status = F.col(state)
    blocked = F.when(F.coalesce(F.col("period") >= F.col("_exit"), F.lit(False)), "inactive_at_t").when(status == bad, "already_bad_at_t").when(status == unknown, "status_not_available_at_t")
    if exclude_prior_bad:
        blocked = blocked.when(F.col("ever_bad_before"), "prior_bad_excluded")
    out = led.withColumn("y", F.when(blocked.isNull(), y).cast("int")).withColumn("event_offset", F.when(blocked.isNull(), offset))
    out = out.withColumn("exclusion_reason", F.coalesce(blocked, F.when(F.col("y").isNull(), "incomplete_performance_window")))
    return out.drop("_bad", "_exit", *(f"_{x}{j}" for x in "ps" for j in steps))


def next_bad_within(panel: DataFrame, key: str, bad: Column, rows: int) -> DataFrame:
    """Whether any of the next ``rows`` reported rows is bad."""
    frame = Window.partitionBy(key).orderBy("period").rowsBetween(1, rows)
    return panel.withColumn("next_bad", F.coalesce(F.max(bad.cast("int")).over(frame), F.lit(0)))


def event_rows(labelled: DataFrame, panel: DataFrame, key: str, after_column: Callable[[Column, Column], Column], keep: list[str]) -> DataFrame:
    """The panel row at period + event_offset of each positive label: an equi-join on a computed period."""
    left = labelled.where("y = 1").withColumn("event_period", after_column(F.col("period"), F.col("event_offset")))
    right = panel.select(key, F.col("period").alias("event_period"), *(F.col(c).alias(f"event_{c}") for c in keep))
    return left.join(right, [key, "event_period"], "left")


def look_back(panel: DataFrame, key: str, index: Column, length: int, features: Mapping[str, Callable[[object], Column]]) -> DataFrame:
    """Features over the last ``length`` periods up to the current one, by calendar, not by row.

    ``index`` numbers periods; a feature is a function of the window. No frame reaches beyond the current row."""
    frame = Window.partitionBy(key).orderBy(index).rangeBetween(-(length - 1), 0)
    return panel.select("*", *(make(frame).alias(name) for name, make in features.items()))


def since_last(panel: DataFrame, key: str, event: Column, index: Column) -> Column:
    """Periods since the event last happened, up to now; null where it never has."""
    frame = Window.partitionBy(key).orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    return index - F.max(F.when(event, index)).over(frame)


def label_by_join(panel: DataFrame, key: str, state: str, horizon: int, after: Callable[[Column, int], Column]) -> DataFrame:
    """The labels of :func:`label_windows` by one self-join on the month ahead: the second implementation.

    Each row asks for its next ``horizon`` months; what is found is folded in order, the first informative one decides."""
    ask = panel.select(key, "period", state, F.explode(F.array(*(F.lit(k) for k in range(1, horizon + 1)))).alias("k"))
    month = panel.select(key, F.col("period").alias("_ahead"), F.col(state).alias("_state"))
    target = F.coalesce(*(F.when(F.col("k") == k, after(F.col("period"), k)) for k in range(1, horizon + 1)))
    seen = ask.withColumn("_ahead", target).join(month, [key, "_ahead"], "left")
    decided = seen.where(F.col("_state").isNull() | (F.col("_state") != "N"))
    first = decided.groupBy(key, "period").agg(F.min(F.struct("k", "_state")).alias("m"))
    exits = panel.where(F.col(state) == "P").groupBy(key).agg(F.min("period").alias("_exit"))
    out = panel.select(key, "period", state).join(first, [key, "period"], "left").join(exits, key, "left")
    blocked = F.coalesce(F.col("period") >= F.col("_exit"), F.lit(False)) | F.col(state).isin("B", "X")
    y = F.when(F.col("m").isNull(), 0).when(F.col("m._state") == "B", 1).when(F.col("m._state") == "P", 0)
    return out.select(key, "period", F.when(~blocked, y).alias("y"))
