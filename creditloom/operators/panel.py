"""Panels of entities by period: gaps, transitions, books, vintages, concentration."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.exprs import count_if, days_before, exact_sum, rate_of_positive, ratio


def flag_panel(panel: DataFrame, key: str, state: str, bad: Column, before: Callable[[Column, int], Column] = days_before, carried: Sequence[str] = ()) -> DataFrame:
    """Adds bad, ever-bad and first-bad flags and the previous period's values.

    Previous values hold only where the entity's last report is the period just before; has_prev is never null. All
    windows share one partitioning and order, hence one shuffle and one sort."""
    along = Window.partitionBy(key).orderBy("period")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    adjacent = F.coalesce(F.lag("period").over(along) == before(F.col("period"), 1), F.lit(False))
    first_bad = F.min(F.when(bad, F.col("period"))).over(whole)
    seen = panel.select("*", bad.alias("is_bad"), first_bad.alias("_first"), adjacent.alias("has_prev"), *(F.lag(c).over(along).alias(f"_prev_{c}") for c in (state, *carried)))
    flags = {"first_bad": F.coalesce(F.col("period") == F.col("_first"), F.lit(False)), "ever_bad_before": F.coalesce(F.col("period") > F.col("_first"), F.lit(False))}
    flags |= {f"prev_{c}": F.when(F.col("has_prev"), F.col(f"_prev_{c}")) for c in (state, *carried)}
    return seen.withColumns(flags).drop("_first", *(f"_prev_{c}" for c in (state, *carried)))


def transition_counts(flagged: DataFrame, state: str, weight: str | None = None) -> DataFrame:
    """Entities, and their weight before the move, by period, state before and state after."""
    pairs = flagged.where(F.col("has_prev")).groupBy("period", F.col(f"prev_{state}").alias("from_state"), F.col(state).alias("to_state"))
    return pairs.agg(F.count("*").alias("entities"), *([exact_sum(f"prev_{weight}").alias("weight")] if weight else []))


def matrix(counts: DataFrame, weight: str = "entities") -> DataFrame:
    """Transition shares over all periods: each state's moves add up to 1; a state nobody leaves has no rows."""
    total = counts.groupBy("from_state", "to_state").agg(F.sum(weight).alias(weight))
    row = F.sum(weight).over(Window.partitionBy("from_state"))
    return total.withColumn("share", rate_of_positive(weight, row))


def roll_rates(counts: DataFrame, weight: str = "entities") -> DataFrame:
    """By period: the share of movers that got worse, and of the not-best that got better."""
    w = F.col(weight)
    worse, better = F.col("to_state") > F.col("from_state"), F.col("to_state") < F.col("from_state")
    sums = counts.groupBy("period").agg(F.sum(w).alias("total"), F.sum(F.when(worse, w).otherwise(0)).alias("worse"), F.sum(F.when(better, w).otherwise(0)).alias("better"), F.sum(F.when(F.col("from_state") > 0, w).otherwise(0)).alias("exposed"))
    return sums.select("period", "total", ratio("worse", "total").alias("roll_rate"), ratio("better", "exposed").alias("cure_rate"))


def transitions_by_join(panel: DataFrame, key: str, state: str, after: Callable[[Column, int], Column]) -> DataFrame:
    """The same pairs by a self-join on the next period: the second implementation that checks the first."""
    left = panel.select(key, F.col("period"), F.col(state).alias("from_state"))
    right = panel.select(key, F.col("period").alias("next_period"), F.col(state).alias("to_state"))
    paired = left.withColumn("next_period", after(F.col("period"), 1)).join(right, [key, "next_period"])
    return paired.groupBy(F.col("next_period").alias("period"), "from_state", "to_state").agg(F.count("*").alias("entities"))


def monthly_book(panel: DataFrame, state: str, states: Sequence[int], weight: str) -> DataFrame:
    """One row a period: counts and weights by state in one pass, unknown states apart, rates over the known."""
    known = F.col(state).isNotNull()
    aggs = [F.count("*").alias("loans"), count_if(known).alias("known_loans"), count_if(~known).alias("unknown_loans"), exact_sum(weight).alias("weight"), exact_sum(weight, known).alias("known_weight")]
    for s in states:
        aggs += [count_if(F.col(state) == s).alias(f"loans_{s}"), exact_sum(weight, F.col(state) == s).alias(f"weight_{s}")]
    out = panel.groupBy("period").agg(*aggs)
    for s in states:
        out = out.withColumn(f"rate_{s}", ratio(f"loans_{s}", "known_loans"))
    worst = [s for s in states if s >= 2]
    return out.withColumn("rate_2plus", ratio(sum((F.col(f"loans_{s}") for s in worst), F.lit(0)), "known_loans"))


def annualised(monthly_rate: Column | str) -> Column:
    """1 - (1 - rate) ** 12."""
    return 1 - F.pow(1 - (F.col(monthly_rate) if isinstance(monthly_rate, str) else monthly_rate), 12)


def segment_table(rows: DataFrame, dimensions: Sequence[str], aggs: Sequence[Column], by: Sequence[str] = ("period",)) -> DataFrame:
    """The same aggregates for several groupings in one pass: dimensions are unpivoted, then grouped once."""
    pairs = F.array(*(F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("missing")).alias("grp")) for d in dimensions))
    long = rows.withColumn("_p", F.explode(pairs)).select("*", "_p.dimension", "_p.grp").drop("_p")
    return long.groupBy("dimension", "grp", *by).agg(*aggs)


def concentration(shares: DataFrame, weight: str) -> DataFrame:
    """By dimension: Herfindahl index, the largest group and its share."""
    total = F.sum(weight).over(Window.partitionBy("dimension"))
    rows = shares.withColumn("share", rate_of_positive(weight, total))
    top = F.max(F.struct("share", F.col("grp").alias("g")))
    return rows.groupBy("dimension").agg(F.sum(F.pow("share", 2)).alias("hhi"), F.count("*").alias("groups"), top["g"].alias("top_group"), top["share"].alias("top_share"))


def outcomes(panel: DataFrame, key: str, vintage: str, mob: str, bad: Column, paid: Column, amount: str, last: Column) -> DataFrame:
    """One row an entity: first bad and first paid month on book, first month seen, and how far it could be seen."""
    seen = panel.groupBy(key, vintage).agg(
        F.min(F.when(bad, F.col(mob))).alias("default_mob"), F.min(F.when(paid, F.col(mob))).alias("payoff_mob"), F.min(mob).alias("first_mob"),
        F.max("period").alias("last_period"), F.max(mob).alias("last_mob"), F.min_by(amount, "period").alias("amount"),
    )
    return seen.withColumn("reachable_mob", F.col("last_mob") + last).drop("last_period", "last_mob")


def vintage_curves(loans: DataFrame, by: str, mobs: Sequence[int]) -> DataFrame:
    """Cumulative default rate by group and month on book, by count and amount: an event histogram over a spine of
    months, then a running sum; months beyond a group's reach are left out."""
    size = loans.groupBy(by).agg(F.count("*").alias("loans"), exact_sum("amount").alias("total"), F.max("reachable_mob").alias("reach"))
    events = loans.where("default_mob is not null").groupBy(by, F.col("default_mob").alias("mob")).agg(F.count("*").alias("n"), exact_sum("amount").alias("a"))
    spine = size.withColumn("mob", F.explode(F.array(*(F.lit(m) for m in mobs)))).where("mob <= reach")
    run = Window.partitionBy(by).orderBy("mob").rowsBetween(Window.unboundedPreceding, 0)
    joined = spine.join(events, [by, "mob"], "left")
    out = joined.withColumn("defaults", F.sum(F.coalesce("n", F.lit(0))).over(run)).withColumn("defaulted", F.sum(F.coalesce("a", F.lit(0.0))).over(run))
    return out.select(by, "mob", "loans", "defaults", ratio("defaults", "loans").alias("rate_count"), ratio("defaulted", "total").alias("rate_amount"))


def quantile_row(values: DataFrame, by: str, value: str, q: float, lower: bool = True) -> DataFrame:
    """By group, the value at sorted position floor (or ceil) of q * (n - 1): no interpolation."""
    order = Window.partitionBy(by).orderBy(value)
    n = F.count("*").over(Window.partitionBy(by))
    place = q * (n - 1)
    at = F.floor(place + F.lit(1e-9)) if lower else F.ceil(place - F.lit(1e-9))
    return values.where(F.col(value).isNotNull()).withColumn("_r", F.row_number().over(order) - 1).withColumn("_at", at).where("_r = _at").select(by, F.col(value).alias("quantile"))
