"""Competing-risk survival with delayed entry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def survival_tables(loans: DataFrame, by: Sequence[str], last: int, min_at_risk: int = 1) -> DataFrame:
    """By group and month 0..last: risk set, hazards, Kaplan-Meier default and cumulative incidences.

    ``loans`` has entry, time and cause (0 censored, 1 default, 2 payoff). Who enters at a month is at risk in it; who
    leaves at it is, too. Products are folds over the months of a group, so hazards of 1 need no logarithm."""
    sides = loans.select(*by, F.explode(F.array(F.struct(F.col("entry").alias("mob"), F.lit(-1).alias("what")), F.struct(F.col("time").alias("mob"), F.col("cause").alias("what")))).alias("e")).select(*by, "e.*")
    counts = sides.groupBy(*by, "mob").agg(*(F.count(F.when(F.col("what") == k, 1)).alias(n) for k, n in ((-1, "entering"), (0, "censored"), (1, "defaults"), (2, "payoffs"))))
    groups = loans.groupBy(*by).agg(F.min("entry").alias("first"), F.max("time").alias("end"))
    spine = groups.withColumn("mob", F.explode(F.sequence(F.lit(0), F.least("end", F.lit(last)))))
    rows = spine.join(counts, [*by, "mob"], "left").na.fill(0, ["entering", "censored", "defaults", "payoffs"])
    run = Window.partitionBy(*by).orderBy("mob").rowsBetween(Window.unboundedPreceding, 0)
    leaving = F.col("censored") + F.col("defaults") + F.col("payoffs")
    rows = rows.withColumn("at_risk", F.sum("entering").over(run) - F.sum(leaving).over(run) + leaving)
    hazard = lambda n: F.when(F.col("at_risk") > 0, F.col(n) / F.col("at_risk")).otherwise(0.0)
    rows = rows.withColumn("hd", hazard("defaults")).withColumn("hp", hazard("payoffs"))
    history = F.collect_list(F.struct("hd", "hp")).over(run)
    start = F.struct(F.lit(1.0).alias("km"), F.lit(1.0).alias("s"), F.lit(0.0).alias("cd"), F.lit(0.0).alias("cp"))
    fold = F.aggregate("_h", start, lambda a, x: F.struct((a["km"] * (1 - x["hd"])).alias("km"), (a["s"] * (1 - x["hd"] - x["hp"])).alias("s"), (a["cd"] + a["s"] * x["hd"]).alias("cd"), (a["cp"] + a["s"] * x["hp"]).alias("cp")))
    out = rows.withColumn("_h", history).withColumn("_f", fold).where("mob >= first")
    thin = F.max((F.col("at_risk") < min_at_risk).cast("int")).over(run)
    out = out.withColumn("_thin", thin).where("_thin = 0")
    return out.select(*by, "mob", "at_risk", "defaults", "payoffs", "censored", F.col("hd").alias("hazard_default"), F.col("hp").alias("hazard_payoff"), (1 - F.col("_f.km")).alias("km_default"), F.col("_f.s").alias("survival"), F.col("_f.cd").alias("cif_default"), F.col("_f.cp").alias("cif_payoff"))
