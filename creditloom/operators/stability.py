"""Stability of scores and features: every PSI against a reference sample from one grouped count of values.

Rows are exploded to one per watched column and counted by value, segment and sample, once; a column that several models
watch is counted once. All that follows reads those counts: the edges, which are exact quantiles of the reference, found
range by range for all columns and segments together, and the labels: the bin of a value, or the level."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.exprs import count_if, light, ratio
from creditloom.operators.order_stats import quantiles_of_counts
from creditloom.session import saved

ALL = "all"
MISSING, OTHER = "missing", "other"
KINDS = ("output", "feature")
_OF = ["kind", "model", "name", "segment"]


@dataclass(frozen=True)
class Watched:
    kind: str  # output: by segment too; feature: as a whole
    model: str
    column: str

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"{self.column}: unknown kind {self.kind}")


def is_categorical(rows: DataFrame, column: str) -> bool:
    """Levels are compared for everything but numbers; booleans have levels."""
    return not isinstance(rows.schema[column].dataType, T.NumericType)


def label_counts(rows: DataFrame, sample: str, reference: str, currents: Sequence[str], watched: Sequence[Watched], segment: str | None = None, bins: int = 10) -> DataFrame:
    """(kind, model, name, segment, current, label, n_reference, n_current, missing): one shuffle of partial counts.

    Levels that the reference lacks are pooled as other. A segment is compared where both samples have rows of it."""
    samples = [reference, *currents]
    rows = rows.where(F.col(sample).isin(*samples))
    if rows.where(F.col(sample) == reference).isEmpty():
        raise ValueError(f"no rows of the reference {reference}")
    columns = list(dict.fromkeys(w.column for w in watched))
    split = {w.column for w in watched if segment and w.kind == "output"}
    no_text = F.lit(None).cast("string")

    def cell(c: str) -> Column:
        level = F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) if is_categorical(rows, c) else no_text
        number = F.lit(None) if is_categorical(rows, c) else F.col(c)
        return F.struct(F.lit(c).alias("name"), F.col(segment).cast("string").alias("segment") if c in split else no_text.alias("segment"), number.cast("double").alias("_v"), level.alias("level"), F.col(c).isNull().alias("gap"))

    cells = rows.select(F.col(sample).alias("_s"), F.explode(F.array(*map(cell, columns))).alias("x")).select("_s", "x.*")
    values = saved(cells.groupBy("name", "segment", "_v", "level", "gap").agg(*(count_if(F.col("_s") == s).alias(f"n_{i}") for i, s in enumerate(samples))))
    # a segment's counts serve the segment and the whole
    both = F.when(F.col("name").isin(list(split)) & F.col("segment").isNotNull(), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    values = values.withColumn("own", F.explode(both)).withColumn("segment", F.when(F.col("own"), F.col("segment")).otherwise(ALL))
    of = ["name", "own", "segment"]
    numbers = values.where("level is null and _v is not null and n_0 > 0").select(*of, "_v", F.col("n_0").alias("_n"))
    edges = quantiles_of_counts(numbers, "edge", [i / bins for i in range(1, bins)], of).groupBy(*of).agg(F.collect_set("edge").alias("edges"))  # bins - 1 numbers a column and segment
    placed = values.where("level is null").join(F.broadcast(edges), of, "left").where(~F.col("own") | F.col("edges").isNotNull())  # a segment that the reference lacks has no bins
    bin_of = F.size(F.filter(F.coalesce("edges", F.array().cast("array<double>")), lambda e: e <= F.col("_v"))).cast("string")
    labels = placed.withColumn("label", F.when(F.col("_v").isNull(), MISSING).otherwise(bin_of)).drop("edges").unionByName(values.where("level is not null").withColumn("label", F.col("level")))
    sums = [F.sum(f"n_{i}").alias(f"n_{i}") for i in range(len(samples))] + [F.coalesce(F.sum(F.when(F.col("gap"), F.col(f"n_{i}"))), F.lit(0)).alias(f"gap_{i}") for i in range(len(samples))]
    found = labels.groupBy(*of, "label", F.col("level").isNotNull().alias("levels")).agg(*sums)
    each = F.array(*(F.struct(F.lit(w.kind).alias("kind"), F.lit(w.model).alias("model"), F.lit(w.column).alias("column")) for w in watched))
    mine = F.filter(each, lambda w: (w["column"] == F.col("name")) & (~F.col("own") | (w["kind"] == "output")))
    counts = found.withColumn("w", F.explode(mine)).select("w.kind", "w.model", "name", "segment", "label", "levels", *(f"{n}_{i}" for n in ("n", "gap") for i in range(len(samples))))
    counts = counts.withColumn("label", F.when(F.col("levels") & (F.col("n_0") == 0), OTHER).otherwise(F.col("label")))
    pairs = F.array(*(F.struct(F.lit(s).alias("current"), F.col(f"n_{i}").alias("n_current"), F.col(f"gap_{i}").alias("gap_current")) for i, s in enumerate(samples) if i))
    wide = counts.select(*_OF, "label", F.col("n_0").alias("n_reference"), F.col("gap_0").alias("gap_reference"), F.explode(pairs).alias("c")).select(*_OF, "c.current", "label", "n_reference", "gap_reference", "c.n_current", "c.gap_current")
    sums = [F.sum(c).alias(c) for c in ("n_reference", "gap_reference", "n_current", "gap_current")]
    return wide.groupBy(*_OF, "current", "label").agg(*sums)


def stability(counts: DataFrame, epsilon: float = 1e-4, amber: float = 0.1, red: float = 0.25) -> DataFrame:
    """(kind, model, name, segment, current, n_reference, n_current, missing_reference, missing_current, psi, light)."""
    of = Window.partitionBy(*_OF, "current")
    part = lambda n: F.greatest(ratio(n, F.sum(n).over(of)), F.lit(epsilon))
    shares = counts.withColumns({"_p": part("n_reference"), "_q": part("n_current")})
    sums = {c: F.sum(c).alias(c) for c in ("n_reference", "n_current")}
    gaps = [ratio(F.sum(f"gap_{c}"), F.sum(f"n_{c}")).alias(f"missing_{c}") for c in ("reference", "current")]
    out = shares.groupBy(*_OF, "current").agg(*sums.values(), *gaps, F.sum((F.col("_q") - F.col("_p")) * F.ln(F.col("_q") / F.col("_p"))).alias("psi"))
    return out.where("n_reference > 0 and n_current > 0").withColumn("light", F.when(F.col("psi") > red, "red").otherwise(light("psi", amber, float("inf"))))


def stability_checks(table: DataFrame, later: str, stable_below: float, published: DataFrame | None = None, tolerance: float = 1e-6) -> DataFrame:
    """Samples of the reference's own time must be stable, and published PSIs (model, segment, psi) of the outputs against
    the sample ``later`` must be what is found; a published one that is not found fails."""
    named = lambda *parts: F.concat_ws(" ", *(F.lit(p) if isinstance(p, str) else p for p in parts))
    c = F.col
    same = table.where((c("segment") == ALL) & (c("current") != later))
    out = [same.select(named("stable:", c("model"), c("name"), c("current")).alias("check"), F.lit(0.0).alias("claimed"), c("psi").alias("recounted"), F.lit("recount").alias("source"), F.coalesce(c("psi") <= stable_below, F.lit(False)).alias("ok"))]
    if published is not None:
        ours = table.where((c("kind") == "output") & (c("current") == later)).select("model", "segment", F.col("psi").alias("_found"))
        both = published.join(ours, ["model", "segment"], "left")
        ok = F.coalesce(F.abs(c("psi") - c("_found")) <= tolerance, F.lit(False))
        out.append(both.select(named("published:", c("model"), c("segment")).alias("check"), c("psi").alias("claimed"), c("_found").alias("recounted"), F.lit("published").alias("source"), ok.alias("ok")))
    return reduce(DataFrame.unionByName, out)
