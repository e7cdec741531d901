"""Reconciliation of a development population: what is stated about it against one recount of its tables.

All tables meet once, in one grouping by id; an id has about one row in each table, so rows go to the task of their id as
they are and no task of a table's scan holds counts of all ids it reads; sizes, rates by split, duplicates and
every kind of missing row follow from the counts an id has in each table, so no pair of tables is joined. What leaves
the grouping is one row."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.exprs import count_if, ratio
from creditloom.operators.sampling import split_fingerprint

SPLITS = ("train", "validation", "test")
STATED = "figure string, source string, value double, text string"


@dataclass(frozen=True)
class Tolerances:
    """How far a stated number may be from the recount, by kind of figure."""

    rows: float = 0.0
    bad_rate: float = 1e-6
    share: float = 1e-3

    def __post_init__(self):
        if min(self.rows, self.bad_rate, self.share) < 0:
            raise ValueError("tolerances of a population must not be negative")


def recount(train: DataFrame, test: DataFrame, features: DataFrame, splits: DataFrame, published: DataFrame, key: str, target: str, split: str) -> DataFrame:
    """One row of counts. ``train`` has key and target, ``splits`` and ``published`` key and split, the others the key.

    A null key equals no other, as in a join. Empty tables count as zero, rates of nothing are null."""
    tables = {"train": train, "test": test, "features": features, "splits": splits, "published": published}
    no_split, no_target = F.lit(None).cast("string"), F.lit(None).cast("double")
    rows = [
        df.select(F.col(key).alias("id"), F.lit(name).alias("part"), (F.col(split) if name in ("splits", "published") else no_split).alias("split"), (F.col(target).cast("double") if name == "train" else no_target).alias("y"))
        for name, df in tables.items()
    ]
    part, of = F.col("part"), F.col("split")
    sums = [count_if(part == name).alias(f"n_{name}") for name in tables]
    sums += [count_if((part == p) & (of == s)).alias(f"{p}_{s}") for p in ("splits", "published") for s in SPLITS]
    sums += [count_if((part == p) & of.isNull()).alias(f"{p}_none") for p in ("splits", "published")]
    parts = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_id = reduce(DataFrame.unionByName, rows).repartition(parts, "id").groupBy("id").agg(*sums, F.count("y").alias("known"), F.sum("y").alias("bads"))

    c = F.col
    total = lambda col: F.coalesce(F.sum(col), F.lit(0))
    lacks = lambda name: (c(f"n_{name}") == 0) | c("id").isNull()
    where = lambda cond, rows: total(F.when(cond, rows).otherwise(0))
    unique = lambda name: count_if((c(f"n_{name}") > 0) & c("id").isNotNull())
    found = {f"rows/{name}": total(f"n_{name}") for name in tables}
    for s in SPLITS:
        found |= {f"rows/split/{s}": total(f"splits_{s}"), f"published/split/{s}": total(f"published_{s}")}
        found[f"bad_rate/split/{s}"] = ratio(F.sum(c(f"splits_{s}") * c("bads")), F.sum(c(f"splits_{s}") * c("known")))
    found |= {
        "published/without split": total("published_none"), "published/duplicates": total("n_published") - count_if(c("n_published") > 0), "bad_rate/overall": ratio(F.sum("bads"), F.sum("known")),
        "exclusion/train rows without target": total(c("n_train") - c("known")), "exclusion/duplicate train ids": total("n_train") - unique("train"), "exclusion/duplicate test ids": total("n_test") - unique("test"),
        "exclusion/train rows without split": total(c("n_train") * F.when(lacks("splits"), 1).otherwise(c("splits_none"))), "exclusion/split rows outside train": where(lacks("train"), c("n_splits")),
        "exclusion/ids in several splits": count_if(c("n_splits") > 1), "exclusion/train rows without features": where(lacks("features"), c("n_train")), "exclusion/test rows without features": where(lacks("features"), c("n_test")),
        "exclusion/feature rows of no applicant": where(c("id").isNull() | (lacks("train") & lacks("test")), c("n_features")),
    }
    counted = by_id.agg(*(col.cast("double").alias(name) for name, col in found.items()))
    return counted.crossJoin(F.broadcast(split_fingerprint(splits, key, split)))  # one row each


def _close(claimed: Column, recounted: Column, tolerance: Column) -> Column:
    return F.coalesce(F.abs(claimed - recounted) <= tolerance, F.lit(False))


def reconcile(counts: DataFrame, stated: DataFrame, fractions: Mapping[str, float], tolerances: Tolerances = Tolerances(), stratified: bool = True) -> DataFrame:
    """(figure, source, claimed, recounted, claimed_text, recounted_text, ok), one row a check.

    ``stated`` (figure, source, value, text) holds what models, packages and summaries say of figures of the recount, some
    dozens of rows; a figure that the recount lacks, or a missing value on either side, fails. The other checks follow from
    the recount: published rows cover the population once, splits have their fractions and, where stratified, the overall
    bad rate, and nobody is excluded."""
    c = lambda name: F.col(f"`{name}`")
    rows_tol, share_tol = F.lit(float(tolerances.rows)), F.lit(float(tolerances.share))
    no_text = F.lit(None).cast("string")

    def entry(figure: Column, source: Column, claimed: Column, recounted: Column, texts: tuple[Column, Column], ok: Column) -> Column:
        named = {"figure": figure, "source": source, "claimed": claimed.cast("double"), "recounted": recounted.cast("double"), "claimed_text": texts[0], "recounted_text": texts[1], "ok": ok}
        return F.struct(*(col.alias(name) for name, col in named.items()))

    def row(figure: str, source: str, claimed: Column, recounted: Column, tol: Column) -> Column:
        return entry(F.lit(figure), F.lit(source), claimed, recounted, (no_text, no_text), _close(claimed, recounted, tol))

    own = [row(f"published/split/{s}", "published scores", c(f"published/split/{s}"), c(f"rows/split/{s}"), rows_tol) for s in SPLITS]
    own.append(row("published/without split", "published scores", c("published/without split"), c("rows/test"), rows_tol))
    own.append(row("published/rows", "published scores", c("rows/published"), c("rows/train") + c("rows/test"), rows_tol))
    own.append(row("published/duplicates", "published scores", c("published/duplicates"), F.lit(0), F.lit(0)))
    for s in SPLITS:
        share = F.round(ratio(c(f"rows/split/{s}"), c("rows/splits")), 6)
        own.append(row(f"share/split/{s}", "split design", F.lit(fractions.get(s)), share, share_tol))
    for s in SPLITS if stratified else ():
        applicant = 1 / F.greatest(c(f"rows/split/{s}"), F.lit(1.0))  # a split's rate cannot be nearer than one applicant
        own.append(row(f"bad_rate/split/{s}", "stratified", F.round(c("bad_rate/overall"), 6), F.round(c(f"bad_rate/split/{s}"), 6), F.greatest(F.lit(float(tolerances.bad_rate)), applicant)))
    own += [row(name, "no exclusions", F.lit(0), c(name), F.lit(0)) for name in counts.columns if name.startswith("exclusion/")]

    numbers = [name for name in counts.columns if name != "fingerprint"]
    known = F.map_from_arrays(F.array(*(F.lit(n) for n in numbers)), F.array(*(c(n) for n in numbers)))

    def said(s: Column) -> Column:
        finger, of = s["figure"] == "split fingerprint", F.try_element_at("known", s["figure"])
        tol = F.when(s["figure"].startswith("bad_rate/"), float(tolerances.bad_rate)).when(s["figure"].startswith("exclusion/"), 0.0).otherwise(rows_tol)
        ok = F.when(finger, F.coalesce(s["text"] == F.col("fingerprint"), F.lit(False))).otherwise(_close(s["value"], of, tol))
        return entry(s["figure"], s["source"], s["value"], of, (F.when(finger, s["text"]), F.when(finger, F.col("fingerprint"))), ok)

    all_stated = stated.agg(F.collect_list(F.struct("figure", "source", "value", "text")).alias("stated"))
    one_row = counts.crossJoin(F.broadcast(all_stated)).select(F.array(*own).alias("own"), known.alias("known"), "fingerprint", "stated")
    return one_row.select(F.explode(F.concat("own", F.transform("stated", said))).alias("r")).select("r.*")
