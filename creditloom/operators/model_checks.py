"""Checks of early-warning models before their scores are used; tables of bands by score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.exprs import count_if, ratio
from creditloom.operators.checks import check_row, check_rows
from creditloom.operators.metrics import equal_count_bands

EVENT_RATE_SLACK = 0.1


def score_band_table(rows: DataFrame, score: str, y: str, pd: str, key: str, bands: int = 10) -> DataFrame:
    """(band, score_min, score_max, n, bad_rate, pd_mean) of equal-count bands, the lowest scores first."""
    banded = equal_count_bands(rows.select(key, score, y, pd), score, key, bands)
    return banded.groupBy("band").agg(F.min(score).alias("score_min"), F.max(score).alias("score_max"), F.count("*").alias("n"), F.avg(y).alias("bad_rate"), F.avg(pd).alias("pd_mean"))


def coverage(dataset: DataFrame, scores: DataFrame, key: Sequence[str], pds: Sequence[str]) -> DataFrame:
    """One row: the dataset's rows, keys that both tables have exactly once, scored rows, PDs that are no chance."""
    wrong = reduce(lambda a, b: a | b, (~F.coalesce(F.col(p).between(0.0, 1.0) & ~F.isnan(p), F.lit(False)) for p in pds))
    sides = dataset.select(*key, F.lit(1).alias("_d"), F.lit(0).alias("_s"), F.lit(0).alias("_w")).unionByName(scores.select(*key, F.lit(0).alias("_d"), F.lit(1).alias("_s"), wrong.cast("int").alias("_w")))
    by_key = sides.groupBy(*key).agg(*(F.sum(c).alias(c) for c in ("_d", "_s", "_w")))
    known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in key))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return by_key.agg(total("_d").alias("rows"), total("_s").alias("scored"), total("_w").alias("wrong_pds"), count_if(known & (F.col("_d") == 1) & (F.col("_s") == 1)).alias("once"))


def model_checks(
    dataset: DataFrame, scores: DataFrame, key: Sequence[str], pds: Sequence[str], reported: DataFrame, selection: Mapping[str, float], selected: str, sample: DataFrame, target: str, weight: str, monthly: DataFrame, events: DataFrame
) -> DataFrame:
    """(check, claimed, recounted, source, ok).

    ``dataset`` has the key, target and split; ``scores`` the key and PDs; ``reported`` (model, value) the validation metric of
    the report, ``selection`` the values by which ``selected`` was chosen, the simpler model first, which wins ties;
    ``sample`` the weighted training rows; ``monthly`` (split, events) of the monthly lists, ``events`` (split, events) of the
    splits. A model that the report lacks, and a sample without weight, fail."""
    order = list(selection)
    used = dataset.sparkSession.createDataFrame([(i, m, float(v)) for i, (m, v) in enumerate(selection.items())], "place int, model string, used double")
    both = used.join(reported.select("model", "value"), "model", "left")
    apart = F.coalesce(F.abs(F.col("value") - F.col("used")) < 1e-12, F.lit(False))
    chosen = both.agg(count_if(apart).alias("as_used"), F.max_by("place", F.struct("value", -F.col("place"))).alias("best"))
    train = dataset.where("split = 'train'").agg(F.avg(target).alias("rate"))
    weighted = sample.agg(ratio(F.sum(F.col(target) * F.col(weight)), F.sum(weight)).alias("weighted"))
    months = monthly.groupBy("split").agg(F.sum("events").alias("m")).join(events.groupBy("split").agg(F.sum("events").alias("e")), "split", "left")
    listed = months.agg(F.coalesce(F.sum(F.abs(F.col("m") - F.coalesce("e", F.lit(0)))), F.lit(0)).alias("months_apart"))
    row = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), [coverage(dataset, scores, key, pds), chosen, train, weighted, listed])  # one row each
    c, extra = F.col, F.greatest(F.col("scored") - F.col("once"), F.lit(0))
    found = check_rows(
        row, check_row("dataset rows scored once", c("rows"), c("once"), "scores"), check_row("scored rows beside them", F.lit(0), extra, "scores"), check_row("PDs outside 0 to 1", F.lit(0), c("wrong_pds"), "scores"),
        check_row("reported metrics as used", F.lit(len(order)), c("as_used"), "report"), check_row("place of the selected model", F.lit(order.index(selected)), c("best"), "report"),
        check_row("event rate of the weighted sample", c("rate"), c("weighted"), "dataset"), check_row("monthly events apart", F.lit(0), c("months_apart"), "report"),
    )
    near = F.coalesce(F.abs(F.col("recounted") - F.col("claimed")) <= EVENT_RATE_SLACK * F.col("claimed"), F.lit(False)) & (F.col("claimed") > 0)
    return found.withColumn("ok", F.when(F.col("check") == "event rate of the weighted sample", F.coalesce(near, F.lit(False))).otherwise(F.col("ok")))
