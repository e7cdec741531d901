"""Bootstrap of several models on the same rows, and what follows from it: intervals, paired differences, gaps of splits.

Rows are reduced to cells, counts by class and all models' scores and PDs. Every row is drawn a Poisson(1) number of
times, so a cell of n rows Poisson(n) times, which is the bootstrap for data that cannot meet in one task: cells are
drawn independently, by a generator keyed by the cell itself and the seed, and any task that needs a cell has the same
draws. Resamples are stratified in that AUC, Gini and KS do not depend on how many rows of each class come; one
resample gives all models the same draws, so their differences are paired.

For each model the cells are dealt into ranges of its score. A range's task reduces its cells, some thousands at a
time, to bads, goods, won pairs and squared errors of each resample; sums of the ranges before it then give AUC, and a
second pass with these sums gives KS. What meets in one task is a range, or one row a range and resample."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.exprs import ratio
from creditloom.operators.order_stats import in_ranges
from creditloom.session import saved, ship

METRICS = ("auc", "gini", "ks", "brier")
CELLS_A_TURN = 4096


def cell_draws(keys: np.ndarray, n: np.ndarray, resamples: int) -> np.ndarray:
    """How often each cell is drawn in each resample; column 0 is the data itself."""
    out = np.empty((len(n), resamples + 1), np.int64)
    out[:, 0] = n
    for row, key, count in zip(out, keys, n, strict=True):
        row[1:] = np.random.Generator(np.random.Philox(key=int(key) & (1 << 64) - 1)).poisson(count, resamples)
    return out


def by_score(cells: pa.Table, resamples: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bads and goods (scores x resamples) of some scores at a time, in ascending order, and squared errors by resample."""
    cells = cells.sort_by([("s", "ascending"), ("key", "ascending")])
    score, key, n, y, p = (cells[c].to_numpy() for c in ("s", "key", "n", "y", "p"))
    held = None
    for at in range(0, len(score), CELLS_A_TURN):
        turn = slice(at, at + CELLS_A_TURN)
        drawn = cell_draws(key[turn], n[turn], resamples)
        here, bad = score[turn], y[turn, None]
        head = np.flatnonzero(np.append(True, here[1:] != here[:-1]))
        bads, goods = np.add.reduceat(drawn * bad, head), np.add.reduceat(drawn * (1 - bad), head)
        if held is not None:  # the last score of the turn before may go on
            if held[0] == here[0]:
                bads[0] += held[1]
                goods[0] += held[2]
            else:
                bads, goods = np.vstack([held[1][None], bads]), np.vstack([held[2][None], goods])
        errors = ((p[turn] - y[turn]) ** 2) @ drawn
        last = at + CELLS_A_TURN >= len(score)
        held = (here[-1], bads[-1], goods[-1])
        yield (bads, goods, errors) if last else (bads[:-1], goods[:-1], errors)


def _fields(df: DataFrame, names: Sequence[str]) -> str:
    return "".join(f"{f.name} {f.dataType.simpleString()}, " for f in df.schema if f.name in names)


def _table(group: pa.Table, by: Sequence[str], columns: Mapping[str, np.ndarray]) -> pa.Table:
    """One row a resample, with the group's keys."""
    size = len(next(iter(columns.values())))
    keys = {k: pa.chunked_array([group[k].slice(0, 1)]).combine_chunks().take(pa.array(np.zeros(size, np.int64))) for k in by}
    return pa.table({**keys, **{c: pa.array(v) for c, v in columns.items()}})


def replicates(rows: DataFrame, models: Mapping[str, tuple[str, str]], y: str, by: Sequence[str] = (), resamples: int = 200, seed: int = 7, parts: int | None = None) -> DataFrame:
    """(by, model, replicate, metric, value, n, bads): the metrics of each resample; replicate 0 is the data itself.

    ``models`` names each model's columns of risk and PD. Rows without a class, or without a score of some model, take no
    part, so that all models are measured on the same rows. A resample of one class has no AUC, Gini and KS."""
    ship(rows.sparkSession)
    columns = list(dict.fromkeys(c for pair in models.values() for c in pair))
    complete = rows.dropna(subset=[y, *columns])
    cells = complete.groupBy(*by, F.col(y).cast("int").alias("y"), *columns).agg(F.count("*").alias("n"))
    cells = saved(cells.withColumn("key", F.xxhash64(F.lit(seed), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in by), "y", *columns)))
    out = None
    for model, (risk, pd) in models.items():
        mine = cells.select(*by, "key", "n", "y", F.col(risk).cast("double").alias("s"), F.col(pd).cast("double").alias("p"))
        found = _of_model(in_ranges(mine, ["s"], by, parts), by, resamples).withColumn("model", F.lit(model))
        out = found if out is None else out.unionByName(found)
    values = F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS))
    return saved(out.select(*by, "model", "replicate", F.explode(values).alias("_v"), (F.col("bads") + F.col("goods")).alias("n"), "bads").select(*by, "model", "replicate", "_v.metric", "_v.value", "n", "bads"))


def _of_model(ranged: DataFrame, by: Sequence[str], resamples: int) -> DataFrame:
    keys = [*by, "_part"]

    def sums(cells: pa.Table) -> pa.Table:
        size = resamples + 1
        bads, goods, wins, errors = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
        for bad, good, wrong in by_score(cells, resamples):
            below = goods + good.cumsum(axis=0) - good
            wins += (bad * (below + good / 2)).sum(axis=0)
            bads, goods, errors = bads + bad.sum(axis=0), goods + good.sum(axis=0), errors + wrong
        return _table(cells, keys, {"replicate": np.arange(size), "bads": bads, "goods": goods, "wins": wins, "errors": errors})

    kind = f"{_fields(ranged, by)}_part int, replicate long, bads long, goods long, wins double, errors double"
    totals = saved(ranged.groupBy(*keys).applyInArrow(sums, kind))  # one row a range and resample
    group = [*by, "replicate"]
    ahead = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    before = [F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"{c}_before") for c in ("bads", "goods")]
    placed = totals.select(*keys, "replicate", "bads", "goods", "wins", "errors", *before, *(F.sum(c).over(whole).alias(f"{c}_all") for c in ("bads", "goods")))

    def gaps(cells: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("replicate")
        bads, goods, all_bads, all_goods = (known[c].to_numpy().astype(np.float64) for c in ("bads_before", "goods_before", "bads_all", "goods_all"))
        gap = np.zeros(resamples + 1)
        for bad, good, _ in by_score(cells, resamples):
            up_bad, up_good = bads + bad.cumsum(axis=0), goods + good.cumsum(axis=0)
            apart = np.abs(up_good / np.maximum(all_goods, 1) - up_bad / np.maximum(all_bads, 1))
            if len(apart):
                gap, bads, goods = np.maximum(gap, apart.max(axis=0)), up_bad[-1], up_good[-1]
        return _table(cells, by, {"replicate": np.arange(resamples + 1), "ks": gap})

    offsets = placed.select(*keys, "replicate", "bads_before", "goods_before", "bads_all", "goods_all")
    ks = ranged.groupBy(*keys).cogroup(offsets.groupBy(*keys)).applyInArrow(gaps, f"{_fields(ranged, by)}replicate long, ks double")
    won = F.sum(F.col("wins") + F.col("bads") * F.col("goods_before").cast("double"))
    whole_rows = placed.groupBy(*group).agg(F.sum("bads").alias("bads"), F.sum("goods").alias("goods"), won.alias("won"), F.sum("errors").alias("errors"))
    far = ks.groupBy(*group).agg(F.max("ks").alias("ks")).select(*(F.col(k).alias(f"_{k}") for k in group), "ks")
    match = F.lit(True)
    for k in group:
        match = match & whole_rows[k].eqNullSafe(far[f"_{k}"])
    both = (F.col("bads") > 0) & (F.col("goods") > 0)
    auc = F.when(both, F.col("won") / (F.col("bads").cast("double") * F.col("goods")))
    return whole_rows.join(far, match).select(*group, "bads", "goods", auc.alias("auc"), (2 * auc - 1).alias("gini"), F.when(both, F.col("ks")).alias("ks"), ratio("errors", F.col("bads") + F.col("goods")).alias("brier"))


def _spread(value: str, level: float) -> list:
    """Estimate, percentile interval and standard error of a column over the replicates of a group."""
    drawn = F.when(F.col("replicate") > 0, F.col(value))
    tails = F.percentile(drawn, F.array(F.lit((1 - level) / 2), F.lit((1 + level) / 2)))
    return [F.max(F.when(F.col("replicate") == 0, F.col(value))).alias("estimate"), tails[0].alias("ci_low"), tails[1].alias("ci_high"), F.stddev_samp(drawn).alias("se")]


def intervals(drawn: DataFrame, by: Sequence[str], level: float = 0.95) -> DataFrame:
    """(by, model, metric, n, bads, estimate, ci_low, ci_high, se, half_width, resamples)."""
    here = lambda c: F.max(F.when(F.col("replicate") == 0, F.col(c))).alias(c)
    out = drawn.groupBy(*by, "model", "metric").agg(here("n"), here("bads"), *_spread("value", level), F.max("replicate").alias("resamples"))
    return out.withColumn("half_width", (F.col("ci_high") - F.col("ci_low")) / 2)


def differences(drawn: DataFrame, split: str, pairs: Sequence[tuple[str, str]], samples: Sequence[tuple[str, str]], level: float = 0.95) -> DataFrame:
    """(comparison, split, model, metric, paired, estimate, ci_low, ci_high, se, excludes_zero): second less first model of
    ``pairs`` on the same draws, and first less second split of ``samples``, whose draws are independent."""
    value = lambda column, name: F.max(F.when(F.col(column) == name, F.col("value")))
    parts = []
    for first, second in pairs:
        apart = drawn.groupBy(F.col(split).alias("split"), "metric", "replicate").agg((value("model", second) - value("model", first)).alias("apart"))
        parts.append(apart.select(F.lit(f"{second} - {first}").alias("comparison"), "split", F.lit("both").alias("model"), "metric", F.lit(True).alias("paired"), "replicate", "apart"))
    for one, other in samples:
        apart = drawn.groupBy("model", "metric", "replicate").agg((value(split, one) - value(split, other)).alias("apart"))
        parts.append(apart.select(F.lit(f"{one} - {other}").alias("comparison"), F.lit(f"{one}, {other}").alias("split"), "model", "metric", F.lit(False).alias("paired"), "replicate", "apart"))
    if not parts:
        raise ValueError("no models or splits to compare")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    out = every.groupBy("comparison", "split", "model", "metric", "paired").agg(*_spread("apart", level))
    return out.withColumn("excludes_zero", (F.col("ci_low") > 0) | (F.col("ci_high") < 0))


def uncertainty_checks(found: DataFrame, published: DataFrame, tolerance: float = 1e-12) -> DataFrame:
    """(check, split, model, metric, claimed, recounted, ok): each interval holds its estimate, and each estimate is the one
    published (split, model, metric, value); an estimate without a published figure, or the reverse, fails."""
    inside = found.select(F.lit("interval contains the estimate").alias("check"), "split", "model", "metric", F.col("estimate").alias("claimed"), F.col("estimate").alias("recounted"), F.col("estimate").between(F.col("ci_low"), F.col("ci_high")).alias("ok"))
    both = found.select("split", "model", "metric", F.col("estimate").alias("recounted")).join(published.withColumnRenamed("value", "claimed"), ["split", "model", "metric"], "full")
    same_figure = F.abs(F.col("claimed") - F.col("recounted")) <= tolerance
    equal = both.select(F.lit("estimate equals the published figure").alias("check"), "split", "model", "metric", "claimed", "recounted", same_figure.alias("ok"))
    return inside.unionByName(equal).withColumn("ok", F.coalesce("ok", F.lit(False)))
