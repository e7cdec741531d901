"""Published figures against recomputed ones: every module's figures as rows (module, key, value), and one comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.exprs import ratio
from creditloom.operators.metrics import discrimination, reliability, score_counts, swap_set
from creditloom.operators.order_stats import numbered, running, spearman


def figures(table: DataFrame, module: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """A table's figures as rows; the key is made of the key columns and the figure's name."""
    named = table.select(*(F.col(k).cast("string").alias(k) for k in keys), *(F.col(v).cast("double").alias(v) for v in values))
    long = named.unpivot(list(keys), list(values), "_name", "value")
    return long.select(F.lit(module).alias("module"), F.concat_ws("/", *(F.coalesce(F.col(k), F.lit("-")) for k in keys), "_name").alias("key"), "value")


def compare(published: DataFrame, recomputed: DataFrame, tolerance: Mapping[str, float] | float = 0.0) -> DataFrame:
    """(module, key, published, recomputed, problem, ok) of two tables of figures.

    A figure that only one side has fails, and so does one that a side has twice or without a value; ``tolerance`` is by
    module, or one for all."""
    side = lambda df, name: df.groupBy("module", "key").agg(F.max("value").alias(name), F.count("*").alias(f"_n_{name}"))
    both = side(published, "published").join(side(recomputed, "recomputed"), ["module", "key"], "full")
    if isinstance(tolerance, Mapping):
        bound = reduce(lambda rest, m: F.when(F.col("module") == m, tolerance[m]).otherwise(rest), tolerance, F.lit(0.0))
    else:
        bound = F.lit(float(tolerance))
    problem = (
        F.when(F.col("_n_published").isNull(), "not published").when(F.col("_n_recomputed").isNull(), "not recomputed").when((F.col("_n_published") > 1) | (F.col("_n_recomputed") > 1), "repeated")
        .when(F.col("published").isNull() | F.col("recomputed").isNull(), "no value").when(F.abs(F.col("published") - F.col("recomputed")) > bound, "apart").otherwise("")
    )
    return both.select("module", "key", "published", "recomputed", problem.alias("problem"), (problem == "").alias("ok"))


def rank_auc(rows: DataFrame, score: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """AUC by the rank sum of the bads, a second way to the figure of :func:`discrimination`."""
    counts = score_counts(rows, score, y, by).withColumn("_n", F.col("bad") + F.col("good"))
    ran = running(counts, {"upto": "_n"}, ["s"], by)
    sums = ran.groupBy(*by).agg(F.sum(F.col("bad") * (F.col("upto") - (F.col("_n") - 1) / 2)).alias("_ranks"), F.sum("bad").alias("_b"), F.sum("good").alias("_g"))
    return sums.select(*by, ratio(F.col("_ranks") - F.col("_b").cast("double") * (F.col("_b") + 1) / 2, F.col("_b").cast("double") * F.col("_g")).alias("auc"))


def discrimination_figures(rows: DataFrame, score: str, y: str, by: Sequence[str]) -> DataFrame:
    return figures(discrimination(rows, score, y, by), "discrimination", by, ["auc", "gini", "ks"])


def discrimination_identities(rows: DataFrame, score: str, y: str, by: Sequence[str]) -> DataFrame:
    """What must hold within one validation: AUC by ranks, and Gini from it."""
    auc = rank_auc(rows, score, y, by)
    return figures(auc.withColumn("gini", 2 * F.col("auc") - 1), "discrimination", by, ["auc", "gini"])


def calibration_figures(rows: DataFrame, pd: str, y: str, by: Sequence[str]) -> DataFrame:
    """Size, bads, mean PD, bad rate and Brier score."""
    sums = rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum(y).alias("bads"), F.avg(pd).alias("mean_pd"), F.avg(y).alias("bad_rate"), F.avg(F.pow(F.col(pd) - F.col(y), 2)).alias("brier"))
    return figures(sums, "calibration", by, ["n", "bads", "mean_pd", "bad_rate", "brier"])


def band_totals(rows: DataFrame, pd: str, y: str, key: str, bands: int, group: Mapping[str, str]) -> DataFrame:
    """What the reliability bands of one group of rows add up to: their rows, bads and mean PD."""
    made = reliability(rows, pd, y, key, bands).agg(F.sum("n").alias("n"), F.sum("observed").alias("bads"), ratio(F.sum("expected"), F.sum("n")).alias("mean_pd"))
    return figures(made.withColumns({k: F.lit(v) for k, v in group.items()}), "calibration", list(group), ["n", "bads", "mean_pd"])


def head_to_head(rows: DataFrame, risks: tuple[str, str], pds: tuple[str, str], y: str, key: str, threshold: float, share: float = 0.1) -> DataFrame:
    """Two models on the same rows, as figures: agreement of ranks and of the riskiest, rows and bads by both decisions, and
    what either would decline at the other's volume. Equal scores are ordered by ``key``."""
    first, second = pds
    found = spearman(rows, *risks)
    for column, place in ((risks[0], "_a"), (risks[1], "_b")):
        rows = numbered(rows, [F.desc(column), key]).withColumnsRenamed({"place": place, "place_all": f"{place}_n"})
    top = {m: F.col(m) <= F.ceil(share * F.col(f"{m}_n") - 1e-9) for m in ("_a", "_b")}
    rate = lambda here: F.avg(F.when(here, F.col(y)))
    agreed = rows.agg(ratio(F.count(F.when(top["_a"] & top["_b"], 1)), F.count(F.when(top["_a"], 1))).alias("top_overlap"), rate(top["_a"] & ~top["_b"]).alias("bad_rate_only_first_top"), rate(top["_b"] & ~top["_a"]).alias("bad_rate_only_second_top"))
    cells = swap_set(rows, first, second, y, threshold)
    name = F.when(F.col("reject_a") & F.col("reject_b"), "both reject").when(F.col("reject_a"), "only first rejects").when(F.col("reject_b"), "only second rejects").otherwise("both accept")
    decline = rows.agg(*(F.count(F.when(F.col(p) >= threshold, 1)).alias(f"rejects_{m}") for p, m in ((first, "first"), (second, "second"))))
    volume = rows.crossJoin(F.broadcast(decline)).agg(  # one row
        F.sum(F.when(F.col("_b") <= F.col("rejects_first"), F.col(y)).otherwise(0)).alias("bads_second_at_first_volume"),
        F.sum(F.when(F.col("_a") <= F.col("rejects_second"), F.col(y)).otherwise(0)).alias("bads_first_at_second_volume"),
    )
    parts = [
        figures(found, "agreement", [], ["spearman"]), figures(agreed, "agreement", [], agreed.columns), figures(cells.withColumn("cell", name), "swap_set", ["cell"], ["n", "bads"]),
        figures(decline, "decisions", [], decline.columns), figures(volume, "equal_volume", [], volume.columns),
    ]
    return reduce(DataFrame.unionByName, parts)


def comparison_identities(found: DataFrame, rows: int) -> DataFrame:
    """(module, key, value) twice over: what the cells of a swap set add up to, against the decisions; for :func:`compare`."""
    cell = lambda *names: F.sum(F.when((F.col("module") == "swap_set") & F.col("key").isin(*(f"{n}/n" for n in names)), F.col("value")).otherwise(0.0))
    sums = found.agg(cell("both reject", "only first rejects", "only second rejects", "both accept").alias("rows"), cell("both reject", "only first rejects").alias("rejects_first"), cell("both reject", "only second rejects").alias("rejects_second"))
    claimed = found.where("module = 'decisions'").select(F.lit("comparison").alias("module"), "key", "value")
    whole = found.sparkSession.createDataFrame([("comparison", "rows", float(rows))], "module string, key string, value double")
    return figures(sums, "comparison", [], sums.columns).withColumn("side", F.lit("recomputed")).unionByName(claimed.unionByName(whole).withColumn("side", F.lit("published")))


def side_by_side(discriminated: DataFrame, intervals: DataFrame, calibration: DataFrame, stability: DataFrame, segments: DataFrame, split: str) -> DataFrame:
    """One row a model from the tables of all modules; what a module does not have is null.

    discriminated: (model, split, n_bad, n_good, auc, gini, ks, ks_threshold); intervals: (model, split, metric, ci_low,
    ci_high); calibration: (model, split, brier, slope, ratio_bad_rate_to_pd, flagged_bands); stability: (model, kind, sample,
    segment, psi, light); segments: a segment table."""
    here = F.col("split") == split
    own = discriminated.where(here).select("model", (F.col("n_bad") + F.col("n_good")).alias("n"), F.col("n_bad").alias("bads"), "auc", "gini", "ks", F.col("ks_threshold").alias("ks_cut"))
    ends = [F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{m}_{c}") for m in ("auc", "gini", "ks") for c in ("ci_low", "ci_high")]
    wide = intervals.where(here).groupBy("model").agg(*ends)
    fit = calibration.where(here).select("model", "brier", "slope", "ratio_bad_rate_to_pd", "flagged_bands")
    population = F.col("sample") == "population"
    light = lambda name: F.count(F.when((F.col("kind") == "feature") & (F.col("light") == name), 1))
    drift = stability.where(population).groupBy("model").agg(F.max(F.when((F.col("kind") == "output") & (F.col("segment") == "all"), F.col("psi"))).alias("output_psi"), light("red").alias("features_red"), light("amber").alias("features_amber"))
    groups = segments.where(here & (F.col("grp") != "(all)")).groupBy("model").agg(F.count(F.when(F.col("calibration_flag") != "", 1)).alias("groups_flagged"), F.min("adverse_impact_ratio").alias("least_impact_ratio"), F.min("auc_gap_vs_all").alias("least_auc_gap"))
    return reduce(lambda a, b: a.join(b, "model", "left"), [own, wide, fit, drift, groups])
