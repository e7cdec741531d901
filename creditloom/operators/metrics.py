"""Discrimination, calibration, stability and ranking metrics from counts per distinct score.

Every function reduces rows to one count a distinct score (or bin) first; running sums over those counts, and places of
rows, go range by range (:mod:`creditloom.operators.order_stats`)."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.exprs import left_closed_bin, ratio
from creditloom.operators.order_stats import numbered, quantiles, running
from creditloom.session import saved


def score_counts(rows: DataFrame, score: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Bads and goods by distinct score (and group)."""
    return rows.where(F.col(score).isNotNull() & F.col(y).isNotNull()).groupBy(*by, F.col(score).alias("s")).agg(F.sum(F.col(y)).cast("long").alias("bad"), F.sum(1 - F.col(y)).cast("long").alias("good"))


def discrimination(rows: DataFrame, score: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """AUC (ties one half), Gini, KS and its threshold, share of tied pairs; null with one class only."""
    return discrimination_of_counts(score_counts(rows, score, y, by), by)


def discrimination_of_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """:func:`discrimination` from counts (by, s, bad, good), one row a score."""
    c = running(counts, {"cb": "bad", "cg": "good"}, ["s"], by)
    gap = F.abs(ratio("cg", "cg_all") - ratio("cb", "cb_all"))
    c = c.withColumn("gap", F.round(gap, 12))
    pairs = F.col("bad") * (F.col("cg") - F.col("good") + F.col("good") / 2)
    out = c.groupBy(*by).agg(
        F.sum("bad").alias("n_bad"), F.sum("good").alias("n_good"), F.sum(pairs).alias("wins"), F.sum(F.col("bad") * F.col("good")).alias("ties"),
        F.max("gap").alias("ks"), F.max(F.struct("gap", (-F.col("s")).alias("s"))).alias("at"),
    )
    all_pairs = F.col("n_bad").cast("double") * F.col("n_good")
    auc = ratio("wins", all_pairs)
    return out.select(*by, "n_bad", "n_good", auc.alias("auc"), (2 * auc - 1).alias("gini"), F.when(all_pairs > 0, F.col("ks")).alias("ks"), F.when(all_pairs > 0, -F.col("at.s")).alias("ks_threshold"), ratio("ties", all_pairs).alias("tied_share"))


def ks_location(rows: DataFrame, score: str, y: str, threshold: float | Column) -> DataFrame:
    """Shares of all, of bads and of goods at or below a score."""
    below = F.col(score) <= threshold
    n, bad = F.count("*"), F.sum(y)
    return rows.agg(ratio(F.count(F.when(below, 1)), n).alias("share_all"), ratio(F.sum(F.when(below, F.col(y)).otherwise(0)), bad).alias("share_bad"), ratio(F.sum(F.when(below, 1 - F.col(y)).otherwise(0)), n - bad).alias("share_good"))


def average_precision(rows: DataFrame, score: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the precision-recall steps; equal scores enter together."""
    return average_precision_of_counts(score_counts(rows, score, y, by), by)


def average_precision_of_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """:func:`average_precision` from counts (by, s, bad, good), one row a score."""
    c = running(counts, {"tp": "bad", "n": F.col("bad") + F.col("good")}, [F.desc("s")], by)
    return c.groupBy(*by).agg(F.sum(ratio("bad", "tp_all") * ratio("tp", "n")).alias("average_precision"))


def brier(p: str, y: str) -> Column:
    return F.avg(F.pow(F.col(p) - F.col(y), 2))


def log_loss(p: str, y: str, clip: float = 1e-15) -> Column:
    q = F.greatest(F.least(F.col(p), F.lit(1 - clip)), F.lit(clip))
    return F.avg(-(F.col(y) * F.ln(q) + (1 - F.col(y)) * F.ln(1 - q)))


def monthly_rank(rows: DataFrame, score: str, period: str, key: str) -> DataFrame:
    """Place by descending score in the period, ties by key, and the period's size; one sort serves every share."""
    return numbered(rows, [F.desc(score), key], [period]).withColumnRenamed("place_all", "of")


def top_share(share: float) -> Column:
    return F.col("place") - 1 < F.ceil(share * F.col("of") - 1e-9)


def list_performance(ranked: DataFrame, y: str, share: float, by: Sequence[str]) -> DataFrame:
    """Listed rows, captured share of events, precision and lift by group."""
    return performance(performance_sums(ranked, y, [share], by), share, by)


def performance_sums(ranked: DataFrame, y: str, shares: Iterable[float], by: Sequence[str]) -> DataFrame:
    """(by, rows, events, and listed and hits by share): one aggregate serves every share."""
    sums = [c for s in shares for c in (F.count(F.when(top_share(s), 1)).alias(f"listed_{s:g}".replace(".", "_")), F.sum(F.when(top_share(s), F.col(y)).otherwise(0)).alias(f"hits_{s:g}".replace(".", "_")))]
    return ranked.groupBy(*by).agg(F.count("*").alias("rows"), F.sum(y).alias("events"), *sums)


def performance(sums: DataFrame, share: float, by: Sequence[str]) -> DataFrame:
    """:func:`list_performance` of one of the shares of :func:`performance_sums`."""
    listed, hits = (F.col(f"{name}_{share:g}".replace(".", "_")) for name in ("listed", "hits"))
    precision = ratio("hits", "listed")
    sums = sums.select(*by, "rows", listed.alias("listed"), "events", hits.alias("hits"))
    return sums.select(*by, "rows", "listed", "events", "hits", ratio("hits", "events").alias("capture"), precision.alias("precision"), ratio(precision, ratio("events", "rows")).alias("lift"))


def equal_count_bands(rows: DataFrame, value: str, key: str, bands: int) -> DataFrame:
    """Band 1..k of each row by its rank (ties by key), at linear quantiles of the ranks, right-closed."""
    ranked = numbered(rows, [value, key])
    band = F.greatest(F.lit(1), F.ceil((F.col("place") - 1) * bands / F.nullif(F.col("place_all") - 1, F.lit(0)) - 1e-12)).cast("int")
    return ranked.withColumn("band", band).drop("place", "place_all")


def reliability(rows: DataFrame, p: str, y: str, key: str, bands: int, z_limit: float = 1.96) -> DataFrame:
    """Observed against expected by band, with a z-score and a flag."""
    banded = equal_count_bands(rows.select(p, y, key), p, key, bands).groupBy("band").agg(F.count("*").alias("n"), F.sum(y).alias("observed"), F.sum(p).alias("expected"), F.sum(F.col(p) * (1 - F.col(p))).alias("variance"))
    z = (F.col("observed") - F.col("expected")) / F.sqrt(F.nullif("variance", F.lit(0.0)))
    return banded.withColumn("z", z).withColumn("flagged", F.abs(z) > z_limit)


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square law, by the series or the continued fraction of the incomplete gamma function."""
    a, x = dof / 2, x / 2
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= x / n
            total += term
        return 1 - total * front
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def hosmer_lemeshow(bands: DataFrame) -> dict[str, float]:
    """Chi-square over the bands of :func:`reliability`, degrees of freedom, p-value."""
    row = bands.agg(F.sum(F.pow("z", 2)).alias("chi2"), F.count("*").alias("n")).first()
    dof = max(1, row.n - 2)
    return {"chi2": row.chi2, "dof": dof, "p_value": chi2_sf(row.chi2, dof)}


def psi(reference: DataFrame, current: DataFrame, label: Column, epsilon: float = 1e-4) -> DataFrame:
    """Population stability index of a label's distribution; shares of 0 count as ``epsilon``."""
    counts = [df.groupBy(label.alias("label")).agg(F.count("*").alias(n)) for df, n in ((reference, "n_ref"), (current, "n_cur"))]
    both = counts[0].join(counts[1], "label", "full")
    share = lambda n: F.greatest(F.coalesce(ratio(n, F.sum(n).over(Window.partitionBy())), F.lit(0.0)), F.lit(epsilon))
    both = both.withColumn("p_ref", share("n_ref")).withColumn("p_cur", share("n_cur"))
    return both.withColumn("contribution", (F.col("p_cur") - F.col("p_ref")) * F.ln(F.col("p_cur") / F.col("p_ref")))


def quantile_edges(rows: DataFrame, value: str, bins: int) -> list[float]:
    """Inner edges at linear quantiles, each once."""
    return sorted({r[value] for r in quantiles(rows, value, [i / bins for i in range(1, bins)]).collect()})


def psi_numeric(reference: DataFrame, current: DataFrame, value: str, bins: int = 10, epsilon: float = 1e-4) -> DataFrame:
    """PSI over left-closed bins of the reference's quantiles, missing values in a bin of their own."""
    edges = quantile_edges(reference, value, bins)
    label = F.when(F.col(value).isNull(), -1).otherwise(left_closed_bin(value, edges))
    return psi(reference, current, label, epsilon)


def psi_categorical(reference: DataFrame, current: DataFrame, value: str, epsilon: float = 1e-4) -> DataFrame:
    """PSI over the reference's levels; levels it has not are pooled as other."""
    level = F.coalesce(F.col(value).cast("string"), F.lit("missing"))
    levels = reference.select(level.alias("label")).distinct()
    marked = current.select(level.alias("label")).join(levels.withColumn("_known", F.lit(True)), "label", "left").select(F.when(F.col("_known"), F.col("label")).otherwise("other").alias("label"))
    return psi(reference.select(level.alias("label")), marked, F.col("label"), epsilon)


def swap_set(rows: DataFrame, p_a: str, p_b: str, y: str, threshold: float) -> DataFrame:
    """Rows and bad rates by the two models' decisions."""
    return rows.groupBy((F.col(p_a) >= threshold).alias("reject_a"), (F.col(p_b) >= threshold).alias("reject_b")).agg(F.count("*").alias("n"), F.sum(y).alias("bads"), F.avg(y).alias("bad_rate"))


def weighted_quantiles(rows: DataFrame, value: str, weight: str, qs: Sequence[float]) -> DataFrame:
    """For each q, the first value at which the running weight reaches share q."""
    c = rows.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.sum(weight).alias("w"))
    c = running(c, {"upto": "w"}, ["v"]).withColumn("share", F.col("upto") / F.col("upto_all"))
    each = c.withColumn("q", F.explode(F.array(*(F.lit(float(q)) for q in qs))))
    return each.where(F.col("share") >= F.col("q") - 1e-12).groupBy("q").agg(F.min("v").alias("value"))


def recalibrate(rows: DataFrame, log_odds: str, y: str, iterations: int = 100, tolerance: float = 1e-12) -> dict[str, float]:
    """Intercept and slope of y on the log-odds by Newton steps over counts by log-odds, which are found once; each step is
    one aggregate of five sums.

    Without a solution (one class, one value, or classes that a threshold separates) all values are nan."""
    nothing = dict.fromkeys(("intercept", "slope", "intercept_se", "slope_se", "slope_z_vs_1"), float("nan"))
    a, b = 0.0, 1.0
    h = np.eye(2)
    counts = saved(score_counts(rows, log_odds, y).select("s", "bad", (F.col("bad") + F.col("good")).alias("n")))
    for _ in range(iterations):
        p = 1 / (1 + F.exp(-(a + b * F.col("s"))))
        w, r, x = F.col("n") * p * (1 - p), F.col("bad") - F.col("n") * p, F.col("s")
        s = counts.agg(F.sum(r), F.sum(r * x), F.sum(w), F.sum(w * x), F.sum(w * x * x)).first()
        h = np.array([[s[2] or 0.0, s[3] or 0.0], [s[3] or 0.0, s[4] or 0.0]])
        if not np.isfinite(h).all() or np.linalg.cond(h) > 1e12 or abs(b) > 1e3:
            return nothing
        step = np.linalg.solve(h, np.array([s[0], s[1]]))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < tolerance:
            break
    se = np.sqrt(np.diag(np.linalg.inv(h)))
    return {"intercept": a, "slope": b, "intercept_se": se[0], "slope_se": se[1], "slope_z_vs_1": (b - 1) / se[1]}
