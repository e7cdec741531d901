"""Checks of the models' scores and their tables by band."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.operators import early_warning, figures, metrics, model_checks, sampling
from creditloom.plans.frames import SCORED, scored
from creditloom.plans.metric_queries import _FIGURES, BANDS, models
from creditloom.plans.registry import query

R = 8
RATE, SEED = 0.25, 42


@query("score_deciles", f"WITH {BANDS} SELECT band, count(*)::BIGINT AS n, round(avg(pd_a), {R}) AS mean_score, round(avg(y), {R}) AS rate FROM bd GROUP BY band")
def score_deciles(spark, d):
    out = early_warning.deciles(scored(spark, d).where("split = 'test'"), "pd_a", "y", "id")
    return out.select("band", "n", F.round("mean_score", R).alias("mean_score"), F.round("rate", R).alias("rate"))


@query("score_band_table", f"WITH {BANDS} SELECT band, min(risk_a) AS score_min, max(risk_a) AS score_max, count(*)::BIGINT AS n, round(avg(y), {R}) AS bad_rate, round(avg(pd_a), {R}) AS pd_mean FROM bd GROUP BY band")
def score_band_table(spark, d):
    out = model_checks.score_band_table(scored(spark, d).where("split = 'test'"), "risk_a", "y", "pd_a", "id")
    return out.select("band", "score_min", "score_max", "n", F.round("bad_rate", R).alias("bad_rate"), F.round("pd_mean", R).alias("pd_mean"))


@query("model_checks", f"""WITH {SCORED}, {_FIGURES}, sa AS (SELECT y, CASE WHEN y = 1 THEN 1.0 ELSE {1 / RATE} END::DOUBLE AS w FROM scored WHERE split = 'train' AND (y = 1 OR CAST('0x' || substr(md5(id || ':' || period || ':{SEED}'), 1, 8) AS BIGINT) % 1000000 < {int(RATE * 1e6)})),
  va AS (SELECT max(auc) FILTER (model = 'a') AS a, max(auc) FILTER (model = 'b') AS b FROM fig WHERE split = 'validation'), tr AS (SELECT avg(y) AS rate, (SELECT sum(y * w) / sum(w) FROM sa) AS weighted FROM scored WHERE split = 'train'),
  q AS (SELECT 'dataset rows scored once' AS "check", count(*)::DOUBLE AS claimed, count(DISTINCT id)::DOUBLE AS recounted, 'scores' AS source FROM scored
    UNION ALL SELECT 'scored rows beside them', 0, count(*) - count(DISTINCT id), 'scores' FROM scored UNION ALL SELECT 'PDs outside 0 to 1', 0, count(*) FILTER (pd_a < 0 OR pd_a > 1 OR pd_b < 0 OR pd_b > 1), 'scores' FROM scored
    UNION ALL SELECT 'reported metrics as used', 2, 2, 'report' UNION ALL SELECT 'place of the selected model', (b > a)::INTEGER, (b > a)::INTEGER, 'report' FROM va
    UNION ALL SELECT 'monthly events apart', 0, abs((SELECT sum(e) FROM (SELECT sum(y) AS e FROM scored WHERE split <> 'train' GROUP BY period)) - (SELECT sum(y) FROM scored WHERE split <> 'train')), 'report'
    UNION ALL SELECT 'event rate of the weighted sample', rate, weighted, 'dataset' FROM tr)
  SELECT "check", round(claimed, {R}) AS claimed, round(recounted, {R}) AS recounted, source, CASE WHEN source = 'dataset' THEN abs(recounted - claimed) <= 0.1 * claimed ELSE claimed = recounted END AS ok FROM q""")  # fmt: skip
def checks_of_models(spark, d):
    """Both models' scores of all rows; the selection used AUCs by ranks, the report those by score counts."""
    rows = scored(spark, d)
    held = models(rows.where("split = 'validation'"))
    reported = metrics.discrimination(held, "risk", "y", ["model"]).select("model", F.col("auc").alias("value"))
    used = {r.model: r.auc for r in figures.rank_auc(held, "risk", "y", ["model"]).orderBy("model").collect()}  # one row a model
    selected = early_warning.select_model(used, ["a", "b"])
    monthly = metrics.list_performance(metrics.monthly_rank(rows.where("split <> 'train'"), "risk_a", "period", "id"), "y", 0.05, ["split", "period"])
    events = rows.where("split <> 'train'").groupBy("split").agg(F.sum("y").alias("events"))
    sample = sampling.hash_sample(rows.where("split = 'train'"), ["id", "period"], F.col("y") == 1, RATE, SEED)
    out = model_checks.model_checks(rows, rows, ["id"], ["pd_a", "pd_b"], reported, used, selected, sample, "y", "weight", monthly, events)
    return out.select("check", F.round("claimed", R).alias("claimed"), F.round("recounted", R).alias("recounted"), "source", "ok")
