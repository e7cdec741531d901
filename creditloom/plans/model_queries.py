"""Queries that fit: binning, weights of evidence, scorecard, calibration, boosted trees, conclusions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.operators import binning, metrics, rules, scorecard, uncertainty
from creditloom.operators.order_stats import with_average_ranks
from creditloom.plans.frames import SCORED, scored
from creditloom.plans.registry import query

R = 8
NUMERIC = ["risk_a", "risk_b", "amount"]
CATEGORICAL = ["segment", "priority"]
SPEC = binning.BinningSpec(initial_bins=10, max_bins=5)


@query("woe_iv", f"""WITH {SCORED}, c AS (SELECT floor(risk_a / 20)::INTEGER AS label, count(*)::BIGINT AS n, sum(y)::BIGINT AS n_bad FROM scored GROUP BY 1),
  h AS (SELECT *, (max((n = n_bad OR n_bad = 0)::INTEGER) OVER ()) * 0.5 AS adj FROM c), s AS (SELECT *, (n - n_bad + adj) / sum(n - n_bad + adj) OVER () AS pg, (n_bad + adj) / sum(n_bad + adj) OVER () AS pb FROM h)
  SELECT label, n, n_bad, round(ln(pg / pb), {R}) AS woe, round((pg - pb) * ln(pg / pb), {R}) AS iv_part FROM s""")  # fmt: skip
def woe_iv(spark, d):
    t = binning.woe_table(scored(spark, d), F.floor(F.col("risk_a") / 20).cast("int"), "y")
    return t.select("label", "n", "n_bad", F.round("woe", R).alias("woe"), F.round("iv_part", R).alias("iv_part"))


def fitted(spark, d):
    train = scored(spark, d).where("split = 'train'")
    return binning.fit_binnings(train, NUMERIC, CATEGORICAL, "y", SPEC)


@query("binning_table")
def binning_table(spark, d):
    rows = [(r["feature"], r["label"], r["n"], r["n_bad"], r["bad_rate"], r["woe"]) for b in fitted(spark, d).values() for r in b.table()]
    return spark.createDataFrame(rows, "feature string, label string, n long, n_bad long, bad_rate double, woe double")


@query("binning_counts", f"""WITH {SCORED}, t AS (SELECT * FROM scored WHERE split = 'train') SELECT 'priority' AS feature, priority AS category, count(*)::BIGINT AS n, sum(y)::BIGINT AS n_bad FROM t GROUP BY 2
  UNION ALL SELECT 'segment', segment, count(*)::BIGINT, sum(y)::BIGINT FROM t GROUP BY 2""")  # fmt: skip
def binning_counts(spark, d):
    """What categorical binning sees of the rows: one grouped count of all features."""
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("category")) for f in CATEGORICAL))
    return scored(spark, d).where("split = 'train'").select("y", F.explode(pairs).alias("p")).groupBy("p.feature", "p.category").agg(F.count("*").alias("n"), F.sum("y").alias("n_bad"))


@query("prebin_edges", f"""WITH {SCORED}, t AS (SELECT risk_a AS v, row_number() OVER (ORDER BY risk_a) - 1 AS k, count(*) OVER () AS n, max(risk_a) OVER () AS top FROM scored WHERE split = 'train')
  SELECT DISTINCT v::DOUBLE AS edge FROM t WHERE v < top AND k IN (SELECT ceil(q * (n - 1) - 1e-9) FROM (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])::DOUBLE AS q))""")  # fmt: skip
def prebin_edges(spark, d):
    edges = binning.higher_quantiles(scored(spark, d).where("split = 'train'"), ["risk_a"], 10)["risk_a"]
    return spark.createDataFrame([(e,) for e in edges], "edge double")


@query("iv_report")
def iv_report(spark, d):
    rows = scored(spark, d)
    out = binning.iv_report(fitted(spark, d), rows.where("split = 'validation'"), rows.where("split = 'test'"), "y")
    return spark.createDataFrame([tuple(r.values()) for r in out], "feature string, iv_train double, iv_validation double, retention double, psi_validation double, psi_current double, band string")


def chosen(spark, d):
    train, fits = scored(spark, d).where("split = 'train'"), fitted(spark, d)
    woes = scorecard.correlation_matrix(train, {f: b.woe_of(F.col(f)) for f, b in fits.items()})
    ranked = with_average_ranks(train, {f: f"r_{f}" for f in NUMERIC})
    raw = scorecard.correlation_matrix(ranked, {f: F.col(f"r_{f}") if f in NUMERIC else F.lit(0.0) for f in fits})
    return fits, scorecard.select_features({f: b.iv for f, b in fits.items()}, woes, raw, iv_min=0.0001)


@query("feature_selection")
def feature_selection(spark, d):
    return spark.createDataFrame(chosen(spark, d)[1], "feature string, step string, reason string")


def card(spark, d):
    fits, said = chosen(spark, d)
    kept = {f: fits[f] for f, step, _ in said if step == "selected"}
    x, good, bad = scorecard.patterns(scored(spark, d).where("split = 'train'"), kept, "y")
    fit = scorecard.fit_sign_stable(list(kept), x, good, bad, resamples=20, least=0.6)
    return scorecard.Scorecard(fit, kept)


@query("scorecard_table")
def scorecard_table(spark, d):
    return spark.createDataFrame(card(spark, d).table(), "feature string, label string, woe double, points int")


@query("scorecard_scores")
def scorecard_scores(spark, d):
    out = card(spark, d).score(scored(spark, d).where("split = 'test'"), 2)
    return out.select("id", "y", "score", "log_odds_bad", "pd", F.get("reasons", F.lit(0)).alias("reason_1"), F.get("reasons", F.lit(1)).alias("reason_2"))


@query("calibrated_pds")
def calibrated_pds(spark, d):
    rows = scored(spark, d).withColumn("lo", F.ln(F.col("pd_a") / (1 - F.col("pd_a"))))
    chosen_one, _ = scorecard.select_calibrator(rows.where("split = 'validation'"), "lo", "y", F.floor(F.col("id") / 5).cast("int") % 5, 5)
    return rows.where("split = 'test'").select("id", F.lit(chosen_one.method).alias("method"), chosen_one.apply(F.col("lo")).alias("pd"))


@query("vif")
def vif(spark, d):
    rows = scored(spark, d)
    v = scorecard.vif(scorecard.correlation_matrix(rows, {c: F.col(c).cast("double") for c in NUMERIC}))
    return spark.createDataFrame([(c, float(x)) for c, x in zip(NUMERIC, v, strict=True)], "feature string, vif double")


@query("gbt_challenger")
def gbt_challenger(spark, d):
    """Boosted trees over a small grid, the best on the validation rows, with its importances."""
    from creditloom.operators.challenger import fit_challenger

    model = fit_challenger(scored(spark, d), NUMERIC, CATEGORICAL, "y")
    return spark.createDataFrame([(f, float(v), model.params, float(model.validation_ap)) for f, v in model.importances], "feature string, importance double, params string, validation_ap double")


@query("gbt_trials")
def gbt_trials(spark, d):
    """The trials of the challenger, each with its best round, and which was selected."""
    from creditloom.operators.challenger import fit_challenger

    model = fit_challenger(scored(spark, d), NUMERIC, CATEGORICAL, "y", rounds=8, patience=3)
    return spark.createDataFrame(model.log, "trial int, params string, best_round int, validation_ap double, selected boolean")


@query("warning_challenger")
def warning_challenger(spark, d):
    """Scores of the early warnings' weighted challenger on the test rows."""
    from creditloom.operators.challenger import fit_challenger

    rows = warning_rows(spark, d)
    model = fit_challenger(rows, ["risk_a", "amount"], ["segment", "priority"], "y", grid=[{"depth": 3, "step": 0.3}], rounds=8, patience=3, weight="w")
    return model.predict(rows.where("split = 'test'")).select("id", "period", "y", F.round("pd", 9).alias("pd"))


CONCLUSION = [
    rules.Bound("blocking_checks", "failed_checks", "remediate", start=1),
    rules.Bound("auc_ci_lower", "auc_ci_low", "note", low=0.65),
    rules.Bound("auc_ci_lower", "auc_ci_low", "remediate", low=0.55),
    rules.Bound("slope", "slope", "note", low=0.9, high=1.1),
    rules.Bound("slope", "slope", "remediate", low=0.7, high=1.3),
    rules.Bound("slope", "slope_z", "note", high=3.0),
    rules.Bound("validation_test_gap", "significant_gap", "note", start=1e-12),
    rules.Bound("bad_rate_to_pd_ratio", "bad_rate_to_pd", "note", low=0.9, high=1.1),
    rules.Bound("flagged_bands", "flagged_bands", "note", start=3),
    rules.Bound("output_psi", "output_light", "note", start=1),
    rules.Bound("output_psi", "output_light", "remediate", start=2),
    rules.Bound("feature_psi", "feature_light", "note", start=2),
    rules.Bound("sensitive_calibration", "flagged_groups", "note", start=1),
    rules.Bound("adverse_impact_ratio", "least_impact_ratio", "note", low=0.8),
    rules.Bound("adverse_impact_ratio", "least_impact_ratio", "remediate", low=0.5),
    rules.Bound("group_auc_gap", "auc_gap", "note", high=0.05),
]


def stability_measures(spark, d):
    """(model, kind, sample, segment, psi, light) of the scores and of a feature, test against training rows."""
    rows = scored(spark, d)
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    out = []
    for m in "ab":
        for kind, column in (("output", f"pd_{m}"), ("feature", "amount")):
            of = metrics.psi_numeric(train, test, column).agg(F.sum("contribution").alias("psi"))
            light = F.when(F.col("psi") < 0.1, "green").when(F.col("psi") <= 0.25, "amber").otherwise("red")
            out.append(of.select(F.lit(m).alias("model"), F.lit(kind).alias("kind"), F.lit("population").alias("sample"), F.lit("all").alias("segment"), "psi", light.alias("light")))
    return reduce(DataFrame.unionByName, out)


@query("conclusion_rules")
def conclusion_rules(spark, d):
    """The rules over the metrics of both models on the test rows, with verdicts."""
    from creditloom.plans.check_queries import population_checks
    from creditloom.plans.metric_queries import SAMPLES, drawn, models, segmented

    resampled = drawn(spark, d)
    rows = models(scored(spark, d).where("split = 'test'"))
    lo = rows.withColumn("lo", F.ln(F.col("pd") / (1 - F.col("pd"))))
    found = [(m, "test", metrics.recalibrate(lo.where(F.col("model") == m), "lo", "y")) for m in "ab"]
    calibration = spark.createDataFrame([(m, s, float(c["slope"]), float(c["slope_z_vs_1"])) for m, s, c in found], "model string, split string, slope double, slope_z_vs_1 double")
    ratios = rows.groupBy("model", "split").agg((F.sum("y") / F.sum("pd")).alias("ratio_bad_rate_to_pd"))
    bands = [metrics.reliability(rows.where(F.col("model") == m), "pd", "y", "id", 10).select(F.lit(m).alias("model"), F.lit("test").alias("split"), "flagged") for m in "ab"]
    checks = population_checks(spark, d).select(F.lit("population").alias("module"), "ok")
    measured = rules.measures("test", intervals=uncertainty.intervals(resampled, ["split"]), differences=uncertainty.differences(resampled, "split", [], [SAMPLES]),
        calibration=calibration.join(ratios, ["model", "split"]), bands=bands[0].unionByName(bands[1]), stability=stability_measures(spark, d), segments=segmented(spark, d)[0], checks=checks, least_group=100)
    return rules.conclude(measured, CONCLUSION)


@query("availability_matrix")
def availability_matrix(spark, d):
    matrix = rules.Availability({"o_orderkey": {"timing": "key", "use": False}, "o_*date": {"timing": "post_decision", "use": False}, "o_*": {"timing": "application", "use": True}}, {"timing": "unknown", "use": False})
    columns = spark.read.parquet(f"{d}/orders.parquet").columns
    return spark.createDataFrame([(r["column"], r["timing"], r["use"]) for r in map(matrix.resolve, columns)], "column string, timing string, use boolean")


def warning_rows(spark, d):
    return scored(spark, d).withColumn("w", F.when(F.col("y") == 1, 1.0).otherwise(2.0))


def baseline(spark, d):
    from creditloom.operators import early_warning

    train = warning_rows(spark, d).where("split = 'train'")
    encoder = early_warning.fit_encoder(train, "w", ["risk_a", "amount"], ["segment", "priority"], 0.05)
    return early_warning.fit_baseline(train, "y", "w", encoder)


@query("warning_baseline")
def warning_baseline(spark, d):
    """Scores and reasons of the weighted baseline on the test rows."""
    out = baseline(spark, d).score(warning_rows(spark, d).where("split = 'test'"))
    return out.select("id", "period", "y", F.round("pd", 9).alias("pd"), F.get("reasons", F.lit(0)).alias("reason_1"))


@query("warning_evaluation")
def warning_evaluation(spark, d):
    from creditloom.operators import early_warning

    out = baseline(spark, d).score(warning_rows(spark, d))
    return early_warning.evaluate(out.withColumn("pd", F.round("pd", 9)), "pd", "y", ["auc", "average_precision", "lift_top_5pct", "capture_top_10pct"], "period", "id", ["split"])


@query("warning_watchlist")
def warning_watchlist(spark, d):
    from creditloom.operators import early_warning

    out = baseline(spark, d).score(warning_rows(spark, d).where("split = 'test'"))
    return early_warning.watchlist(out.withColumn("pd", F.round("pd", 9)), "pd", 0.05, "period", "id")


@query("warning_importance")
def warning_importance(spark, d):
    from creditloom.operators import early_warning

    base = baseline(spark, d)
    return early_warning.importance(base.score(warning_rows(spark, d).where("split = 'test'")), base.encoder.features)


@query("rescored_differences", f"""WITH {SCORED}, a AS (SELECT id, risk_a AS score, round(pd_a, 6) AS pd FROM scored), b AS (SELECT id, risk_a + (id % 997 = 0)::INTEGER AS score, round(pd_a, 6) + CASE WHEN id % 1009 = 0 THEN 0.01 ELSE 0 END AS pd FROM scored)
  SELECT id, 'score' AS "column" FROM a JOIN b USING (id) WHERE a.score <> b.score UNION ALL SELECT id, 'pd' FROM a JOIN b USING (id) WHERE abs(a.pd - b.pd) > 1e-6""")  # fmt: skip
def rescored_differences(spark, d):
    """Published scores against a rescoring that was changed on purpose."""
    from creditloom.operators import early_warning

    rows = scored(spark, d).select("id", F.col("risk_a").alias("score"), F.round("pd_a", 6).alias("pd"))
    other = rows.withColumn("score", F.col("score") + (F.col("id") % 997 == 0).cast("int")).withColumn("pd", F.col("pd") + F.when(F.col("id") % 1009 == 0, 0.01).otherwise(0.0))
    return early_warning.compare_implementations(rows, other, "id", ["score"], {"pd": 1e-6})


@query("gbt_contributions")
def gbt_contributions(spark, d):
    """Additive contributions of the boosted trees on the test rows, and how far they are from the margin (nothing)."""
    from creditloom.operators.challenger import contributions, fit_challenger

    model = fit_challenger(scored(spark, d), NUMERIC, CATEGORICAL, "y", grid=[{"depth": 2}], rounds=5)
    names = [*NUMERIC, *CATEGORICAL]
    out = contributions(model, scored(spark, d).where("split = 'test'"), names)
    gap = F.abs(F.col("margin") - F.col("bias") - sum((F.col(f"contribution_{n}") for n in names), F.lit(0.0)))
    return out.select("id", *(F.round(f"contribution_{n}", 9).alias(n) for n in names), F.round(gap, 6).alias("gap"))
