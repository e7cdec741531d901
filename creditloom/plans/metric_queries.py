"""Queries over scored rows: discrimination, calibration, stability, ranking, comparison, fairness, alerts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from creditloom.functions.exprs import left_closed_bin, light, ratio
from creditloom.operators import metrics, order_stats, segments, uncertainty
from creditloom.plans.frames import CUSTOMER_MONTHS, SCORED, customer_months, scored
from creditloom.plans.registry import query

R = 8


def _r(*names):
    return [F.round(n, R).alias(n) for n in names]


def _disc(score: str, by: str) -> str:
    """SQL of the discrimination metrics of one score by a column."""
    return f"""c AS (SELECT {by} AS k, {score} AS s, sum(y)::BIGINT AS bad, sum(1 - y)::BIGINT AS good FROM scored GROUP BY ALL),
  r AS (SELECT *, sum(bad) OVER w AS cb, sum(good) OVER w AS cg, sum(bad) OVER (PARTITION BY k) AS nb, sum(good) OVER (PARTITION BY k) AS ng FROM c WINDOW w AS (PARTITION BY k ORDER BY s)),
  g AS (SELECT *, round(abs(cg / nullif(ng, 0) - cb / nullif(nb, 0)), 12) AS gap FROM r),
  m AS (SELECT k, sum(bad)::BIGINT AS n_bad, sum(good)::BIGINT AS n_good, sum(bad * (cg - good + good / 2.0)) AS wins, sum(bad * good) AS ties, max(gap) AS ks, min(s) FILTER (gap = mx) AS thr
    FROM (SELECT *, max(gap) OVER (PARTITION BY k) AS mx FROM g) GROUP BY k)"""


_AUC = f"round(wins / nullif(n_bad * n_good, 0)::DOUBLE, {R})"


@query("auc_gini", f"WITH {SCORED}, {_disc('risk_a', 'split')} SELECT k AS split, n_bad, n_good, {_AUC} AS auc, round(2 * (wins / nullif(n_bad * n_good, 0)::DOUBLE) - 1, {R}) AS gini FROM m")
def auc_gini(spark, d):
    return metrics.discrimination(scored(spark, d), "risk_a", "y", ["split"]).select("split", "n_bad", "n_good", *_r("auc", "gini"))


@query("ks_location", f"""WITH {SCORED}, {_disc('risk_a', 'split')} SELECT k AS split, round(ks, {R}) AS ks, thr AS ks_threshold,
  (SELECT round(avg((risk_a <= thr)::INTEGER), {R}) FROM scored WHERE split = k) AS share_all, (SELECT round(avg((risk_a <= thr)::INTEGER), {R}) FROM scored WHERE split = k AND y = 1) AS share_bad,
  (SELECT round(avg((risk_a <= thr)::INTEGER), {R}) FROM scored WHERE split = k AND y = 0) AS share_good FROM m""")  # fmt: skip
def ks_location(spark, d):
    rows = scored(spark, d)
    at = metrics.discrimination(rows, "risk_a", "y", ["split"]).select("split", "ks", "ks_threshold")
    below = (F.col("risk_a") <= F.col("ks_threshold")).cast("int")
    # three rows, one a split
    j = rows.join(F.broadcast(at), "split").groupBy("split", "ks", "ks_threshold")
    return j.agg(F.round(F.avg(below), R).alias("share_all"), F.round(F.avg(F.when(F.col("y") == 1, below)), R).alias("share_bad"), F.round(F.avg(F.when(F.col("y") == 0, below)), R).alias("share_good")).withColumn("ks", F.round("ks", R))


@query("pair_auc", f"WITH {SCORED}, {_disc('risk_b', 'split')} SELECT k AS split, {_AUC} AS auc, round(ties / nullif(n_bad * n_good, 0)::DOUBLE, {R}) AS tied_share FROM m")
def pair_auc(spark, d):
    return metrics.discrimination(scored(spark, d), "risk_b", "y", ["split"]).select("split", *_r("auc", "tied_share"))


def models(rows):
    """Both models' risks as rows: (model, risk, pd) beside the other columns."""
    each = F.array(*(F.struct(F.lit(m).alias("model"), F.col(f"risk_{m}").alias("risk"), F.col(f"pd_{m}").alias("pd")) for m in "ab"))
    return rows.withColumn("_m", F.explode(each)).select("*", "_m.*").drop("_m")


_MODELS = "mo AS (SELECT *, 'a' AS model, risk_a AS risk, pd_a AS pd FROM scored UNION ALL SELECT *, 'b', risk_b, pd_b FROM scored)"


@query("discrimination_table", f"""WITH {SCORED}, {_MODELS}, {_disc('risk', "model || '/' || split").replace('FROM scored', 'FROM mo')} SELECT split_part(k, '/', 1) AS model, split_part(k, '/', 2) AS split, {_AUC} AS auc, round(ks, {R}) AS ks FROM m""")
def discrimination_table(spark, d):
    return metrics.discrimination(models(scored(spark, d)), "risk", "y", ["model", "split"]).select("model", "split", *_r("auc", "ks"))


@query("brier_logloss", f"""WITH {SCORED} SELECT split, round(avg((pd_a - y) * (pd_a - y)), {R}) AS brier, round(avg(-(y * ln(pd_a) + (1 - y) * ln(1 - pd_a))), {R}) AS log_loss,
  round(avg(y) / avg(pd_a), {R}) AS bad_rate_to_pd FROM scored GROUP BY split""")  # fmt: skip
def brier_logloss(spark, d):
    return scored(spark, d).groupBy("split").agg(F.round(metrics.brier("pd_a", "y"), R).alias("brier"), F.round(metrics.log_loss("pd_a", "y"), R).alias("log_loss"), F.round(F.avg("y") / F.avg("pd_a"), R).alias("bad_rate_to_pd"))


@query("average_precision", f"""WITH {SCORED}, c AS (SELECT split, risk_a AS s, sum(y) AS bad, count(*) AS n FROM scored GROUP BY ALL),
  r AS (SELECT *, sum(bad) OVER w AS tp, sum(n) OVER w AS cn, sum(bad) OVER (PARTITION BY split) AS nb FROM c WINDOW w AS (PARTITION BY split ORDER BY s DESC))
  SELECT split, round(sum((bad / nb) * (tp / cn)), {R}) AS average_precision FROM r GROUP BY split""")  # fmt: skip
def average_precision(spark, d):
    return metrics.average_precision(scored(spark, d), "risk_a", "y", ["split"]).select("split", *_r("average_precision"))


RANKED = f"{SCORED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY risk_a DESC, id) AS place, count(*) OVER (PARTITION BY period) AS n FROM scored), lst AS (SELECT *, place - 1 < ceil(0.05 * n - 1e-9) AS listed FROM ranked)"


@query("monthly_capture", f"""WITH {RANKED}, t AS (SELECT period, count(*)::BIGINT AS rows, (count(*) FILTER (listed))::BIGINT AS listed, sum(y)::BIGINT AS events, coalesce(sum(y) FILTER (listed), 0)::BIGINT AS hits FROM lst GROUP BY period)
  SELECT *, round(hits / nullif(events, 0), {R}) AS capture, round(hits / listed, {R}) AS precision, round((hits / listed) / nullif(events / rows, 0), {R}) AS lift FROM t""")  # fmt: skip
def monthly_capture(spark, d):
    ranked = metrics.monthly_rank(scored(spark, d).select("id", "period", "risk_a", "y"), "risk_a", "period", "id")
    return metrics.list_performance(ranked, "y", 0.05, ["period"]).select("period", "rows", "listed", "events", "hits", *_r("capture", "precision", "lift"))


@query("monthly_list", f"WITH {RANKED} SELECT period, id, place::INTEGER AS place FROM lst WHERE listed")
def monthly_list(spark, d):
    ranked = metrics.monthly_rank(scored(spark, d).select("id", "period", "risk_a", "y"), "risk_a", "period", "id")
    return ranked.where(metrics.top_share(0.05)).select("period", "id", "place")


BANDS = f"""{SCORED}, rk AS (SELECT *, row_number() OVER (ORDER BY pd_a, id) AS r, count(*) OVER () AS n FROM scored WHERE split = 'test'),
  bd AS (SELECT *, greatest(1, ceil((r - 1) * 10 / nullif(n - 1, 0) - 1e-12))::INTEGER AS band FROM rk),
  rel AS (SELECT band, count(*)::BIGINT AS n, sum(y)::BIGINT AS observed, sum(pd_a) AS expected, sum(pd_a * (1 - pd_a)) AS variance FROM bd GROUP BY band)"""


def test_bands(spark, d):
    return metrics.reliability(scored(spark, d).where("split = 'test'"), "pd_a", "y", "id", 10)


@query("reliability_bands", f"WITH {BANDS} SELECT band, n, observed, round(expected, 6) AS expected, round((observed - expected) / sqrt(variance), 6) AS z, abs((observed - expected) / sqrt(variance)) > 1.96 AS flagged FROM rel")
def reliability_bands(spark, d):
    return test_bands(spark, d).select("band", "n", "observed", F.round("expected", 6).alias("expected"), F.round("z", 6).alias("z"), "flagged")


@query("hosmer_lemeshow", f"WITH {BANDS} SELECT round(sum((observed - expected) * (observed - expected) / variance), 6) AS chi2, (count(*) - 2)::BIGINT AS dof FROM rel")
def hosmer_lemeshow(spark, d):
    b = test_bands(spark, d)
    return b.agg(F.round(F.sum(F.pow("z", 2)), 6).alias("chi2"), (F.count("*") - 2).alias("dof"))


def _psi_sql(label: str, ref: str, cur: str) -> str:
    return f"""a AS (SELECT {label} AS label, count(*) AS n FROM scored WHERE {ref} GROUP BY 1), b AS (SELECT {label} AS label, count(*) AS n FROM scored WHERE {cur} GROUP BY 1),
  j AS (SELECT coalesce(a.label, b.label) AS label, greatest(coalesce(a.n, 0) / (SELECT sum(n) FROM a), 1e-4) AS p, greatest(coalesce(b.n, 0) / (SELECT sum(n) FROM b), 1e-4) AS q FROM a FULL JOIN b ON a.label = b.label)"""


EDGES = "e AS (SELECT list_distinct(quantile_cont(pd_a, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges FROM scored WHERE split = 'train')"
_BIN = "(SELECT len(list_filter(edges, lambda x: x <= pd_a)) FROM e)"


@query("quantile_edges", f"WITH {SCORED}, {EDGES} SELECT round(unnest(edges), 10) AS edge FROM e")
def quantile_edges(spark, d):
    rows = scored(spark, d).where("split = 'train'")
    edges = F.array_distinct(F.percentile("pd_a", F.array(*(F.lit(i / 10) for i in range(1, 10)))))
    return rows.agg(edges.alias("edges")).select(F.explode("edges").alias("edge")).select(F.round("edge", 10).alias("edge"))


@query("psi_numeric", f"WITH {SCORED}, {EDGES}, {_psi_sql(_BIN, chr(115) + 'plit = ' + chr(39) + 'train' + chr(39), 'split = ' + chr(39) + 'test' + chr(39))} SELECT label::INTEGER AS label, round(p, {R}) AS p_ref, round(q, {R}) AS p_cur, round((q - p) * ln(q / p), {R}) AS contribution FROM j")
def psi_numeric(spark, d):
    rows = scored(spark, d)
    out = metrics.psi_numeric(rows.where("split = 'train'"), rows.where("split = 'test'"), "pd_a")
    return out.select("label", *_r("p_ref", "p_cur", "contribution"))


_LEVEL = "CASE WHEN segment IN (SELECT segment FROM scored WHERE split = 'train' AND segment <> 'BUILDING') THEN segment ELSE 'other' END"


@query("psi_categorical", f"""WITH {SCORED}, {_psi_sql(_LEVEL, "split = 'train' AND segment <> 'BUILDING'", "split = 'test'")} SELECT label, round(p, {R}) AS p_ref, round(q, {R}) AS p_cur, round((q - p) * ln(q / p), {R}) AS contribution FROM j""")
def psi_categorical(spark, d):
    rows = scored(spark, d)
    out = metrics.psi_categorical(rows.where("split = 'train' and segment <> 'BUILDING'"), rows.where("split = 'test'"), "segment")
    return out.select("label", *_r("p_ref", "p_cur", "contribution"))


@query("stability_table", f"""WITH {SCORED}, l AS (SELECT 'segment' AS feature, segment AS v, split FROM scored UNION ALL SELECT 'priority', priority, split FROM scored),
  c AS (SELECT feature, v, greatest((count(*) FILTER (split = 'train')) / (sum(count(*) FILTER (split = 'train')) OVER (PARTITION BY feature)), 1e-4) AS p,
    greatest((count(*) FILTER (split = 'test')) / (sum(count(*) FILTER (split = 'test')) OVER (PARTITION BY feature)), 1e-4) AS q FROM l GROUP BY feature, v)
  SELECT feature, round(sum((q - p) * ln(q / p)), {R}) AS psi, CASE WHEN sum((q - p) * ln(q / p)) >= 0.25 THEN 'red' WHEN sum((q - p) * ln(q / p)) >= 0.1 THEN 'amber' ELSE 'green' END AS light FROM c GROUP BY feature""")  # fmt: skip
def stability_table(spark, d):
    """All features in one grouped count: they are unpivoted first."""
    pairs = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("v")) for c in ("segment", "priority")))
    n = lambda s: F.count(F.when(F.col("split") == s, 1))
    c = scored(spark, d).select("split", F.explode(pairs).alias("p")).groupBy("p.feature", "p.v").agg(n("train").alias("a"), n("test").alias("b"))
    w = Window.partitionBy("feature")
    c = c.withColumn("p", F.greatest(ratio("a", F.sum("a").over(w)), F.lit(1e-4))).withColumn("q", F.greatest(ratio("b", F.sum("b").over(w)), F.lit(1e-4)))
    out = c.groupBy("feature").agg(F.sum((F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p"))).alias("psi"))
    return out.select("feature", F.round("psi", R).alias("psi"), light("psi", 0.1, 0.25).alias("light"))


def _average_rank(c: str) -> str:
    return f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2)"


@query("spearman", f"WITH {SCORED}, r AS (SELECT {_average_rank('risk_a')} AS a, {_average_rank('risk_b')} AS b FROM scored) SELECT round(corr(a, b), {R}) AS spearman FROM r")
def spearman(spark, d):
    return order_stats.spearman(scored(spark, d), "risk_a", "risk_b").select(*_r("spearman"))


@query("swap_set", f"WITH {SCORED} SELECT pd_a >= 0.5 AS reject_a, pd_b >= 0.5 AS reject_b, count(*)::BIGINT AS n, sum(y)::BIGINT AS bads, round(avg(y), {R}) AS bad_rate FROM scored GROUP BY ALL")
def swap_set(spark, d):
    return metrics.swap_set(scored(spark, d), "pd_a", "pd_b", "y", 0.5).withColumn("bad_rate", F.round("bad_rate", R))


@query("decision_outcomes", f"""WITH {SCORED}, {_MODELS} SELECT model, (count(*) FILTER (pd >= 0.5))::BIGINT AS rejected, round(avg((pd >= 0.5)::INTEGER), {R}) AS reject_rate,
  round(avg(y) FILTER (pd < 0.5), {R}) AS bad_rate_accepted, round((sum(y) FILTER (pd >= 0.5)) / sum(y), {R}) AS bads_caught FROM mo GROUP BY model""")  # fmt: skip
def decision_outcomes(spark, d):
    reject = F.col("pd") >= 0.5
    return models(scored(spark, d)).groupBy("model").agg(
        F.count(F.when(reject, 1)).alias("rejected"), F.round(F.avg(reject.cast("int")), R).alias("reject_rate"), F.round(F.avg(F.when(~reject, F.col("y"))), R).alias("bad_rate_accepted"),
        F.round(F.sum(F.when(reject, F.col("y"))) / F.sum("y"), R).alias("bads_caught"))


@query("equal_volume", f"""WITH {SCORED}, k AS (SELECT count(*) FILTER (pd_a >= 0.5) AS k FROM scored), r AS (SELECT *, row_number() OVER (ORDER BY pd_b DESC, id) AS place FROM scored)
  SELECT count(*)::BIGINT AS rejected, sum(y)::BIGINT AS bads FROM r WHERE place <= (SELECT k FROM k)""")  # fmt: skip
def equal_volume(spark, d):
    """Reject as many by the other model's order: a count, then the rows up to that place."""
    rows = scored(spark, d)
    k = rows.where("pd_a >= 0.5").count()
    return order_stats.numbered(rows.select("id", "pd_b", "y"), [F.desc("pd_b"), "id"]).where(F.col("place") <= k).agg(F.count("*").alias("rejected"), F.sum("y").alias("bads"))


@query("overlap_topk", f"""WITH {SCORED}, n AS (SELECT ceil(0.1 * count(*) - 1e-9)::BIGINT AS k FROM scored), a AS (SELECT id FROM scored ORDER BY risk_a DESC, id LIMIT (SELECT k FROM n)), b AS (SELECT id FROM scored ORDER BY risk_b DESC, id LIMIT (SELECT k FROM n))
  SELECT (SELECT k FROM n) AS k, count(*)::BIGINT AS shared FROM a JOIN b USING (id)""")  # fmt: skip
def overlap_topk(spark, d):
    rows = scored(spark, d)
    k = -(-rows.count() // 10)
    top = [order_stats.numbered(rows.select("id", c), [F.desc(c), "id"]).where(F.col("place") <= k).select("id") for c in ("risk_a", "risk_b")]
    return top[0].join(top[1], "id").agg(F.lit(k).cast("long").alias("k"), F.count("*").alias("shared"))


@query("score_bands", f"""WITH {SCORED}, {EDGES.replace("[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]", "[0.25, 0.5, 0.75]")} SELECT {_BIN}::INTEGER AS band, split, count(*)::BIGINT AS n, round(avg(y), {R}) AS bad_rate FROM scored GROUP BY ALL""")
def score_bands(spark, d):
    """Bands at the training rows' quantiles, applied to every split."""
    rows = scored(spark, d)
    edges = metrics.quantile_edges(rows.where("split = 'train'"), "pd_a", 4)
    return rows.groupBy(left_closed_bin("pd_a", edges).alias("band"), "split").agg(F.count("*").alias("n"), F.round(F.avg("y"), R).alias("bad_rate"))


@query("weighted_quantiles", f"""WITH {SCORED}, c AS (SELECT risk_a AS v, sum(1 + risk_b % 3) AS w FROM scored GROUP BY 1), r AS (SELECT v, sum(w) OVER (ORDER BY v) / sum(w) OVER () AS share FROM c)
  SELECT q, min(v)::INTEGER AS value FROM r, (SELECT unnest([0.1, 0.5, 0.9])::DOUBLE AS q) WHERE share >= q - 1e-12 GROUP BY q""")  # fmt: skip
def weighted_quantiles(spark, d):
    rows = scored(spark, d).withColumn("w", 1 + F.col("risk_b") % 3)
    return metrics.weighted_quantiles(rows, "risk_a", "w", [0.1, 0.5, 0.9])


_GROUPS = "seg AS (SELECT 'segment' AS dimension, segment AS grp, y, pd_a FROM scored UNION ALL SELECT 'priority', priority, y, pd_a FROM scored UNION ALL SELECT d, '(all)', y, pd_a FROM scored, (SELECT unnest(['segment', 'priority']) AS d))"


@query("segment_fairness", f"""WITH {SCORED}, {_GROUPS}, t AS (SELECT dimension, grp, count(*)::BIGINT AS n, avg((pd_a >= 0.5)::INTEGER) AS reject_rate, (sum(y) - sum(pd_a)) / sqrt(sum(pd_a * (1 - pd_a))) AS z FROM seg GROUP BY ALL)
  SELECT dimension, grp, n, round(reject_rate, {R}) AS reject_rate, round(z, 6) AS z, CASE WHEN grp <> '(all)' THEN round((1 - reject_rate) / (max(1 - reject_rate) FILTER (grp <> '(all)') OVER (PARTITION BY dimension)), {R}) END AS impact_ratio FROM t""")  # fmt: skip
def segment_fairness(spark, d):
    """Group metrics with an (all) row, and each group's acceptance against the best group's (adverse impact ratio)."""
    dims = ("segment", "priority")
    each = F.array(*(F.struct(F.lit(x).alias("dimension"), g.alias("grp")) for x in dims for g in (F.col(x), F.lit("(all)"))))
    long = scored(spark, d).withColumn("_g", F.explode(each)).select("_g.dimension", "_g.grp", "y", "pd_a")
    z = (F.sum("y") - F.sum("pd_a")) / F.sqrt(F.sum(F.col("pd_a") * (1 - F.col("pd_a"))))
    t = long.groupBy("dimension", "grp").agg(F.count("*").alias("n"), F.avg((F.col("pd_a") >= 0.5).cast("int")).alias("reject_rate"), z.alias("z"))
    one = F.col("grp") != "(all)"
    best = F.max(F.when(one, 1 - F.col("reject_rate"))).over(Window.partitionBy("dimension"))
    return t.select("dimension", "grp", "n", *_r("reject_rate"), F.round("z", 6).alias("z"), F.when(one, F.round((1 - F.col("reject_rate")) / best, R)).alias("impact_ratio"))


MONTHLY = f"{CUSTOMER_MONTHS}, mb AS (SELECT period, count(*)::BIGINT AS n, (count(*) FILTER (state = 2)) / count(*) AS rate FROM cm GROUP BY period)"
_TREND = f"{MONTHLY}, tr AS (SELECT *, avg(rate) OVER (ORDER BY period ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS baseline FROM mb)"


@query("metric_alerts", f"""WITH {_TREND}, a AS (SELECT *, rate / nullif(baseline, 0) - 1 AS change FROM tr)
  SELECT period, round(rate, {R}) AS rate, round(baseline, {R}) AS baseline, round(change, {R}) AS change, CASE WHEN change IS NULL THEN NULL WHEN change > 0.25 THEN 'red' WHEN change > 0.1 THEN 'amber' ELSE 'green' END AS light FROM a""")  # fmt: skip
def metric_alerts(spark, d):
    """Each month's rate against the mean of the twelve months before it."""
    book = customer_months(spark, d).groupBy("period").agg(F.count("*").alias("n"), F.avg((F.col("state") == 2).cast("int")).alias("rate"))
    # one row a month: a window over all of them is small
    book = book.withColumn("baseline", F.avg("rate").over(Window.orderBy("period").rowsBetween(-12, -1)))
    change = ratio("rate", "baseline") - 1
    return book.select("period", *_r("rate", "baseline"), F.round(change, R).alias("change"), light(change, 0.1, 0.25, inclusive=False).alias("light"))


@query("overall_status", f"""WITH {_TREND} SELECT CASE max(CASE WHEN rate / nullif(baseline, 0) - 1 > 0.25 THEN 2 WHEN rate / nullif(baseline, 0) - 1 > 0.1 THEN 1 ELSE 0 END) WHEN 2 THEN 'red' WHEN 1 THEN 'amber' ELSE 'green' END AS status FROM tr""")
def overall_status(spark, d):
    rank = F.coalesce(F.when(F.col("light") == "red", 2).when(F.col("light") == "amber", 1), F.lit(0))
    return metric_alerts(spark, d).agg(F.element_at(F.array(F.lit("green"), F.lit("amber"), F.lit("red")), F.max(rank) + 1).alias("status"))


@query("mix_alerts", f"""WITH {SCORED}, l AS (SELECT 'segment' AS dimension, segment AS g, year(period) AS yr FROM scored UNION ALL SELECT 'priority', priority, year(period) FROM scored),
  c AS (SELECT dimension, g, greatest((count(*) FILTER (yr < 1998)) / (sum(count(*) FILTER (yr < 1998)) OVER (PARTITION BY dimension)), 1e-4) AS p, greatest((count(*) FILTER (yr >= 1998)) / (sum(count(*) FILTER (yr >= 1998)) OVER (PARTITION BY dimension)), 1e-4) AS q FROM l GROUP BY dimension, g)
  SELECT dimension, round(sum((q - p) * ln(q / p)), {R}) AS psi, CASE WHEN sum((q - p) * ln(q / p)) > 0.25 THEN 'red' WHEN sum((q - p) * ln(q / p)) > 0.1 THEN 'amber' ELSE 'green' END AS light FROM c GROUP BY dimension""")  # fmt: skip
def mix_alerts(spark, d):
    pairs = F.array(*(F.struct(F.lit(c).alias("dimension"), F.col(c).alias("g")) for c in ("segment", "priority")))
    early = F.year("period") < 1998
    c = scored(spark, d).select(early.alias("early"), F.explode(pairs).alias("p")).groupBy("p.dimension", "p.g").agg(F.count(F.when(F.col("early"), 1)).alias("a"), F.count(F.when(~F.col("early"), 1)).alias("b"))
    w = Window.partitionBy("dimension")
    c = c.withColumn("p", F.greatest(ratio("a", F.sum("a").over(w)), F.lit(1e-4))).withColumn("q", F.greatest(ratio("b", F.sum("b").over(w)), F.lit(1e-4)))
    out = c.groupBy("dimension").agg(F.sum((F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p"))).alias("psi"))
    return out.select("dimension", F.round("psi", R).alias("psi"), light("psi", 0.1, 0.25, inclusive=False).alias("light"))


_REASONS = "list_slice(list_sort([{'p': -x.lost, 'n': x.name} for x in [{'lost': risk_a % 7 - 2, 'name': 'capacity'}, {'lost': risk_b % 5 - 1, 'name': 'history'}, {'lost': id % 4 - 1, 'name': 'tenure'}] if x.lost > 0]), 1, 2)"


@query("reason_codes", f"WITH {SCORED}, r AS (SELECT id, {_REASONS} AS t FROM scored) SELECT id, t[1].n || '=' || (-t[1].p)::INTEGER AS reason_1, t[2].n || '=' || (-t[2].p)::INTEGER AS reason_2 FROM r")
def reason_codes(spark, d):
    return with_reasons(scored(spark, d)).select("id", "reason_1", "reason_2")


def with_reasons(rows):
    """The two largest losses of points, positive ones only, ties by name."""
    lost = {"capacity": F.col("risk_a") % 7 - 2, "history": F.col("risk_b") % 5 - 1, "tenure": F.col("id") % 4 - 1}
    each = F.array(*(F.struct((-v).cast("int").alias("p"), F.lit(n).alias("n")) for n, v in lost.items()))
    top = F.slice(F.array_sort(F.filter(each, lambda x: x["p"] < 0)), 1, 2)
    rows = rows.withColumn("_t", top)
    code = lambda k: F.concat(F.get("_t", F.lit(k))["n"], F.lit("="), (-F.get("_t", F.lit(k))["p"]).cast("string"))
    return rows.withColumn("reason_1", code(0)).withColumn("reason_2", code(1)).drop("_t")


@query("watchlist_topk", f"WITH {RANKED}, w AS (SELECT *, {_REASONS} AS t FROM lst WHERE listed AND period = DATE '1998-01-01') SELECT row_number() OVER (ORDER BY risk_a DESC, id)::INTEGER AS rank, id, risk_a, t[1].n || '=' || (-t[1].p)::INTEGER AS reason_1 FROM w")
def watchlist_topk(spark, d):
    """The listed rows of a month, ranked, with their first reason."""
    month = scored(spark, d).where("period = date '1998-01-01'")
    listed = metrics.monthly_rank(month, "risk_a", "period", "id").where(metrics.top_share(0.05))
    return with_reasons(listed).select(F.col("place").alias("rank"), "id", "risk_a", "reason_1")


@query("watchlist_summary", f"WITH {SCORED}, r AS (SELECT unnest({_REASONS}) AS t FROM scored) SELECT t.n AS reason, count(*)::BIGINT AS n FROM r GROUP BY 1")
def watchlist_summary(spark, d):
    reasons = with_reasons(scored(spark, d)).select(F.explode(F.array_compact(F.array("reason_1", "reason_2"))).alias("r"))
    return reasons.groupBy(F.split("r", "=")[0].alias("reason")).agg(F.count("*").alias("n"))


@query("spread_examples", f"""WITH {SCORED}, r AS (SELECT id, pd_a, row_number() OVER (ORDER BY pd_a, id) - 1 AS k, count(*) OVER () AS n FROM scored WHERE split = 'test')
  SELECT id, round(pd_a, {R}) AS pd_a FROM r WHERE k IN (SELECT unnest([floor(i * (n - 1) / 4)::BIGINT for i in [0, 1, 2, 3, 4]]))""")  # fmt: skip
def spread_examples(spark, d):
    """Rows at evenly spaced places of the ranking."""
    rows = scored(spark, d).where("split = 'test'")
    last = F.col("place_all") - 1
    places = F.array(*(F.floor(i * last / 4) for i in range(5)))
    return order_stats.numbered(rows.select("id", "pd_a"), ["pd_a", "id"]).where(F.array_contains(places, F.col("place") - 1)).select("id", *_r("pd_a"))


MODELS = {m: (f"risk_{m}", f"pd_{m}") for m in "ab"}
SAMPLES = ("validation", "test")


def drawn(spark, d, resamples=200):
    """Resamples of both models on the validation and the test rows."""
    return uncertainty.replicates(scored(spark, d).where(F.col("split").isin(*SAMPLES)), MODELS, "y", ["split"], resamples)


@query("bootstrap_ci")
def bootstrap_ci(spark, d):
    return uncertainty.intervals(drawn(spark, d), ["split"])


@query("uncertainty_differences")
def uncertainty_differences(spark, d):
    """Model b less model a on the same draws, and validation less test rows."""
    return uncertainty.differences(drawn(spark, d), "split", [("a", "b")], [SAMPLES])


_FIGURES = f"""{_MODELS}, {_disc('risk', "model || '/' || split").replace('FROM scored', 'FROM mo')}, fig AS (SELECT split_part(k, '/', 1) AS model, split_part(k, '/', 2) AS split, wins / nullif(n_bad * n_good, 0)::DOUBLE AS auc, ks FROM m),
  br AS (SELECT model, split, avg((pd - y) * (pd - y)) AS brier FROM mo GROUP BY ALL),
  f AS (SELECT * FROM (SELECT split, model, 'auc' AS metric, auc AS value FROM fig UNION ALL SELECT split, model, 'gini', 2 * auc - 1 FROM fig UNION ALL SELECT split, model, 'ks', ks FROM fig UNION ALL SELECT split, model, 'brier', brier FROM br) WHERE split <> 'train')"""


@query("difference_estimates", f"""WITH {SCORED}, {_FIGURES}
  SELECT 'b - a' AS comparison, x.split AS split, 'both' AS model, x.metric AS metric, true AS paired, round(y.value - x.value, {R}) AS estimate FROM f x JOIN f y ON x.split = y.split AND x.metric = y.metric AND x.model = 'a' AND y.model = 'b'
  UNION ALL SELECT 'validation - test', 'validation, test', x.model, x.metric, false, round(x.value - y.value, {R}) FROM f x JOIN f y ON x.model = y.model AND x.metric = y.metric AND x.split = 'validation' AND y.split = 'test'""")  # fmt: skip
def difference_estimates(spark, d):
    """The estimates alone, which the draws do not change."""
    return uncertainty.differences(drawn(spark, d, 2), "split", [("a", "b")], [SAMPLES]).select("comparison", "split", "model", "metric", "paired", *_r("estimate"))


@query("uncertainty_checks", f"""WITH {SCORED}, {_FIGURES} SELECT c AS "check", split, model, metric, round(value, {R}) AS claimed, true AS ok FROM f, (SELECT unnest(['interval contains the estimate', 'estimate equals the published figure']) AS c)""")
def uncertainty_checks(spark, d):
    """Intervals against their estimates, estimates against figures found in another way."""
    rows = models(scored(spark, d)).where(F.col("split").isin(*SAMPLES))
    figures = metrics.discrimination(rows, "risk", "y", ["model", "split"]).join(rows.groupBy("model", "split").agg(metrics.brier("pd", "y").alias("brier")), ["model", "split"])
    published = figures.unpivot(["split", "model"], list(uncertainty.METRICS), "metric", "value")
    found = uncertainty.uncertainty_checks(uncertainty.intervals(drawn(spark, d), ["split"]), published, 1e-9)
    return found.select("check", "split", "model", "metric", *_r("claimed"), "ok")


SEGMENTS = {"market": "segment", "priority": "priority", "region": "region"}
LEAST = 100


def segmented(spark, d):
    """The segments' table on validation and test rows, and the segments that the rows cannot tell apart."""
    rows = scored(spark, d).where(F.col("split").isin(*SAMPLES))
    here, gone = segments.computable(SEGMENTS, rows.columns)
    return segments.segment_table(rows, here, MODELS, "y", least=LEAST, reject_above=0.5), gone


_SEGMENTED = f"""{_MODELS}, gr AS (SELECT split, model, y, risk, pd, 'market' AS seg, segment AS grp FROM mo WHERE split <> 'train' UNION ALL SELECT split, model, y, risk, pd, 'priority', priority FROM mo WHERE split <> 'train'
    UNION ALL SELECT split, model, y, risk, pd, d, '(all)' FROM mo, (SELECT unnest(['market', 'priority']) AS d) WHERE split <> 'train'),
  {_disc('risk', "split || '|' || model || '|' || seg || '|' || grp").replace("FROM scored", "FROM gr")},
  b AS (SELECT split || '|' || model || '|' || seg || '|' || grp AS k, split, model, seg AS segment, grp, count(*)::BIGINT AS n, sum(y)::BIGINT AS bads, avg(pd) AS mean_pd, (sum(y) - sum(pd)) / sqrt(sum(pd * (1 - pd))) AS z, avg((pd > 0.5)::INTEGER) AS reject_rate FROM gr GROUP BY ALL),
  t AS (SELECT b.*, CASE WHEN n >= {LEAST} AND n_bad > 0 AND n_good > 0 THEN wins / (n_bad * n_good)::DOUBLE END AS auc, CASE WHEN n >= {LEAST} AND n_bad > 0 AND n_good > 0 THEN m.ks END AS ks FROM b JOIN m USING (k))"""


@query("segment_metrics", f"""WITH {SCORED}, {_SEGMENTED}
  SELECT split, model, segment, grp, n, bads, round(mean_pd, {R}) AS mean_pd, round(z, 6) AS calibration_z, round(reject_rate, {R}) AS reject_rate, round(auc, {R}) AS auc, round(ks, {R}) AS ks,
    CASE WHEN n < {LEAST} THEN 'few rows' WHEN bads = 0 OR bads = n THEN 'one outcome' ELSE '' END AS note,
    CASE WHEN grp <> '(all)' THEN round(auc - max(auc) FILTER (grp = '(all)') OVER w, {R}) END AS auc_gap_vs_all, CASE WHEN grp <> '(all)' THEN round(2 * (auc - max(auc) FILTER (grp = '(all)') OVER w), {R}) END AS gini_gap_vs_all,
    CASE WHEN grp <> '(all)' THEN round(ks - max(ks) FILTER (grp = '(all)') OVER w, {R}) END AS ks_gap_vs_all,
    CASE WHEN grp <> '(all)' THEN round((1 - reject_rate) / (max(1 - reject_rate) FILTER (grp <> '(all)' AND n >= {LEAST}) OVER w), {R}) END AS adverse_impact_ratio FROM t WINDOW w AS (PARTITION BY split, model, segment)""")  # fmt: skip
def segment_metrics(spark, d):
    table, _ = segmented(spark, d)
    rounded = ("mean_pd", "reject_rate", "auc", "ks", "auc_gap_vs_all", "gini_gap_vs_all", "ks_gap_vs_all", "adverse_impact_ratio")
    return table.select("split", "model", "segment", "grp", "n", "bads", *_r(*rounded), F.round("calibration_z", 6).alias("calibration_z"), "note")


@query("segment_checks", f"""WITH {SCORED} SELECT 'groups make up the split' AS "check", split, s AS segment, true AS ok FROM (SELECT DISTINCT split FROM scored WHERE split <> 'train'), (SELECT unnest(['market', 'priority']) AS s)
  UNION ALL SELECT 'columns are there', NULL, 'region', false""")  # fmt: skip
def segment_checks(spark, d):
    return segments.segment_checks(*segmented(spark, d))


@query("recalibration")
def recalibration(spark, d):
    rows = scored(spark, d).where("split = 'test'").withColumn("lo", F.ln(F.col("pd_a") / (1 - F.col("pd_a"))))
    out = metrics.recalibrate(rows, "lo", "y")
    return spark.createDataFrame([tuple(float(round(v, 9)) for v in out.values())], ", ".join(f"{k} double" for k in out))


@query("watchlist_filter", f"WITH {SCORED}, r AS (SELECT id, priority, {_REASONS} AS t FROM scored) SELECT id FROM r WHERE priority IN (SELECT DISTINCT priority FROM scored ORDER BY 1 LIMIT 2) AND (t[1].n = 'tenure' OR t[2].n = 'tenure')")
def watchlist_filter(spark, d):
    """Rows of chosen groups, any of whose reasons is a chosen one."""
    rows = with_reasons(scored(spark, d))
    groups = [r.priority for r in rows.select("priority").distinct().orderBy("priority").limit(2).collect()]
    names = F.transform(F.array_compact(F.array("reason_1", "reason_2")), lambda r: F.split(r, "=")[0])
    return rows.where(F.col("priority").isin(groups) & F.arrays_overlap(names, F.array(F.lit("tenure")))).select("id")
