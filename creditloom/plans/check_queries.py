"""Reconciliations: the same number by two ways, one row a check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.exprs import count_if
from creditloom.operators import figures, labels, metrics, sampling
from creditloom.operators.checks import check_row, check_rows
from creditloom.plans.frames import SCORED, customer_months, read, scored, user_days
from creditloom.plans.metric_queries import _FIGURES, RANKED, models
from creditloom.plans.panel_queries import BANDED, CURVES, LABELLED, USER_DAYS, curves, labelled, loans, segments, survival_loans
from creditloom.plans.panel_queries import survival_tables as survival
from creditloom.plans.registry import query


def one(*frames: DataFrame) -> DataFrame:
    """Tables of one row each, side by side."""
    return reduce(lambda a, b: a.crossJoin(b), frames)


def _sql(ctes: str, rows: list[tuple[str, str, str, str]], head: str = "WITH") -> str:
    parts = [f"SELECT '{name}' AS \"check\", ({a})::DOUBLE AS claimed, ({b})::DOUBLE AS recounted, '{src}' AS source" for name, a, b, src in rows]
    return f"{head} {ctes}, q AS ({' UNION ALL '.join(parts)}) SELECT *, coalesce(abs(claimed - recounted) <= 1e-6, false) AS ok FROM q"


@query("portfolio_checks", _sql(USER_DAYS, [
    ("rows by state", "SELECT count(*) FROM panel", "SELECT sum(n) FROM (SELECT state, count(*) AS n FROM panel GROUP BY 1)", "panel"),
    ("error days", "SELECT count(*) FROM panel WHERE state = 3", "SELECT count(DISTINCT (user_id, ts::DATE)) FROM events WHERE event_type = 'error'", "events"),
    ("rates above one", "SELECT count(*) FROM (SELECT period FROM panel GROUP BY period HAVING count(*) FILTER (state = 3) > count(*))", "0", "bounds"),
]))
def portfolio_checks(spark, d):
    p = user_days(spark, d)
    by = p.groupBy("state").agg(F.count("*").alias("n")).agg(F.sum("n").alias("by_state"))
    own = p.agg(F.count("*").alias("n"), count_if(F.col("state") == 3).alias("errors"))
    raw = read(spark, d, "events").where("event_type = 'error'").agg(F.countDistinct(F.struct("user_id", F.col("ts").cast("date"))).alias("raw_errors"))
    over = p.groupBy("period").agg(count_if(F.col("state") == 3).alias("a"), F.count("*").alias("b")).agg(count_if(F.col("a") > F.col("b")).alias("over"))
    c = F.col
    return check_rows(one(by, own, raw, over), check_row("rows by state", c("n"), c("by_state"), "panel", 1e-6), check_row("error days", c("errors"), c("raw_errors"), "events", 1e-6), check_row("rates above one", c("over"), F.lit(0), "bounds", 1e-6))


@query("vintage_checks", _sql(CURVES, [
    ("loans", "SELECT sum(loans) FROM size", "SELECT count(*) FROM loans", "loans"),
    ("defaults by month 12", "SELECT sum(defaults) FROM curves WHERE mob = 12", "SELECT count(*) FROM loans JOIN size USING (vintage) WHERE reach >= 12 AND default_mob <= 12", "loans"),
    ("curves that fall", "SELECT count(*) FROM (SELECT defaults - lag(defaults) OVER (PARTITION BY vintage ORDER BY mob) AS d FROM curves) WHERE d < 0", "0", "monotone"),
]))
def vintage_checks(spark, d):
    from pyspark.sql import Window

    ln, cv = loans(spark, d), curves(spark, d)
    first = cv.where("mob = 0").agg(F.sum("loans").alias("size"))
    n = ln.agg(F.count("*").alias("n"))
    at = cv.where("mob = 12").agg(F.sum("defaults").alias("claimed"))
    reach = ln.groupBy("vintage").agg(F.max("reachable_mob").alias("reach"))
    again = ln.join(F.broadcast(reach), "vintage").where("reach >= 12 and default_mob <= 12").agg(F.count("*").alias("again"))  # one row a vintage
    falls = cv.withColumn("d", F.col("defaults") - F.lag("defaults").over(Window.partitionBy("vintage").orderBy("mob"))).agg(count_if(F.col("d") < 0).alias("falls"))
    c = F.col
    return check_rows(one(first, n, at, again, falls), check_row("loans", c("size"), c("n"), "loans", 1e-6), check_row("defaults by month 12", c("claimed"), c("again"), "loans", 1e-6), check_row("curves that fall", c("falls"), F.lit(0), "monotone", 1e-6))


@query("concentration_checks", f"""WITH {BANDED}, b AS (SELECT period, count(*) AS n FROM cm GROUP BY period)
  SELECT dimension, count(*)::BIGINT AS periods, (count(*) FILTER (s.n = b.n))::BIGINT AS equal, count(*) = count(*) FILTER (s.n = b.n) AS ok
  FROM (SELECT dimension, period, sum(loans) AS n FROM seg GROUP BY ALL) s JOIN b USING (period) GROUP BY dimension""")  # fmt: skip
def concentration_checks(spark, d):
    """The groups of every dimension add up to the book, month by month."""
    s = segments(spark, d).groupBy("dimension", "period").agg(F.sum("loans").alias("s"))
    b = customer_months(spark, d).groupBy("period").agg(F.count("*").alias("b"))
    return s.join(b, "period").groupBy("dimension").agg(F.count("*").alias("periods"), count_if(F.col("s") == F.col("b")).alias("equal")).withColumn("ok", F.col("periods") == F.col("equal"))


@query("label_checks", _sql(LABELLED, [
    ("events point at bad months", "SELECT count(*) FROM labelled WHERE y = 1", "SELECT count(*) FROM labelled l JOIN cm p ON p.o_custkey = l.o_custkey AND p.period = (l.period + to_months(l.event_offset))::DATE WHERE l.y = 1 AND p.letter = 'B'", "panel"),
    ("bad months in good windows", "SELECT count(*) FROM labelled l JOIN cm p ON p.o_custkey = l.o_custkey AND p.period > l.period AND p.period <= (l.period + INTERVAL 3 MONTH)::DATE WHERE l.y = 0 AND p.letter = 'B' AND NOT EXISTS (SELECT 1 FROM cm e WHERE e.o_custkey = l.o_custkey AND e.period > l.period AND e.period < p.period AND e.letter = 'P')", "0", "panel"),
    ("labelled or excluded", "SELECT count(*) FROM labelled", "SELECT count(y) + count(exclusion_reason) FROM labelled", "labels"),
]))
def label_checks(spark, d):
    lab, p = labelled(spark, d), customer_months(spark, d).select("o_custkey", "period", "letter")
    own = lab.agg(count_if(F.col("y") == 1).alias("events"), F.count("*").alias("n"), (F.count("y") + F.count("exclusion_reason")).alias("said"))
    at = labels.event_rows(lab.drop("letter"), p, "o_custkey", F.add_months, ["letter"]).agg(count_if(F.col("event_letter") == "B").alias("hit"))
    ahead = F.explode(F.array(*(F.lit(k) for k in (1, 2, 3)))).alias("k")
    good = lab.where("y = 0").select("o_custkey", F.col("period").alias("t"), ahead).withColumn("period", F.add_months("t", F.col("k")))
    seen = good.join(p, ["o_custkey", "period"]).groupBy("o_custkey", "t").agg(F.min(F.when(F.col("letter") == "B", F.col("k"))).alias("bad"), F.min(F.when(F.col("letter") == "P", F.col("k"))).alias("paid"))
    wrong = seen.agg(count_if(F.col("bad").isNotNull() & ~F.coalesce(F.col("paid") < F.col("bad"), F.lit(False))).alias("wrong"))
    c = F.col
    return check_rows(one(own, at, wrong), check_row("events point at bad months", c("events"), c("hit"), "panel", 1e-6), check_row("bad months in good windows", c("wrong"), F.lit(0), "panel", 1e-6), check_row("labelled or excluded", c("n"), c("said"), "labels", 1e-6))


@query("survival_checks")
def survival_checks(spark, d):
    """Incidences and survival add up to one; everybody leaves once; defaults are all in the tables."""
    t, ln = survival(spark, d), survival_loans(spark, d)
    last = t.groupBy("vintage").agg(F.max_by(F.col("cif_default") + F.col("cif_payoff"), "mob").alias("cif"), F.max("km_default").alias("km"), F.max("cif_default").alias("cd"))
    sums = last.agg(F.max("cif").alias("most"), count_if(F.col("km") < F.col("cd") - 1e-6).alias("order"))
    n = ln.agg(F.count("*").alias("n"), count_if(F.col("cause").isin(0, 1, 2)).alias("left"))
    c = F.col
    return check_rows(one(sums, n), check_row("incidences above one", F.greatest(c("most") - 1, F.lit(0.0)), F.lit(0), "tables", 1e-6), check_row("competing above naive", c("order"), F.lit(0), "tables", 1e-6), check_row("exits", c("n"), c("left"), "loans", 1e-6))


@query("watchlist_checks", _sql(RANKED, [
    ("list sizes", "SELECT count(*) FROM lst WHERE listed", "SELECT sum(ceil(0.05 * n - 1e-9)) FROM (SELECT period, count(*) AS n FROM scored GROUP BY period)", "scores"),
    ("listed below unlisted", "SELECT count(*) FROM (SELECT period, min(risk_a) FILTER (listed) AS a, max(risk_a) FILTER (NOT listed) AS b FROM lst GROUP BY period) WHERE a < b", "0", "scores"),
]))
def watchlist_checks(spark, d):
    ranked = metrics.monthly_rank(scored(spark, d), "risk_a", "period", "id").withColumn("listed", metrics.top_share(0.05))
    by = ranked.groupBy("period").agg(F.count("*").alias("n"), count_if(F.col("listed")).alias("l"), F.min(F.when(F.col("listed"), F.col("risk_a"))).alias("a"), F.max(F.when(~F.col("listed"), F.col("risk_a"))).alias("b"))
    row = by.agg(F.sum("l").alias("l"), F.sum(F.ceil(0.05 * F.col("n") - 1e-9)).alias("want"), count_if(F.col("a") < F.col("b")).alias("wrong"))
    c = F.col
    return check_rows(row, check_row("list sizes", c("l"), c("want"), "scores", 1e-6), check_row("listed below unlisted", c("wrong"), F.lit(0), "scores", 1e-6))


@query("population_checks", _sql(SCORED, [
    ("rows", "SELECT count(*) FROM scored", "SELECT count(*) FROM orders", "orders"),
    ("distinct ids", "SELECT count(*) FROM scored", "SELECT count(DISTINCT id) FROM scored", "scored"),
    ("bads", "SELECT sum(y) FROM scored", "SELECT count(*) FROM orders WHERE o_orderstatus = ''F''".replace("''", "'"), "orders"),
    ("rows by split", "SELECT count(*) FROM scored", "SELECT sum(n) FROM (SELECT split, count(*) AS n FROM scored GROUP BY split)", "scored"),
]))
def population_checks(spark, d):
    rows = scored(spark, d)
    own = rows.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.sum("y").alias("bads"))
    raw = read(spark, d, "orders").agg(F.count("*").alias("raw"), count_if(F.col("o_orderstatus") == "F").alias("raw_bads"))
    by = rows.groupBy("split").agg(F.count("*").alias("k")).agg(F.sum("k").alias("by_split"))
    c = F.col
    return check_rows(one(own, raw, by), check_row("rows", c("n"), c("raw"), "orders", 1e-6), check_row("distinct ids", c("n"), c("ids"), "scored", 1e-6), check_row("bads", c("bads"), c("raw_bads"), "orders", 1e-6), check_row("rows by split", c("n"), c("by_split"), "scored", 1e-6))


R = 8


def held(spark, d):
    """Both models' validation and test rows."""
    return models(scored(spark, d)).where("split <> 'train'")


_HELD = f"""{_FIGURES}, ca AS (SELECT model, split, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS bads, avg(pd) AS mean_pd, avg(y) AS bad_rate, avg((pd - y) * (pd - y)) AS brier FROM mo WHERE split <> 'train' GROUP BY ALL)"""


@query("published_figures", f"""WITH {SCORED}, {_HELD}, pf AS (
    SELECT 'discrimination' AS module, model || '/' || split || '/' || metric AS key, value AS published, CASE WHEN metric = 'ks' THEN NULL ELSE value END AS recomputed FROM f WHERE metric <> 'brier'
    UNION ALL SELECT 'calibration', model || '/' || split || '/' || u.n, u.v, CASE WHEN u.n IN ('n', 'bads', 'mean_pd') THEN u.v END FROM (SELECT model, split, unnest([{{'n': 'n', 'v': n}}, {{'n': 'bads', 'v': bads}}, {{'n': 'mean_pd', 'v': mean_pd}}, {{'n': 'bad_rate', 'v': bad_rate}}, {{'n': 'brier', 'v': brier}}]) AS u FROM ca))
  SELECT module, key, round(published, {R}) AS published, round(recomputed, {R}) AS recomputed, CASE WHEN recomputed IS NULL THEN 'not recomputed' ELSE '' END AS problem, recomputed IS NOT NULL AS ok FROM pf""")  # fmt: skip
def published_figures(spark, d):
    """The figures of two modules against those found in a second way: AUC and Gini by ranks, sizes, bads and mean PD by the
    reliability bands. What has no second way is reported as such."""
    rows, by = held(spark, d), ["model", "split"]
    published = figures.discrimination_figures(rows, "risk", "y", by).unionByName(figures.calibration_figures(rows, "pd", "y", by))
    again = [figures.discrimination_identities(rows, "risk", "y", by)]
    again += [figures.band_totals(rows.where((F.col("model") == m) & (F.col("split") == s)), "pd", "y", "id", 10, {"model": m, "split": s}) for m in "ab" for s in ("validation", "test")]
    found = figures.compare(published, reduce(DataFrame.unionByName, again), {"discrimination": 1e-9, "calibration": 1e-6})
    return found.select("module", "key", F.round("published", R).alias("published"), F.round("recomputed", R).alias("recomputed"), "problem", "ok")


_TEST = "te AS (SELECT *, row_number() OVER (ORDER BY risk_a DESC, id) AS pa, row_number() OVER (ORDER BY risk_b DESC, id) AS pb, count(*) OVER () AS n, rank() OVER (ORDER BY risk_a) + (count(*) OVER (PARTITION BY risk_a) - 1) / 2.0 AS ra, rank() OVER (ORDER BY risk_b) + (count(*) OVER (PARTITION BY risk_b) - 1) / 2.0 AS rb FROM scored WHERE split = 'test'), k AS (SELECT ceil(0.1 * count(*) - 1e-9) AS k, count(*) FILTER (pd_a >= 0.5) AS qa, count(*) FILTER (pd_b >= 0.5) AS qb FROM te)"


@query("head_to_head", f"""WITH {SCORED}, {_TEST}, r AS (
    SELECT 'agreement' AS module, 'spearman' AS key, corr(ra, rb) AS value FROM te
    UNION ALL SELECT 'agreement', 'top_overlap', (count(*) FILTER (pa <= k AND pb <= k))::DOUBLE / count(*) FILTER (pa <= k) FROM te, k
    UNION ALL SELECT 'agreement', 'bad_rate_only_first_top', avg(y) FILTER (pa <= k AND pb > k) FROM te, k UNION ALL SELECT 'agreement', 'bad_rate_only_second_top', avg(y) FILTER (pb <= k AND pa > k) FROM te, k
    UNION ALL SELECT 'swap_set', c || '/' || u.n, u.v FROM (SELECT c, unnest([{{'n': 'n', 'v': count(*)::DOUBLE}}, {{'n': 'bads', 'v': sum(y)::DOUBLE}}]) AS u FROM (SELECT y, CASE WHEN pd_a >= 0.5 AND pd_b >= 0.5 THEN 'both reject' WHEN pd_a >= 0.5 THEN 'only first rejects' WHEN pd_b >= 0.5 THEN 'only second rejects' ELSE 'both accept' END AS c FROM te) GROUP BY c)
    UNION ALL SELECT 'decisions', 'rejects_first', qa FROM k UNION ALL SELECT 'decisions', 'rejects_second', qb FROM k
    UNION ALL SELECT 'equal_volume', 'bads_second_at_first_volume', sum(y) FILTER (pb <= qa) FROM te, k UNION ALL SELECT 'equal_volume', 'bads_first_at_second_volume', sum(y) FILTER (pa <= qb) FROM te, k)
  SELECT module, key, round(value, {R}) AS value FROM r""")  # fmt: skip
def head_to_head(spark, d):
    rows = scored(spark, d).where("split = 'test'")
    return figures.head_to_head(rows, ("risk_a", "risk_b"), ("pd_a", "pd_b"), "y", "id", 0.5).select("module", "key", F.round("value", R).alias("value"))


@query("comparison_checks", f"""WITH {SCORED}, t AS (SELECT count(*)::DOUBLE AS n, (count(*) FILTER (pd_a >= 0.5))::DOUBLE AS a, (count(*) FILTER (pd_b >= 0.5))::DOUBLE AS b FROM scored WHERE split = 'test')
  SELECT 'comparison' AS module, u.k AS key, u.v AS published, u.v AS recomputed, '' AS problem, true AS ok FROM (SELECT unnest([{{'k': 'rows', 'v': n}}, {{'k': 'rejects_first', 'v': a}}, {{'k': 'rejects_second', 'v': b}}]) AS u FROM t)""")  # fmt: skip
def comparison_checks(spark, d):
    """The cells of the swap set against the rows and against each model's decisions."""
    rows = scored(spark, d).where("split = 'test'")
    sides = figures.comparison_identities(figures.head_to_head(rows, ("risk_a", "risk_b"), ("pd_a", "pd_b"), "y", "id", 0.5), rows.count())
    side = lambda name: sides.where(F.col("side") == name).drop("side")
    return figures.compare(side("published"), side("recomputed"))


@query("side_by_side", f"""WITH {SCORED}, {_HELD} SELECT g.model AS model, ca.n::BIGINT AS n, ca.bads::BIGINT AS bads, round(g.auc, {R}) AS auc, round(2 * g.auc - 1, {R}) AS gini, round(g.ks, {R}) AS ks, round(ca.brier, {R}) AS brier, round(ca.bads / (ca.n * ca.mean_pd), {R}) AS ratio_bad_rate_to_pd, true AS auc_inside
  FROM fig g JOIN ca ON g.model = ca.model AND g.split = ca.split WHERE g.split = 'test'""")  # fmt: skip
def side_by_side(spark, d):
    """Both models on the test rows, from the tables of all modules."""
    from creditloom.operators import uncertainty
    from creditloom.plans.metric_queries import drawn, segmented
    from creditloom.plans.model_queries import stability_measures

    rows = held(spark, d).where("split = 'test'")
    by = ["model", "split"]
    sums = rows.groupBy(*by).agg(metrics.brier("pd", "y").alias("brier"), (F.sum("y") / F.sum("pd")).alias("ratio_bad_rate_to_pd"))
    lo = rows.withColumn("lo", F.ln(F.col("pd") / (1 - F.col("pd"))))
    fits = [(m, "test", float(metrics.recalibrate(lo.where(F.col("model") == m), "lo", "y")["slope"])) for m in "ab"]
    bands = [metrics.reliability(rows.where(F.col("model") == m), "pd", "y", "id", 10).agg(count_if(F.col("flagged")).alias("flagged_bands")).withColumn("model", F.lit(m)) for m in "ab"]
    calibration = sums.join(spark.createDataFrame(fits, "model string, split string, slope double"), by).join(bands[0].unionByName(bands[1]), "model")
    out = figures.side_by_side(metrics.discrimination(rows, "risk", "y", by), uncertainty.intervals(drawn(spark, d), ["split"]), calibration, stability_measures(spark, d), segmented(spark, d)[0], "test")
    rounded = [F.round(c, R).alias(c) for c in ("auc", "gini", "ks", "brier", "ratio_bad_rate_to_pd")]
    return out.select("model", "n", "bads", *rounded, F.col("auc").between(F.col("auc_ci_low"), F.col("auc_ci_high")).alias("auc_inside"))


@query("quota_sample", f"""WITH {SCORED}, h AS (SELECT *, md5(id || ':23') AS h FROM scored), q AS (SELECT id, split, segment, row_number() OVER (PARTITION BY split, segment ORDER BY h, id) AS place, count(*) OVER (PARTITION BY split, segment) AS size, count(*) OVER () AS n FROM h)
  SELECT id, split, segment FROM q WHERE place <= least(size, greatest(1, floor(size::DOUBLE / n * 200 + 0.5)))""")  # fmt: skip
def quota_sample(spark, d):
    """Some 200 rows, by split and segment, one of each at least."""
    return sampling.quota_sample(scored(spark, d), "id", ["split", "segment"], 200, 23).select("id", "split", "segment")
