"""Queries over flows of a daily book, alerts of several metrics, and stability of scores and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.operators import flows, panel, stability
from creditloom.operators.stability import Watched
from creditloom.plans.frames import SCORED, USER_DAYS, scored, user_days
from creditloom.plans.registry import query

R = 8
STATES = (0, 1, 2, 3)
EXIT = "state = 3"  # an error ends a user's day on the book
TRAILING, AMBER, RED = 7, 0.1, 0.25
WATCHED = {"rate_2plus": "higher", "exit_rate": "higher", "entry_rate": "lower", "unseen_rate": "higher"}
CURRENTS = ("validation", "test")
COLUMNS = [Watched("output", "a", "pd_a"), Watched("output", "b", "pd_b"), Watched("feature", "a", "amount"), Watched("feature", "a", "priority"), Watched("feature", "b", "amount")]


def monthly(spark, d):
    return flows.flows(user_days(spark, d), "user_id", EXIT)


FLOWS = f"""{USER_DAYS}, m AS (SELECT a.period, coalesce(a.state = 3, false) AS gone, b.user_id IS NOT NULL AS was FROM panel a LEFT JOIN panel b ON b.user_id = a.user_id AND b.period = a.period - 1 AND NOT coalesce(b.state = 3, false)),
f0 AS (SELECT period, (count(*) FILTER (was))::BIGINT AS start_loans, (count(*) FILTER (was AND gone))::BIGINT AS exits_from_start, (count(*) FILTER (NOT was AND gone))::BIGINT AS exits_outside_start,
  (count(*) FILTER (NOT was AND NOT gone))::BIGINT AS entries_active, (count(*) FILTER (NOT gone))::BIGINT AS end_loans FROM m GROUP BY 1),
flows AS (SELECT f0.*, (p.end_loans - f0.start_loans)::BIGINT AS gone_unseen FROM f0 LEFT JOIN f0 p ON p.period = f0.period - 1)"""


@query("book_flows", f"WITH {FLOWS} SELECT * FROM flows")
def book_flows(spark, d):
    return monthly(spark, d)


@query("flow_checks", f"""WITH {FLOWS}, q AS (SELECT 'exits of all periods' AS "check", (SELECT count(*) FROM panel WHERE state = 3)::DOUBLE AS claimed, (SELECT sum(exits_from_start + exits_outside_start) FROM flows)::DOUBLE AS recounted, 'panel' AS source
  UNION ALL SELECT 'end = start - exits + entries', 0, (SELECT count(*) FROM flows WHERE start_loans - exits_from_start + entries_active <> end_loans), 'flows'
  UNION ALL SELECT 'periods that begin with more than was left', 0, (SELECT count(*) FROM flows WHERE gone_unseen < 0), 'flows') SELECT *, claimed = recounted AS ok FROM q""")  # fmt: skip
def flow_checks(spark, d):
    return flows.flow_checks(monthly(spark, d), user_days(spark, d), EXIT)


@query("flow_alerts", f"""WITH {FLOWS}, t AS (SELECT p.period, (count(*) FILTER (state >= 2)) / nullif(count(state), 0) AS rate_2plus, any_value(exits_from_start / nullif(start_loans, 0)) AS exit_rate, any_value(entries_active / nullif(end_loans, 0)) AS entry_rate,
  any_value(gone_unseen / nullif(start_loans + gone_unseen, 0)) AS unseen_rate FROM panel p LEFT JOIN flows USING (period) GROUP BY 1),
l AS (SELECT period, 'rate_2plus' AS metric, rate_2plus AS value, 1 AS sign FROM t UNION ALL SELECT period, 'exit_rate', exit_rate, 1 FROM t UNION ALL SELECT period, 'entry_rate', entry_rate, -1 FROM t UNION ALL SELECT period, 'unseen_rate', unseen_rate, 1 FROM t),
b AS (SELECT *, avg(value) OVER w AS baseline, (count(*) OVER w)::BIGINT AS periods_before FROM l WINDOW w AS (PARTITION BY metric ORDER BY period ROWS BETWEEN {TRAILING} PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, value / nullif(baseline, 0) - 1 AS change FROM b)
SELECT period, metric, round(value, {R}) AS value, round(baseline, {R}) AS baseline, periods_before, round(change, {R}) AS change, CASE WHEN change IS NULL THEN NULL WHEN sign * change > {RED} THEN 'red' WHEN sign * change > {AMBER} THEN 'amber' ELSE 'green' END AS light FROM c""")  # fmt: skip
def flow_alerts(spark, d):
    book = panel.monthly_book(user_days(spark, d), "state", STATES, "value")
    found = flows.trailing_alerts(flows.with_flow_rates(book, monthly(spark, d)), WATCHED, TRAILING, AMBER, RED)
    return found.withColumns({c: F.round(c, R) for c in ("value", "baseline", "change")})


def found(spark, d):
    return stability.stability(stability.label_counts(scored(spark, d), "split", "train", CURRENTS, COLUMNS, "segment"))


_LONG = " UNION ALL ".join(
    f"SELECT '{w.kind}' AS kind, '{w.model}' AS model, '{w.column}' AS name, {seg} AS segment, split, {w.column if w.column != 'priority' else 'NULL'}::DOUBLE AS v, {'priority' if w.column == 'priority' else 'NULL'}::VARCHAR AS lv FROM scored"
    for w in COLUMNS for seg in (("'all'", "segment") if w.kind == "output" else ("'all'",))
)
STABILITY = f"""{SCORED}, long AS ({_LONG}), cuts AS (SELECT kind, model, name, segment, list_distinct(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e, list(DISTINCT lv) AS known FROM long WHERE split = 'train' GROUP BY ALL),
lab AS (SELECT kind, model, name, segment, split, coalesce(CASE WHEN lv IS NOT NULL THEN CASE WHEN list_contains(known, lv) THEN lv ELSE 'other' END END, len(list_filter(e, lambda x: x <= v))::VARCHAR) AS label FROM long JOIN cuts USING (kind, model, name, segment)),
n AS (SELECT kind, model, name, segment, split, label, count(*) AS n FROM lab GROUP BY ALL), keys AS (SELECT DISTINCT kind, model, name, segment, label FROM n), cur AS (SELECT unnest(['validation', 'test']) AS current),
j AS (SELECT k.*, cur.current, coalesce(a.n, 0) AS na, coalesce(b.n, 0) AS nb FROM keys k CROSS JOIN cur LEFT JOIN n a ON a.split = 'train' AND (a.kind, a.model, a.name, a.segment, a.label) = (k.kind, k.model, k.name, k.segment, k.label)
  LEFT JOIN n b ON b.split = cur.current AND (b.kind, b.model, b.name, b.segment, b.label) = (k.kind, k.model, k.name, k.segment, k.label)),
s AS (SELECT *, greatest(na / sum(na) OVER g, 1e-4) AS p, greatest(nb / sum(nb) OVER g, 1e-4) AS q FROM j WINDOW g AS (PARTITION BY kind, model, name, segment, current)),
psi AS (SELECT kind, model, name, segment, current, sum(na)::BIGINT AS n_reference, sum(nb)::BIGINT AS n_current, sum((q - p) * ln(q / p)) AS psi FROM s GROUP BY ALL)"""


@query("stability_recount", f"""WITH {STABILITY} SELECT kind, model, name, segment, current, n_reference, n_current, 0.0::DOUBLE AS missing_reference, 0.0::DOUBLE AS missing_current, round(psi, {R}) AS psi,
  CASE WHEN psi > 0.25 THEN 'red' WHEN psi >= 0.1 THEN 'amber' ELSE 'green' END AS light FROM psi WHERE n_reference > 0 AND n_current > 0""")  # fmt: skip
def stability_recount(spark, d):
    return found(spark, d).withColumn("psi", F.round("psi", R))


@query("stability_checks", f"""WITH {STABILITY} SELECT 'stable: ' || model || ' ' || name || ' ' || current AS "check", 0.0::DOUBLE AS claimed, round(psi, {R}) AS recounted, 'recount' AS source, psi <= 0.1 AS ok FROM psi WHERE segment = 'all' AND current <> 'test'""")
def stability_checks(spark, d):
    return stability.stability_checks(found(spark, d), "test", 0.1).withColumn("recounted", F.round("recounted", R))
