"""Queries over panels: transitions, books, vintages, labels, look-back features."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from creditloom.functions.exprs import band, count_if, exact_sum, month_index, ratio, regime, segment_of
from creditloom.operators import labels, panel, survival
from creditloom.plans.frames import CUSTOMER_MONTHS, USER_DAYS, customer_months, user_days
from creditloom.plans.registry import query

R = 8  # decimals of rounded results


def _r(*names):
    return [F.round(n, R).alias(n) for n in names]


def flagged_days(spark, d):
    return panel.flag_panel(user_days(spark, d), "user_id", "state", F.col("state") == 3, carried=["value"])


FLAGGED = f"""{USER_DAYS}, flagged AS (SELECT *, state = 3 AS is_bad,
  coalesce(period = min(CASE WHEN state = 3 THEN period END) OVER (PARTITION BY user_id), false) AS first_bad,
  coalesce(period > min(CASE WHEN state = 3 THEN period END) OVER (PARTITION BY user_id), false) AS ever_bad_before,
  coalesce(lag(period) OVER w = period - 1, false) AS has_prev,
  CASE WHEN lag(period) OVER w = period - 1 THEN lag(state) OVER w END AS prev_state,
  CASE WHEN lag(period) OVER w = period - 1 THEN lag(value) OVER w END AS prev_value
  FROM panel WINDOW w AS (PARTITION BY user_id ORDER BY period))"""
COUNTS = f"""{FLAGGED}, counts AS (SELECT period, prev_state AS from_state, state AS to_state, count(*)::BIGINT AS entities,
  sum(CAST(prev_value AS DECIMAL(28,10)))::DOUBLE AS weight FROM flagged WHERE has_prev GROUP BY ALL)"""


@query("panel_flags", f"WITH {FLAGGED} SELECT user_id, period, state, is_bad, first_bad, ever_bad_before, has_prev, prev_state FROM flagged")
def panel_flags(spark, d):
    return flagged_days(spark, d).select("user_id", "period", "state", "is_bad", "first_bad", "ever_bad_before", "has_prev", "prev_state")


def counts(spark, d):
    return panel.transition_counts(flagged_days(spark, d), "state", "value")


@query("roll_transition_counts", f"WITH {COUNTS} SELECT period, from_state, to_state, entities, round(weight, 4) AS weight FROM counts")
def roll_transition_counts(spark, d):
    return counts(spark, d).withColumn("weight", F.round("weight", 4))


@query("roll_matrix", f"""WITH {COUNTS}, t AS (SELECT from_state, to_state, sum(entities)::BIGINT AS entities FROM counts GROUP BY ALL)
  SELECT *, round(entities / sum(entities) OVER (PARTITION BY from_state), {R}) AS share FROM t""")  # fmt: skip
def roll_matrix(spark, d):
    return panel.matrix(counts(spark, d)).withColumn("share", F.round("share", R))


@query("roll_matrix_wide", f"""WITH {COUNTS}, t AS (SELECT from_state, to_state, sum(entities)::BIGINT AS n FROM counts GROUP BY ALL)
  SELECT from_state, {", ".join(f"sum(n) FILTER (to_state = {k})::BIGINT AS to_{k}" for k in range(4))} FROM t GROUP BY from_state""")  # fmt: skip
def roll_matrix_wide(spark, d):
    wide = counts(spark, d).groupBy("from_state").pivot("to_state", [0, 1, 2, 3]).agg(F.sum("entities"))
    return wide.select("from_state", *(F.col(str(k)).alias(f"to_{k}") for k in range(4)))


@query("roll_rates", f"""WITH {COUNTS} SELECT period, sum(entities)::BIGINT AS total,
  round(coalesce(sum(entities) FILTER (to_state > from_state), 0) / sum(entities), {R}) AS roll_rate,
  round(coalesce(sum(entities) FILTER (to_state < from_state), 0) / nullif(sum(entities) FILTER (from_state > 0), 0), {R}) AS cure_rate
  FROM counts GROUP BY period""")  # fmt: skip
def roll_rates(spark, d):
    return panel.roll_rates(counts(spark, d)).select("period", "total", *_r("roll_rate", "cure_rate"))


@query("self_join_transitions", f"""WITH {USER_DAYS} SELECT b.period, a.state AS from_state, b.state AS to_state, count(*)::BIGINT AS entities
  FROM panel a JOIN panel b ON a.user_id = b.user_id AND b.period = a.period + 1 GROUP BY ALL""")  # fmt: skip
def self_join_transitions(spark, d):
    return panel.transitions_by_join(user_days(spark, d), "user_id", "state", lambda p, k: F.date_add(p, k))


_STATES = (0, 1, 2, 3)


@query("monthly_book", f"""WITH {USER_DAYS} SELECT period, count(*)::BIGINT AS loans, count(state)::BIGINT AS known_loans, (count(*) - count(state))::BIGINT AS unknown_loans,
  round(sum(CAST(value AS DECIMAL(28,10)))::DOUBLE, 4) AS weight,
  {", ".join(f"(count(*) FILTER (state = {s}))::BIGINT AS loans_{s}, round((count(*) FILTER (state = {s})) / nullif(count(state), 0), {R}) AS rate_{s}" for s in _STATES)},
  round((count(*) FILTER (state >= 2)) / nullif(count(state), 0), {R}) AS rate_2plus FROM panel GROUP BY period""")  # fmt: skip
def monthly_book(spark, d):
    book = panel.monthly_book(user_days(spark, d), "state", _STATES, "value")
    return book.select("period", "loans", "known_loans", "unknown_loans", F.round("weight", 4).alias("weight"), *(f"loans_{s}" for s in _STATES), *_r(*(f"rate_{s}" for s in _STATES), "rate_2plus"))


_REGIMES = [("late", "2024-01-11"), ("last", "2024-01-21")]


@query("regime_summary", f"""WITH {USER_DAYS}, b AS (SELECT period, (count(*) FILTER (state = 3)) / count(*) AS r FROM panel GROUP BY period)
  SELECT CASE WHEN period >= DATE '2024-01-21' THEN 'last' WHEN period >= DATE '2024-01-11' THEN 'late' ELSE 'early' END AS regime,
  count(*)::BIGINT AS periods, round(avg(r), {R}) AS mean_rate FROM b GROUP BY 1""")  # fmt: skip
def regime_summary(spark, d):
    book = panel.monthly_book(user_days(spark, d), "state", _STATES, "value").withColumn("regime", regime("period", _REGIMES, "early"))
    return book.groupBy("regime").agg(F.count("*").alias("periods"), F.round(F.avg("rate_3"), R).alias("mean_rate"))


_DIMS = ("size_band", "vintage_band", "letter")
_SIZES = [("small", None, 100000.0), ("middle", 100000.0, 250000.0), ("large", 250000.0, None)]


def banded_months(spark, d):
    p = customer_months(spark, d).withColumn("size_band", band("amount", _SIZES))
    return p.withColumn("vintage_band", segment_of("first_period", {"to_1996": ("1990-01-01", "1996-12-31"), "to_1998": ("1997-01-01", "1998-12-31")}))


BANDED = f"""{CUSTOMER_MONTHS}, banded AS (SELECT *, CASE WHEN amount IS NULL THEN 'missing' WHEN amount <= 100000 THEN 'small' WHEN amount <= 250000 THEN 'middle' ELSE 'large' END AS size_band,
  CASE WHEN first_period BETWEEN DATE '1990-01-01' AND DATE '1996-12-31' THEN 'to_1996' WHEN first_period BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' THEN 'to_1998' END AS vintage_band FROM cm),
seg AS ({" UNION ALL ".join(f"SELECT '{x}' AS dimension, coalesce({x}, 'missing') AS grp, period, count(*)::BIGINT AS loans, (count(*) FILTER (state = 2))::BIGINT AS bad, sum(CAST(amount AS DECIMAL(28,10)))::DOUBLE AS amount FROM banded GROUP BY ALL" for x in _DIMS)})"""


def segments(spark, d):
    return panel.segment_table(banded_months(spark, d), _DIMS, [F.count("*").alias("loans"), count_if(F.col("state") == 2).alias("bad"), exact_sum("amount").alias("amount")])


@query("segment_table", f"WITH {BANDED} SELECT dimension, grp, period, loans, bad, round(amount, 2) AS amount FROM seg")
def segment_table(spark, d):
    return segments(spark, d).withColumn("amount", F.round("amount", 2))


@query("concentration_hhi", f"""WITH {BANDED}, t AS (SELECT dimension, grp, sum(loans)::BIGINT AS loans FROM seg GROUP BY ALL),
  s AS (SELECT *, loans / sum(loans) OVER (PARTITION BY dimension) AS share FROM t)
  SELECT dimension, round(sum(share * share), {R}) AS hhi, count(*)::BIGINT AS groups, arg_max(grp, struct_pack(a := share, b := grp)) AS top_group, round(max(share), {R}) AS top_share FROM s GROUP BY dimension""")  # fmt: skip
def concentration_hhi(spark, d):
    total = segments(spark, d).groupBy("dimension", "grp").agg(F.sum("loans").alias("loans"))
    return panel.concentration(total, "loans").select("dimension", *_r("hhi"), "groups", "top_group", *_r("top_share"))


@query("segment_shares", f"""WITH {BANDED} SELECT dimension, grp, period, round(loans / sum(loans) OVER (PARTITION BY dimension, period), {R}) AS share,
  round(bad / nullif(loans, 0), {R}) AS bad_rate FROM seg""")  # fmt: skip
def segment_shares(spark, d):
    w = Window.partitionBy("dimension", "period")
    return segments(spark, d).select("dimension", "grp", "period", F.round(F.col("loans") / F.sum("loans").over(w), R).alias("share"), F.round(ratio("bad", "loans"), R).alias("bad_rate"))


def loans(spark, d):
    p = customer_months(spark, d)
    end = p.agg(F.max("period").alias("end"))
    # a table of one row
    p = p.crossJoin(F.broadcast(end))
    left = F.col("last_mob") * 0 + (month_index("end") - month_index("last_period"))
    out = p.groupBy("o_custkey", "vintage", "end").agg(
        F.min(F.when(F.col("state") == 2, F.col("mob"))).alias("default_mob"), F.min(F.when(F.col("state") == 1, F.col("mob"))).alias("payoff_mob"), F.min("mob").alias("first_mob"),
        F.max("period").alias("last_period"), F.max("mob").alias("last_mob"), F.min_by("amount", "period").alias("amount"),
    )
    return out.withColumn("reachable_mob", F.col("last_mob") + left).drop("end", "last_period", "last_mob")


LOANS = f"""{CUSTOMER_MONTHS}, loans AS (SELECT o_custkey, vintage, min(mob) FILTER (state = 2) AS default_mob, min(mob) FILTER (state = 1) AS payoff_mob, min(mob) AS first_mob,
  arg_min(amount, period) AS amount, (max(mob) + (SELECT max(year(period) * 12 + month(period)) FROM cm) - max(year(period) * 12 + month(period)))::INTEGER AS reachable_mob FROM cm GROUP BY ALL)"""


@query("loan_outcomes", f"WITH {LOANS} SELECT o_custkey, vintage, default_mob, payoff_mob, first_mob, round(amount, 4) AS amount, reachable_mob FROM loans")
def loan_outcomes(spark, d):
    return loans(spark, d).withColumn("amount", F.round("amount", 4))


_MOBS = list(range(0, 61, 6))
CURVES = f"""{LOANS}, size AS (SELECT vintage, count(*)::BIGINT AS loans, sum(CAST(amount AS DECIMAL(28,10)))::DOUBLE AS total, max(reachable_mob) AS reach FROM loans GROUP BY vintage),
curves AS (SELECT s.vintage, m.mob, s.loans, (count(l.o_custkey))::BIGINT AS defaults, round(count(l.o_custkey) / s.loans, {R}) AS rate_count,
  round(coalesce(sum(CAST(l.amount AS DECIMAL(28,10)))::DOUBLE, 0) / s.total, {R}) AS rate_amount
  FROM size s JOIN (SELECT unnest(range(0, 61)) AS mob) m ON m.mob <= s.reach LEFT JOIN loans l ON l.vintage = s.vintage AND l.default_mob <= m.mob GROUP BY s.vintage, m.mob, s.loans, s.total)"""


def curves(spark, d):
    return panel.vintage_curves(loans(spark, d), "vintage", range(61))


@query("vintage_curves", f"WITH {CURVES} SELECT vintage, mob::INTEGER AS mob, loans, defaults, rate_count, rate_amount FROM curves")
def vintage_curves(spark, d):
    return curves(spark, d).select("vintage", "mob", "loans", "defaults", *_r("rate_count", "rate_amount"))


@query("vintage_checkpoints", f"""WITH {CURVES} SELECT vintage, {", ".join(f"max(rate_count) FILTER (mob = {m}) AS mob_{m}" for m in (6, 12, 24))} FROM curves GROUP BY vintage""")
def vintage_checkpoints(spark, d):
    wide = curves(spark, d).groupBy("vintage").pivot("mob", [6, 12, 24]).agg(F.max(F.round("rate_count", R)))
    return wide.select("vintage", *(F.col(str(m)).alias(f"mob_{m}") for m in (6, 12, 24)))


@query("last_reportable_mob", f"""WITH {LOANS}, r AS (SELECT vintage, reachable_mob, row_number() OVER (PARTITION BY vintage ORDER BY reachable_mob) - 1 AS k,
  count(*) OVER (PARTITION BY vintage) AS n FROM loans) SELECT vintage, reachable_mob AS quantile FROM r WHERE k = floor(0.1 * (n - 1) + 1e-9)""")  # fmt: skip
def last_reportable_mob(spark, d):
    return panel.quantile_row(loans(spark, d).select("vintage", "reachable_mob"), "vintage", "reachable_mob", 0.1)


def labelled(spark, d):
    p = customer_months(spark, d).select("o_custkey", "period", "letter", "vintage")
    return labels.label_windows(p, "o_custkey", "letter", 3, F.add_months)


_AT = ", ".join("CASE " + " ".join(f"WHEN p{j} = (period + INTERVAL {k} MONTH)::DATE THEN s{j}" for j in range(1, k + 1)) + f" END AS m{k}" for k in (1, 2, 3))


def _label_case(inner: str) -> str:
    out = "0" if inner == "y" else "NULL"
    for k in (3, 2, 1):
        out = f"CASE m{k} WHEN 'B' THEN {1 if inner == 'y' else k} {'WHEN ' + chr(39) + 'P' + chr(39) + ' THEN 0' if inner == 'y' else ''} WHEN 'N' THEN {out} END"
    return out


LABELLED = f"""{CUSTOMER_MONTHS}, led AS (SELECT o_custkey, period, letter, vintage,
  coalesce(period > min(CASE WHEN letter = 'B' THEN period END) OVER l, false) AS ever_bad_before,
  coalesce(period >= min(CASE WHEN letter = 'P' THEN period END) OVER l, false) AS ended,
  {", ".join(f"lead(period, {j}) OVER w AS p{j}, lead(letter, {j}) OVER w AS s{j}" for j in (1, 2, 3))}
  FROM cm WINDOW w AS (PARTITION BY o_custkey ORDER BY period), l AS (PARTITION BY o_custkey)),
win AS (SELECT *, {_AT}, CASE WHEN ended THEN 'inactive_at_t' WHEN letter = 'B' THEN 'already_bad_at_t' END AS blocked FROM led),
lab AS (SELECT o_custkey, period, vintage, letter, ever_bad_before, (CASE WHEN blocked IS NULL THEN {_label_case("y")} END)::INTEGER AS y,
  (CASE WHEN blocked IS NULL THEN {_label_case("o")} END)::INTEGER AS event_offset, blocked FROM win),
labelled AS (SELECT * EXCLUDE (blocked), coalesce(blocked, CASE WHEN y IS NULL THEN 'incomplete_performance_window' END) AS exclusion_reason FROM lab)"""


@query("label_windows", f"WITH {LABELLED} SELECT o_custkey, period, ever_bad_before, y, event_offset, exclusion_reason FROM labelled")
def label_windows(spark, d):
    return labelled(spark, d).select("o_custkey", "period", "ever_bad_before", "y", "event_offset", "exclusion_reason")


@query("label_exclusions", f"""WITH {LABELLED} SELECT vintage, coalesce(exclusion_reason, 'labelled') AS reason, count(*)::BIGINT AS rows, count(y)::BIGINT AS labelled,
  sum(y)::BIGINT AS events, round(avg(y), {R}) AS event_rate, count(DISTINCT o_custkey)::BIGINT AS entities FROM labelled GROUP BY ALL""")  # fmt: skip
def label_exclusions(spark, d):
    return labelled(spark, d).groupBy("vintage", F.coalesce("exclusion_reason", F.lit("labelled")).alias("reason")).agg(
        F.count("*").alias("rows"), F.count("y").alias("labelled"), F.sum("y").alias("events"), F.round(F.avg("y"), R).alias("event_rate"), F.countDistinct("o_custkey").alias("entities"))


@query("event_rows", f"""WITH {LABELLED} SELECT l.o_custkey, l.period, (l.period + to_months(l.event_offset))::DATE AS event_period, p.letter AS event_letter
  FROM labelled l LEFT JOIN cm p ON p.o_custkey = l.o_custkey AND p.period = (l.period + to_months(l.event_offset))::DATE WHERE l.y = 1""")  # fmt: skip
def event_rows(spark, d):
    found = labels.event_rows(labelled(spark, d).drop("letter"), customer_months(spark, d).select("o_custkey", "period", "letter"), "o_custkey", F.add_months, ["letter"])
    return found.select("o_custkey", "period", "event_period", "event_letter")


@query("next_bad_frame", f"""WITH {CUSTOMER_MONTHS} SELECT o_custkey, period, coalesce(max((letter = 'B')::INTEGER) OVER (PARTITION BY o_custkey ORDER BY period
  ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), 0) AS next_bad FROM cm""")  # fmt: skip
def next_bad_frame(spark, d):
    return labels.next_bad_within(customer_months(spark, d), "o_custkey", F.col("letter") == "B", 3).select("o_custkey", "period", "next_bad")


@query("lookback_features", f"""WITH {CUSTOMER_MONTHS}, i AS (SELECT *, year(period) * 12 + month(period) - 1 AS ix FROM cm)
  SELECT o_custkey, period, count(*) OVER w::BIGINT AS months_seen, sum(n_orders) OVER w::BIGINT AS orders_6m, max(state) OVER w AS worst_6m, first_value(state) OVER w AS oldest_state,
  (sum((state = 2)::INTEGER) OVER w)::BIGINT AS bad_6m, (ix - max(CASE WHEN state = 2 THEN ix END) OVER c)::INTEGER AS since_bad
  FROM i WINDOW w AS (PARTITION BY o_custkey ORDER BY ix RANGE BETWEEN 5 PRECEDING AND CURRENT ROW), c AS (PARTITION BY o_custkey ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")  # fmt: skip
def lookback_features(spark, d):
    features = {
        "months_seen": lambda w: F.count("*").over(w), "orders_6m": lambda w: F.sum("n_orders").over(w), "worst_6m": lambda w: F.max("state").over(w),
        "oldest_state": lambda w: F.first("state").over(w), "bad_6m": lambda w: F.sum((F.col("state") == 2).cast("int")).over(w),
    }
    p = customer_months(spark, d)
    out = labels.look_back(p, "o_custkey", month_index("period"), 6, features)
    since = labels.since_last(out, "o_custkey", F.col("state") == 2, month_index("period"))
    return out.withColumn("since_bad", since).select("o_custkey", "period", *features, "since_bad")


def survival_loans(spark, d):
    reach = F.least(F.coalesce("default_mob", F.lit(10**6)), F.coalesce("payoff_mob", F.lit(10**6)), "reachable_mob")
    cause = F.when(F.coalesce(F.col("default_mob") <= F.col("time"), F.lit(False)), 1).when(F.coalesce(F.col("payoff_mob") <= F.col("time"), F.lit(False)), 2).otherwise(0)
    return loans(spark, d).withColumn("entry", (F.col("o_custkey") % 3).cast("int")).withColumn("time", reach).where("time >= entry").withColumn("cause", cause)


@query("survival_tables", f"""WITH RECURSIVE {LOANS}, t AS (SELECT vintage, (o_custkey % 3)::INTEGER AS entry, least(coalesce(default_mob, 1000000), coalesce(payoff_mob, 1000000), reachable_mob) AS tm, default_mob, payoff_mob FROM loans),
  s AS (SELECT *, CASE WHEN coalesce(default_mob <= tm, false) THEN 1 WHEN coalesce(payoff_mob <= tm, false) THEN 2 ELSE 0 END AS cause FROM t WHERE tm >= entry),
  g AS (SELECT vintage, min(entry) AS first, least(max(tm), 60) AS last FROM s GROUP BY vintage),
  r AS (SELECT g.vintage, m.mob, (count(*) FILTER (s.entry <= m.mob AND s.tm >= m.mob))::BIGINT AS at_risk, (count(*) FILTER (s.tm = m.mob AND cause = 1))::BIGINT AS d, (count(*) FILTER (s.tm = m.mob AND cause = 2))::BIGINT AS p
    FROM g JOIN (SELECT unnest(range(0, 61))::INTEGER AS mob) m ON m.mob <= g.last JOIN s ON s.vintage = g.vintage GROUP BY g.vintage, m.mob),
  h AS (SELECT *, CASE WHEN at_risk > 0 THEN d / at_risk ELSE 0.0 END::DOUBLE AS hd, CASE WHEN at_risk > 0 THEN p / at_risk ELSE 0.0 END::DOUBLE AS hp FROM r),
  f AS (SELECT vintage, mob, at_risk, 1 - hd AS km, 1 - hd - hp AS sv, hd AS cd, hp AS cp FROM h WHERE mob = 0
    UNION ALL SELECT h.vintage, h.mob, h.at_risk, km * (1 - h.hd), sv * (1 - h.hd - h.hp), cd + sv * h.hd, cp + sv * h.hp FROM f JOIN h ON h.vintage = f.vintage AND h.mob = f.mob + 1)
  SELECT vintage, mob, at_risk, round(1 - km, {R}) AS km_default, round(cd, {R}) AS cif_default, round(cp, {R}) AS cif_payoff FROM f
  WHERE mob >= (SELECT first FROM g WHERE g.vintage = f.vintage) AND mob < coalesce((SELECT min(x.mob) FROM h x WHERE x.vintage = f.vintage AND x.at_risk < 1), 1000)""")  # fmt: skip
def survival_tables(spark, d):
    out = survival.survival_tables(survival_loans(spark, d), ["vintage"], 60)
    return out.select("vintage", "mob", "at_risk", *_r("km_default", "cif_default", "cif_payoff"))


@query("survival_checkpoints")
def survival_checkpoints(spark, d):
    wide = survival_tables(spark, d).groupBy("vintage").pivot("mob", [12, 24, 36]).agg(F.max("cif_default"))
    return wide.select("vintage", *(F.col(str(m)).alias(f"cif_{m}") for m in (12, 24, 36)))


@query("label_reconciliation", f"""WITH {LABELLED} SELECT coalesce(y::VARCHAR, 'open') AS y, count(*)::BIGINT AS by_window, count(*)::BIGINT AS by_join, count(*)::BIGINT AS equal FROM labelled GROUP BY 1""")
def label_reconciliation(spark, d):
    """Labels by window and by self-join, row by row: they must agree everywhere."""
    p = customer_months(spark, d).select("o_custkey", "period", "letter")
    a = labels.label_windows(p, "o_custkey", "letter", 3, F.add_months).select("o_custkey", "period", F.col("y").alias("a"))
    b = labels.label_by_join(p, "o_custkey", "letter", 3, F.add_months).withColumnRenamed("y", "b")
    both = a.join(b, ["o_custkey", "period"])
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("open"))
    return both.groupBy(name("a").alias("y")).agg(F.count("*").alias("by_window"), count_if(name("b") == name("a")).alias("by_join"), count_if(F.col("a").eqNullSafe(F.col("b"))).alias("equal"))


@query("segment_alerts", f"""WITH {BANDED}, m AS (SELECT max(period) AS last FROM cm), t AS (SELECT dimension, grp, sum(loans) FILTER (period = last)::BIGINT AS loans, sum(bad) FILTER (period = last) / nullif(sum(loans) FILTER (period = last), 0) AS rate,
    sum(bad) FILTER (period < last AND period >= (last - INTERVAL 12 MONTH)::DATE) / nullif(sum(loans) FILTER (period < last AND period >= (last - INTERVAL 12 MONTH)::DATE), 0) AS baseline FROM seg, m GROUP BY dimension, grp),
  a AS (SELECT *, rate / nullif(baseline, 0) - 1 AS change FROM t WHERE loans >= 2)
  SELECT dimension, grp, loans, round(rate, {R}) AS rate, round(baseline, {R}) AS baseline, CASE WHEN change IS NULL THEN NULL WHEN change > 0.25 THEN 'red' WHEN change > 0.1 THEN 'amber' ELSE 'green' END AS light FROM a""")  # fmt: skip
def segment_alerts(spark, d):
    """The last month of each group of two loans or more against the pooled twelve months before."""
    from creditloom.functions.exprs import light

    s = segments(spark, d)
    last = s.agg(F.max("period").alias("last"))
    s = s.crossJoin(F.broadcast(last))  # one row
    now = F.col("period") == F.col("last")
    before = (F.col("period") < F.col("last")) & (F.col("period") >= F.add_months("last", -12))
    part = lambda c, w: F.sum(F.when(w, F.col(c)))
    t = s.groupBy("dimension", "grp").agg(part("loans", now).alias("loans"), ratio(part("bad", now), part("loans", now)).alias("rate"), ratio(part("bad", before), part("loans", before)).alias("baseline"))
    change = ratio("rate", "baseline") - 1
    return t.where("loans >= 2").select("dimension", "grp", "loans", *_r("rate", "baseline"), light(change, 0.1, 0.25, inclusive=False).alias("light"))


@query("vintage_alerts", f"""WITH {CURVES}, a AS (SELECT vintage, rate_count AS rate FROM curves WHERE mob = 12), b AS (SELECT avg(rate) AS benchmark FROM a WHERE vintage <= 1996)
  SELECT vintage, rate, round(benchmark, {R}) AS benchmark, CASE WHEN rate / nullif(benchmark, 0) - 1 > 0.25 THEN 'red' WHEN rate / nullif(benchmark, 0) - 1 > 0.1 THEN 'amber' WHEN benchmark = 0 THEN NULL ELSE 'green' END AS light FROM a, b WHERE vintage > 1996""")  # fmt: skip
def vintage_alerts(spark, d):
    """New vintages at month 12 against the mean of the benchmark ones."""
    from creditloom.functions.exprs import light

    at = curves(spark, d).where("mob = 12").select("vintage", F.round("rate_count", R).alias("rate"))
    mark = at.where("vintage <= 1996").agg(F.avg("rate").alias("benchmark"))
    both = at.where("vintage > 1996").crossJoin(F.broadcast(mark))  # one row
    return both.select("vintage", "rate", *_r("benchmark"), light(ratio("rate", "benchmark") - 1, 0.1, 0.25, inclusive=False).alias("light"))
