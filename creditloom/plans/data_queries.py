"""Queries over plain tables: contracts, keys, joins, exact sums, histories, bands, set operations, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.functions.exprs import band, count_if, exact_avg, exact_sum, is_sentinel, missing_pattern, month, ratio, segment_of, sentinel_to_null, status_bucket, exit_type, valid_end, vintage
from creditloom.operators import checks, history, joins, panel, sampling
from creditloom.plans.frames import SCORED, USER_DAYS, read, scored, user_days
from creditloom.plans.panel_queries import FLAGGED, flagged_days
from creditloom.plans.registry import query
from creditloom.session import saved
from creditloom.sources.contracts import parse_contract

R = 8

# A contract of the driver's tables; the key of lineitem does not hold, and its check must fail.
CONTRACT = parse_contract({
    "name": "trade", "format": "parquet",
    "tables": {
        "orders": {"primary_key": ["o_orderkey"], "min_rows": 1, "columns": {
            "o_orderkey": {"dtype": "integer", "nullable": False}, "o_custkey": {"dtype": "integer", "nullable": False},
            "o_orderstatus": {"allowed": ["F", "O", "P"], "pattern": "[A-Z]"}, "o_totalprice": {"dtype": "number", "low": 0, "high": 400000.0, "severity": "warning"}}},
        "lineitem": {"primary_key": ["l_orderkey", "l_linenumber"], "min_rows": 1, "columns": {
            "l_orderkey": {"dtype": "integer", "nullable": False}, "l_linenumber": {"dtype": "integer", "nullable": False}, "l_quantity": {"dtype": "number", "low": 1, "high": 50, "sentinels": [50]},
            "l_returnflag": {"allowed": ["A", "N"], "max_missing": 0.1}}},
    },
})


def _rule_sql(table: str, rows: list[tuple[str, str | None, str, str, str]], dup: str) -> str:
    parts = [f"SELECT '{t}' AS \"table\", {'NULL' if c is None else repr(c)}::VARCHAR AS \"column\", '{r}' AS rule, ({v})::BIGINT AS violations, count(*)::BIGINT AS rows, '{s}' AS severity FROM {table}" for t, c, r, v, s in rows]
    parts.append(dup)
    return f"SELECT *, violations = 0 AS ok FROM ({' UNION ALL '.join(parts)})"


_O = [("orders", None, "min_rows", "(count(*) < 1)::INTEGER", "error")] + [("orders", c, "dtype", "0", "error") for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")]
_O += [("orders", "o_orderkey", "not_null", "count(*) - count(o_orderkey)", "error"), ("orders", "o_custkey", "not_null", "count(*) - count(o_custkey)", "error"),
       ("orders", "o_orderstatus", "allowed", "count(*) FILTER (o_orderstatus NOT IN ('F', 'O', 'P'))", "error"), ("orders", "o_orderstatus", "pattern", "count(*) FILTER (NOT regexp_full_match(o_orderstatus, '[A-Z]'))", "error"),
       ("orders", "o_totalprice", "range", "count(*) FILTER (o_totalprice < 0 OR o_totalprice > 400000)", "warning")]
_L = [("lineitem", None, "min_rows", "(count(*) < 1)::INTEGER", "error")] + [("lineitem", c, "dtype", "0", "error") for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")]
_L += [("lineitem", "l_orderkey", "not_null", "count(*) - count(l_orderkey)", "error"), ("lineitem", "l_linenumber", "not_null", "count(*) - count(l_linenumber)", "error"),
       ("lineitem", "l_quantity", "range", "count(*) FILTER ((l_quantity < 1 OR l_quantity > 50) AND l_quantity <> 50)", "error"), ("lineitem", "l_returnflag", "allowed", "count(*) FILTER (l_returnflag NOT IN ('A', 'N'))", "error"),
       ("lineitem", "l_returnflag", "max_missing", "count(*) FILTER (l_returnflag IS NULL)", "error")]


def _dup_sql(t: str, key: str) -> str:
    return f"SELECT '{t}', '{key}', 'primary_key', (SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {key} HAVING count(*) > 1))::BIGINT, (SELECT count(*) FROM {t})::BIGINT, 'error'"


@query("contract_checks", f"{_rule_sql('orders', _O, _dup_sql('orders', 'o_orderkey'))} UNION ALL {_rule_sql('lineitem', _L, _dup_sql('lineitem', 'l_orderkey,l_linenumber'))}")
def contract_checks(spark, d):
    one, two = (checks.check_table(read(spark, d, t), CONTRACT.tables[t]) for t in ("orders", "lineitem"))
    return one.unionByName(two)


@query("key_duplicates", "SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def key_duplicates(spark, d):
    return checks.duplicate_keys(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("orphan_fk", """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')
  AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = o_custkey AND s_suppkey < 50)""")  # fmt: skip
def orphan_fk(spark, d):
    parents = (read(spark, d, "customer").where("c_mktsegment <> 'BUILDING'"), "c_custkey"), (read(spark, d, "supplier").where("s_suppkey < 50"), "s_suppkey")
    return checks.orphans(read(spark, d, "orders"), "o_custkey", *parents).select("o_orderkey", "o_custkey")


@query("semi_sample", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer ORDER BY md5(c_custkey || ':7'), c_custkey LIMIT 100)")
def semi_sample(spark, d):
    ids = sampling.sample_ids(read(spark, d, "customer"), "c_custkey", 100, 7)
    return read(spark, d, "orders").join(ids, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")


@query("anti_counts", """SELECT (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'))::BIGINT AS customers_without,
  (SELECT count(*) FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49))::BIGINT AS parts_without""")  # fmt: skip
def anti_counts(spark, d):
    a = read(spark, d, "customer").join(read(spark, d, "orders").where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").agg(F.count("*").alias("customers_without"))
    b = read(spark, d, "part").join(read(spark, d, "lineitem").where("l_quantity > 49"), F.col("p_partkey") == F.col("l_partkey"), "left_anti").agg(F.count("*").alias("parts_without"))
    return a.crossJoin(b)  # one row each


@query("exact_sums", """SELECT l_returnflag, round(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(28,10)))::DOUBLE, 4) AS revenue,
  round(sum(CAST(l_tax AS DECIMAL(28,10)))::DOUBLE / count(l_tax), 10) AS mean_tax, round(sum(CAST(l_quantity AS DECIMAL(28,10))) FILTER (l_linestatus = 'F')::DOUBLE, 4) AS finished FROM lineitem GROUP BY 1""")  # fmt: skip
def exact_sums(spark, d):
    sums = {"revenue": (exact_sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4), "mean_tax": (exact_avg("l_tax"), 10), "finished": (exact_sum("l_quantity", F.col("l_linestatus") == "F"), 4)}
    return read(spark, d, "lineitem").groupBy("l_returnflag").agg(*(F.round(c, k).alias(n) for n, (c, k) in sums.items()))


def features(spark, d):
    """Customers with reduced histories of orders and, through them, of line items; orphans drop out on the way."""
    o, li = read(spark, d, "orders"), read(spark, d, "lineitem")
    lines = li.join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    bad = F.col("o_orderstatus") == "F"
    by_order = {
        "n_orders": F.count("*"), "n_bad": count_if(bad), "bad_rate": F.avg(bad.cast("int")), "n_priorities": F.countDistinct("o_orderpriority"), "last_order": F.max(month("o_orderdate")),
        "total": exact_sum("o_totalprice"), "mean_bad": exact_avg("o_totalprice", bad),
    }
    late = F.col("l_shipdate").cast("date") > F.lit("1998-01-01").cast("date")
    by_line = {"n_lines": F.count("*"), "late_lines": count_if(late), "quantity": exact_sum("l_quantity"), "discount_share": exact_sum(F.col("l_extendedprice") * F.col("l_discount")) / exact_sum("l_extendedprice")}
    rare = o.where("o_orderstatus = 'P'")
    hist = {
        "orders": history.aggregate_history(o.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", by_order), "lines": history.aggregate_history(lines.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", by_line),
        "pending": history.aggregate_history(rare.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", {"n_pending": F.count("*")}, "o_totalprice > 200000"),
    }
    return history.join_histories(read(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), "c_custkey", hist)


FEATURES = """ho AS (SELECT o_custkey, count(*)::BIGINT AS n_orders, (count(*) FILTER (o_orderstatus = 'F'))::BIGINT AS n_bad, avg((o_orderstatus = 'F')::INTEGER) AS bad_rate, count(DISTINCT o_orderpriority)::BIGINT AS n_priorities,
  max(date_trunc('month', o_orderdate)::DATE) AS last_order, sum(CAST(o_totalprice AS DECIMAL(28,10)))::DOUBLE AS total,
  sum(CAST(o_totalprice AS DECIMAL(28,10))) FILTER (o_orderstatus = 'F')::DOUBLE / nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS mean_bad FROM orders GROUP BY 1),
hl AS (SELECT o_custkey, count(*)::BIGINT AS n_lines, (count(*) FILTER (l_shipdate::DATE > DATE '1998-01-01'))::BIGINT AS late_lines, sum(CAST(l_quantity AS DECIMAL(28,10)))::DOUBLE AS quantity,
  sum(CAST(l_extendedprice * l_discount AS DECIMAL(28,10)))::DOUBLE / sum(CAST(l_extendedprice AS DECIMAL(28,10)))::DOUBLE AS discount_share FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1),
hp AS (SELECT o_custkey, count(*)::BIGINT AS n_pending FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 200000 GROUP BY 1),
features AS (SELECT c_custkey, c_mktsegment, ho.* EXCLUDE (o_custkey), hl.* EXCLUDE (o_custkey), n_pending, (ho.o_custkey IS NOT NULL)::INTEGER AS has_orders, (hl.o_custkey IS NOT NULL)::INTEGER AS has_lines, (hp.o_custkey IS NOT NULL)::INTEGER AS has_pending
  FROM customer LEFT JOIN ho ON ho.o_custkey = c_custkey LEFT JOIN hl ON hl.o_custkey = c_custkey LEFT JOIN hp ON hp.o_custkey = c_custkey)"""


@query("history_features", f"""WITH {FEATURES} SELECT c_custkey, n_orders, n_bad, round(bad_rate, {R}) AS bad_rate, n_priorities, last_order, round(total, 4) AS total, round(mean_bad, 4) AS mean_bad, n_lines, late_lines,
  round(quantity, 4) AS quantity, round(discount_share, {R}) AS discount_share, n_pending, has_orders, has_lines, has_pending FROM features""")  # fmt: skip
def history_features(spark, d):
    f = features(spark, d)
    near = {"bad_rate": R, "total": 4, "mean_bad": 4, "quantity": 4, "discount_share": R}
    return f.drop("c_mktsegment", "c_acctbal").withColumns({c: F.round(c, k) for c, k in near.items()})


@query("history_coverage", f"WITH {FEATURES} SELECT c_mktsegment, count(*)::BIGINT AS rows, round(avg(has_orders), {R}) AS share_has_orders, round(avg(has_lines), {R}) AS share_has_lines, round(avg(has_pending), {R}) AS share_has_pending FROM features GROUP BY 1")
def history_coverage(spark, d):
    flags = ["has_orders", "has_lines", "has_pending"]
    return history.coverage(features(spark, d), flags, "c_mktsegment").withColumns({f"share_{f}": F.round(f"share_{f}", R) for f in flags})


@query("missing_shares", f"""WITH {FEATURES} SELECT 'mean_bad' AS "column", round(avg((mean_bad IS NULL)::INTEGER), {R}) AS share FROM features UNION ALL SELECT 'n_pending', round(avg((n_pending IS NULL)::INTEGER), {R}) FROM features""")
def missing_shares(spark, d):
    return history.missing_shares(features(spark, d), ["mean_bad", "n_pending"]).withColumn("share", F.round("share", R))


_BANDS = [("loss", None, -0.01), ("low", 0.0, 2500.0), ("middle", 2500.01, 7500.0), ("high", 7500.01, None)]


@query("band_counts", """SELECT CASE WHEN c_acctbal IS NULL THEN 'missing' WHEN c_acctbal <= -0.01 THEN 'loss' WHEN c_acctbal BETWEEN 0 AND 2500 THEN 'low' WHEN c_acctbal BETWEEN 2500.01 AND 7500 THEN 'middle' WHEN c_acctbal >= 7500.01 THEN 'high' ELSE 'missing' END AS band,
  count(*)::BIGINT AS n FROM customer GROUP BY 1""")  # fmt: skip
def band_counts(spark, d):
    return read(spark, d, "customer").groupBy(band("c_acctbal", _BANDS).alias("band")).agg(F.count("*").alias("n"))


@query("status_codes", """WITH c AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN '00' WHEN 1 THEN '01' WHEN 2 THEN '02' WHEN 3 THEN '03' WHEN 4 THEN '12' WHEN 5 THEN 'RA' WHEN 6 THEN 'XX' END AS status, CASE event_id % 5 WHEN 0 THEN '01' WHEN 1 THEN '03' WHEN 2 THEN '96' END AS code,
    'F' || lpad((event_id % 24)::VARCHAR, 2, '0') || 'Q' || (1 + event_id % 4)::VARCHAR || event_id::VARCHAR AS loan FROM events)
  SELECT CASE WHEN status IN ('RA', '03', '12') THEN 'dpd90plus' WHEN status = '00' THEN 'current' WHEN status = '01' THEN 'dpd30' WHEN status = '02' THEN 'dpd60' END AS bucket,
  CASE WHEN code = '01' THEN 'payoff' WHEN code = '03' THEN 'liquidation' WHEN code IS NOT NULL THEN 'other_exit' END AS exit, (2000 + substr(loan, 2, 2)::INTEGER)::VARCHAR || substr(loan, 4, 2) AS vintage, count(*)::BIGINT AS n FROM c GROUP BY ALL""")  # fmt: skip
def status_codes(spark, d):
    k = F.col("event_id")
    pick = lambda m, values: F.get(F.array(*(F.lit(v) for v in values)), (k % m).cast("int"))
    e = read(spark, d, "events").select(pick(8, ["00", "01", "02", "03", "12", "RA", "XX", None]).alias("status"), pick(5, ["01", "03", "96", None, None]).alias("code"),
        F.concat(F.lit("F"), F.lpad((k % 24).cast("string"), 2, "0"), F.lit("Q"), (1 + k % 4).cast("string"), k.cast("string")).alias("loan"))
    return e.groupBy(status_bucket("status").alias("bucket"), exit_type("code").alias("exit"), vintage("loan", quarter=True).alias("vintage")).agg(F.count("*").alias("n"))


@query("guarded_columns", f"""SELECT p_partkey, nullif(p_size, 50) AS size_known, (p_size = 50)::INTEGER AS size_sentinel, round(p_retailprice / nullif(p_size - 10, 0), {R}) AS price_a_size,
  CASE WHEN p_size % 5 = 0 AND p_size % 7 = 0 THEN 'size+type' WHEN p_size % 5 = 0 THEN 'size' WHEN p_size % 7 = 0 THEN 'type' ELSE 'none' END AS pattern FROM part""")  # fmt: skip
def guarded_columns(spark, d):
    p = read(spark, d, "part").withColumn("size", F.when(F.col("p_size") % 5 != 0, F.col("p_size"))).withColumn("type", F.when(F.col("p_size") % 7 != 0, F.col("p_type")))
    return p.select("p_partkey", sentinel_to_null("p_size", 50).alias("size_known"), is_sentinel("p_size", 50).alias("size_sentinel"), F.round(ratio("p_retailprice", F.col("p_size") - 10), R).alias("price_a_size"), missing_pattern(["size", "type"]).alias("pattern"))


@query("impossible_dates", "SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_shipdate::DATE >= o_orderdate::DATE THEN l_shipdate::DATE END AS ship FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def impossible_dates(spark, d):
    j = read(spark, d, "lineitem").join(read(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    return j.select("l_orderkey", "l_linenumber", "l_quantity", valid_end(F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")).alias("ship"))


@query("segment_spans", """SELECT CASE WHEN o_orderdate::DATE BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' THEN 'train' WHEN o_orderdate::DATE BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' THEN 'validation' WHEN o_orderdate::DATE BETWEEN DATE '1998-01-01' AND DATE '1999-12-31' THEN 'out_of_time' END AS segment,
  count(*)::BIGINT AS n FROM orders GROUP BY 1""")  # fmt: skip
def segment_spans(spark, d):
    spans = {"train": ("1995-01-01", "1996-12-31"), "validation": ("1997-01-01", "1997-12-31"), "out_of_time": ("1998-01-01", "1999-12-31")}
    return read(spark, d, "orders").groupBy(segment_of(F.col("o_orderdate").cast("date"), spans).alias("segment")).agg(F.count("*").alias("n"))


@query("union_by_name", "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def union_by_name(spark, d):
    a = read(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return history.union_by_name(a, read(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")))


@query("union_keys", "SELECT c_custkey AS key FROM customer UNION SELECT s_suppkey FROM supplier")
def union_keys(spark, d):
    return read(spark, d, "customer").select(F.col("c_custkey").alias("key")).union(read(spark, d, "supplier").select("s_suppkey")).distinct()


_H = "CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT) % 1000000"


@query("hash_sample", f"WITH {SCORED} SELECT id, y, CASE WHEN y = 1 THEN 1.0 ELSE 1 / 0.25 END::DOUBLE AS weight FROM scored WHERE y = 1 OR {_H.format(chr(39).join(['id || ', ':', ' || period || ', ':42', '']))} < 250000")
def hash_sample(spark, d):
    return sampling.hash_sample(scored(spark, d), ["id", "period"], F.col("y") == 1, 0.25, 42).select("id", "y", "weight")


_SPLIT = """sp AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY md5(id || ':11'), id) AS place, count(*) OVER (PARTITION BY y) AS n FROM scored),
  q AS (SELECT *, floor(n * 0.6 + 1e-9) AS a, floor(n * 0.2 + 1e-9) AS b, floor(n * 0.2 + 1e-9) AS c FROM sp), q2 AS (SELECT *, n - a - b - c AS lft, n * 0.6::DOUBLE - a AS ra, n * 0.2::DOUBLE - b AS rb, n * 0.2::DOUBLE - c AS rc FROM q),
  q3 AS (SELECT *, a + ((rb > ra + 1e-9)::INTEGER + (rc > ra + 1e-9)::INTEGER < lft)::INTEGER AS ua, b + ((ra > rb + 1e-9 OR abs(ra - rb) <= 1e-9)::INTEGER + (rc > rb + 1e-9)::INTEGER < lft)::INTEGER AS ub FROM q2),
  split AS (SELECT id, y, CASE WHEN place <= ua THEN 'train' WHEN place <= ua + ub THEN 'validation' ELSE 'test' END AS split FROM q3)"""
_SHARES = {"train": 0.6, "validation": 0.2, "test": 0.2}


@query("stratified_split", f"WITH {SCORED}, {_SPLIT} SELECT id, split FROM split")
def stratified_split(spark, d):
    return sampling.stratified_split(scored(spark, d).drop("split"), "id", ["y"], _SHARES, 11).select("id", "split")


@query("split_summary", f"WITH {SCORED}, {_SPLIT} SELECT split, count(*)::BIGINT AS n, round(avg(y), {R}) AS bad_rate, round(count(*) / sum(count(*)) OVER (), {R}) AS share FROM split GROUP BY split")
def split_summary(spark, d):
    """The split joined to its population one to one: a key that is missing or repeated on a side is an error."""
    population = scored(spark, d).drop("split")
    split = sampling.stratified_split(population, "id", ["y"], _SHARES, 11).select("id", "split")
    both, guard = joins.complete_join({"split": split, "population": population.select("id", "y")}, ["id"], "split_summary")
    sums = saved(both.groupBy("split").agg(F.count("*").alias("n"), F.round(F.avg("y"), R).alias("bad_rate")))
    total = guard.verify()["rows"]
    return sums.select("split", "n", "bad_rate", F.round(F.col("n") / F.lit(total), R).alias("share"))


@query("split_fingerprint", f"""WITH {SCORED}, {_SPLIT}, h AS (SELECT md5(id || ':' || split) AS m FROM split)
  SELECT sum(CAST('0x' || substr(m, 1, 8) AS BIGINT))::VARCHAR || '-' || sum(CAST('0x' || substr(m, 9, 8) AS BIGINT))::VARCHAR || '-' || count(*)::VARCHAR AS fingerprint FROM h""")  # fmt: skip
def split_fingerprint(spark, d):
    s = sampling.stratified_split(scored(spark, d).drop("split"), "id", ["y"], _SHARES, 11)
    return sampling.split_fingerprint(s, "id", "split")


@query("panel_checks", f"""WITH {FLAGGED}, a AS (SELECT count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT (user_id, period)) AS keys, count(*) FILTER (is_bad) AS bad, count(*) FILTER (first_bad) AS firsts,
    (SELECT count(DISTINCT (user_id, CAST(ts AS DATE))) FROM events) AS days, (SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'error') AS with_error, (SELECT sum(n_events) FROM panel) AS total, (SELECT count(*) FROM events) AS events FROM flagged)
  SELECT unnest(['rows', 'unique keys', 'first bad', 'events']) AS "check", unnest([n, n, firsts, total])::DOUBLE AS claimed, unnest([days, keys, with_error, events])::DOUBLE AS recounted, unnest(['raw', 'panel', 'raw', 'raw']) AS source, unnest([n = days, n = keys, firsts = with_error, total = events]) AS ok FROM a""")  # fmt: skip
def panel_checks(spark, d):
    e = read(spark, d, "events")
    raw = e.agg(F.countDistinct(F.struct("user_id", F.col("ts").cast("date"))).alias("days"), F.countDistinct(F.when(F.col("event_type") == "error", F.col("user_id"))).alias("with_error"), F.count("*").alias("events"))
    made = flagged_days(spark, d).agg(F.count("*").alias("n"), F.countDistinct(F.struct("user_id", "period")).alias("keys"), count_if(F.col("first_bad")).alias("firsts"), F.sum("n_events").alias("total"))
    row = made.crossJoin(raw)  # one row each
    c, r = F.col, checks.check_row
    return checks.check_rows(row, r("rows", c("n"), c("days"), "raw"), r("unique keys", c("n"), c("keys"), "panel"), r("first bad", c("firsts"), c("with_error"), "raw"), r("events", c("total"), c("events"), "raw"))


@query("transition_checks", f"""WITH {USER_DAYS}, {FLAGGED.split(", flagged AS")[1].join(["flagged AS", ""])}, a AS (SELECT prev_state AS f, state AS t, count(*) AS n FROM flagged WHERE has_prev GROUP BY ALL),
  b AS (SELECT x.state AS f, y.state AS t, count(*) AS n FROM panel x JOIN panel y ON x.user_id = y.user_id AND y.period = x.period + 1 GROUP BY ALL)
  SELECT a.f AS from_state, a.t AS to_state, a.n::DOUBLE AS claimed, b.n::DOUBLE AS recounted, a.n = b.n AS ok FROM a JOIN b ON a.f = b.f AND a.t = b.t""")  # fmt: skip
def transition_checks(spark, d):
    """The window's transitions against those of the self-join, cell by cell."""
    a = panel.transition_counts(flagged_days(spark, d), "state").groupBy("from_state", "to_state").agg(F.sum("entities").cast("double").alias("claimed"))
    b = panel.transitions_by_join(user_days(spark, d), "user_id", "state", F.date_add).groupBy("from_state", "to_state").agg(F.sum("entities").cast("double").alias("recounted"))
    return a.join(b, ["from_state", "to_state"]).withColumn("ok", F.col("claimed") == F.col("recounted"))
