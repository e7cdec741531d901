"""Queries over a loan panel made of orders and customers: features, dataset, checks, lineage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.operators import feature_set
from creditloom.plans.frames import CUSTOMER_MONTHS, customer_months, read
from creditloom.plans.panel_queries import LABELLED, labelled
from creditloom.plans.registry import query

R = 8
MONTHS = 12
SCORING_MONTH = date(1998, 1, 1)
BANDS = {"fico": [("low", None, 659), ("middle", 660, 739), ("high", 740, None)]}


def performance(spark, d):
    """A customer's months as a loan's, with the columns that servicers report."""
    mob, state = F.col("mob"), F.col("state")
    status = F.when(mob % 17 == 16, "XX").when(state == 2, F.concat(F.lit("0"), (1 + mob % 4).cast("string"))).otherwise("00")
    flag = lambda n, k, value, other="": F.when(mob % n == k, value).otherwise(other)
    return customer_months(spark, d).select(
        F.col("o_custkey").alias("loan_id"), "period", mob.alias("loan_age"), F.col("amount").alias("current_upb"), (3 + F.col("n_orders") / 4).alias("current_interest_rate"),
        F.when(state == 2, F.col("amount") / 10).alias("current_non_interest_bearing_upb"), status.alias("delinquency_status"), flag(7, 3, " Y ", "N").alias("modification_flag"),
        flag(11, 4, "P", " ").alias("payment_deferral_flag"), flag(13, 6, "Y").alias("delinquency_due_to_disaster"), flag(5, 2, "F", " ").alias("borrower_assistance_plan"),
    )


def origination(spark, d):
    k, low = F.col("c_custkey"), F.lower("c_mktsegment")
    return read(spark, d, "customer").select(
        k.alias("loan_id"), (600 + k % 200).alias("fico"), (60 + k % 40).alias("orig_ltv"), (65 + k % 40).alias("orig_cltv"), F.when(k % 9 != 0, 20 + k % 30).alias("orig_dti"), (3 + (k % 8) / 4).alias("orig_interest_rate"),
        (100000 + k % 50 * 1000).alias("orig_upb"), F.lit(360).alias("orig_loan_term"), (k % 3 * 10).alias("mi_pct"), (1 + k % 2).alias("num_borrowers"), (1 + k % 4).alias("num_units"),
        F.substring(low, 1, 1).alias("occupancy_status"), low.alias("loan_purpose"), F.when(k % 2 == 0, "R").otherwise("B").alias("channel"), F.when(k % 5 == 0, "CO").otherwise("SF").alias("property_type"),
        F.when(k % 3 == 0, "Y").otherwise("N").alias("first_time_homebuyer"), F.when(k % 31 == 0, "Y").alias("harp_indicator"), F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("property_state"),
    )


def label_rows(spark, d):
    """The labels of the customers' months, with split and regime by year."""
    year = F.year("period")
    bucket = F.when(F.col("letter") == "B", "dpd90plus").otherwise("current")
    split = F.when(F.col("y").isNull(), None).when(year <= 1995, "train").when(year == 1996, "validation").otherwise("test")
    return labelled(spark, d).select(F.col("o_custkey").alias("loan_id"), "period", split.alias("split"), F.when(year < 1995, "old").otherwise("new").alias("regime"), "y", "event_offset", bucket.alias("bucket_at_t"), "ever_bad_before", "exclusion_reason")


def built(spark, d):
    return feature_set.dataset(performance(spark, d), origination(spark, d), label_rows(spark, d), MONTHS, SCORING_MONTH, bands=BANDS)


DATASET = f"""{LABELLED}, lr AS (SELECT o_custkey AS loan_id, period, CASE WHEN y IS NULL THEN NULL WHEN year(period) <= 1995 THEN 'train' WHEN year(period) = 1996 THEN 'validation' ELSE 'test' END AS split, CASE WHEN year(period) < 1995 THEN 'old' ELSE 'new' END AS regime,
    y, event_offset, CASE WHEN letter = 'B' THEN 'dpd90plus' ELSE 'current' END AS bucket_at_t, ever_bad_before, exclusion_reason FROM labelled),
  l AS (SELECT *, period = DATE '1998-01-01' AS scoring_row FROM lr WHERE (split IS NOT NULL AND y IS NOT NULL) OR (period = DATE '1998-01-01' AND (exclusion_reason IS NULL OR exclusion_reason = 'incomplete_performance_window'))),
  pf AS (SELECT o_custkey AS loan_id, period, mob, amount AS upb, 3 + n_orders / 4.0::DOUBLE AS rate, CASE WHEN state = 2 THEN amount / 10 END AS nib, mob % 7 = 3 AS md, mob % 11 = 4 AS df, mob % 13 = 6 AS ds, CASE WHEN mob % 5 = 2 THEN 'F' END AS bap,
    CASE WHEN mob % 17 = 16 THEN NULL WHEN state = 2 THEN least(1 + mob % 4, 3) ELSE 0 END AS bnum, year(period) * 12 + month(period) AS ix FROM cm),
  w AS (SELECT *, lag(bnum) OVER t AS pb, lag(ix) OVER t AS pix, count(*) FILTER (bnum >= 1) OVER win AS m30, max(bnum) OVER win AS mx, count(*) OVER win AS hist, first_value(upb) OVER win AS upb0, count(bap) OVER win AS ast,
    max(ix) FILTER (bnum >= 1) OVER (PARTITION BY loan_id ORDER BY ix ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lastd
    FROM pf WINDOW t AS (PARTITION BY loan_id ORDER BY ix), win AS (PARTITION BY loan_id ORDER BY ix RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)),
  og AS (SELECT c_custkey AS k, lower(c_mktsegment) AS low, c_nationkey FROM customer),
  data AS (SELECT l.loan_id, l.period, CASE WHEN scoring_row AND y IS NULL THEN 'scoring' ELSE split END AS split, regime, y, event_offset, bucket_at_t, scoring_row, round(upb, {R}) AS upb,
    CASE WHEN 600 + k % 200 <= 659 THEN 'low' WHEN 600 + k % 200 <= 739 THEN 'middle' ELSE 'high' END AS fico_band, 600 + k % 200 AS fico, 60 + k % 40 AS orig_ltv, 65 + k % 40 AS orig_cltv, CASE WHEN k % 9 <> 0 THEN 20 + k % 30 END AS orig_dti, 3 + (k % 8) / 4.0::DOUBLE AS orig_interest_rate,
    100000 + k % 50 * 1000 AS orig_upb, 360 AS orig_loan_term, k % 3 * 10 AS mi_pct, 1 + k % 2 AS num_borrowers, 1 + k % 4 AS num_units, mob, bnum AS bucket_num, CASE WHEN pix = ix - 1 THEN bnum - pb ELSE 0 END AS bucket_change_1m, m30 AS months_30plus_window, mx AS max_bucket_window,
    coalesce(ix - lastd, 999) AS months_since_delinquent, ever_bad_before::INTEGER AS ever_90plus_before_t, hist AS history_months_window, round(upb / (100000 + k % 50 * 1000), {R}) AS upb_ratio, round((upb0 - upb) / (100000 + k % 50 * 1000), {R}) AS paydown_window,
    round(rate - (3 + (k % 8) / 4.0::DOUBLE), {R}) AS rate_change, round(coalesce(nib / nullif(upb, 0), 0), {R}) AS non_interest_bearing_share, ast AS assistance_months_window, md::INTEGER AS modified, df::INTEGER AS payment_deferral, ds::INTEGER AS disaster,
    substr(low, 1, 1) AS occupancy_status, low AS loan_purpose, CASE WHEN k % 2 = 0 THEN 'R' ELSE 'B' END AS channel, CASE WHEN k % 5 = 0 THEN 'CO' ELSE 'SF' END AS property_type, CASE WHEN k % 3 = 0 THEN 'Y' ELSE 'N' END AS first_time_homebuyer, CASE WHEN k % 31 = 0 THEN 'Y' END AS harp_indicator,
    'S' || c_nationkey AS property_state, coalesce(bap, 'none') AS assistance_plan_at_t
    FROM l JOIN w ON l.loan_id = w.loan_id AND l.period = w.period LEFT JOIN og ON og.k = l.loan_id)"""


@query("warning_dataset", f"WITH {DATASET} SELECT * FROM data")
def warning_dataset(spark, d):
    """All 34 features on labelled rows and on those to be scored."""
    data = built(spark, d)
    floats = [f.name for f in data.schema if isinstance(f.dataType, T.DoubleType) and f.name not in ("orig_interest_rate",)]
    return data.withColumns({c: F.round(c, R) for c in floats})


@query("dataset_checks", f"""WITH {DATASET}, n AS (SELECT split, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS e FROM lr WHERE split IS NOT NULL AND y IS NOT NULL GROUP BY split)
  SELECT split || ': ' || u.c AS "check", u.v AS claimed, u.v AS recounted, 'labels' AS source, true AS ok FROM (SELECT split, unnest([{{'c': 'rows', 'v': n}}, {{'c': 'events', 'v': e}}]) AS u FROM n)
  UNION ALL SELECT 'repeated keys', 0, count(*) - count(DISTINCT (loan_id, period)), 'dataset', count(*) = count(DISTINCT (loan_id, period)) FROM data
  UNION ALL SELECT 'there are rows to score', 1, least(count(*) FILTER (scoring_row), 1), 'dataset', count(*) FILTER (scoring_row) > 0 FROM data
  UNION ALL SELECT 'rows to score that are bad or unknown', 0, count(*) FILTER (scoring_row AND bucket_at_t = 'dpd90plus'), 'dataset', count(*) FILTER (scoring_row AND bucket_at_t = 'dpd90plus') = 0 FROM data""")  # fmt: skip
def dataset_checks(spark, d):
    return feature_set.dataset_checks(built(spark, d), label_rows(spark, d))


@query("loan_features", f"""WITH {DATASET} SELECT loan_id, period, bnum AS bucket_num, CASE WHEN pix = ix - 1 THEN bnum - pb ELSE 0 END AS bucket_change_1m, m30 AS months_30plus_window, mx AS max_bucket_window, coalesce(ix - lastd, 999) AS months_since_delinquent,
  hist AS history_months_window, round(upb0 - upb, {R}) AS paydown_window, round(coalesce(nib / nullif(upb, 0), 0), {R}) AS non_interest_bearing_share, ast AS assistance_months_window, md::INTEGER AS modified, df::INTEGER AS payment_deferral, ds::INTEGER AS disaster FROM w""")  # fmt: skip
def loan_features(spark, d):
    """The panel's part of the features on every loan month."""
    names = ["bucket_num", "bucket_change_1m", "months_30plus_window", "max_bucket_window", "months_since_delinquent", "history_months_window", "paydown_window", "non_interest_bearing_share", "assistance_months_window", "modified", "payment_deferral", "disaster"]
    out = feature_set.panel_features(performance(spark, d), feature_set.chosen(names), MONTHS)
    rounded = {"paydown_window", "non_interest_bearing_share"}
    return out.select("loan_id", "period", *(F.round(f"_{n}", R).alias(n) if n in rounded else F.col(f"_{n}").alias(n) for n in names))


@query("feature_lineage", """WITH c AS (SELECT DISTINCT unnest(['fico', 'upb_ratio', 'rate_change']) AS feature FROM customer)
  SELECT feature, unnest(CASE feature WHEN 'fico' THEN ['origination.fico'] WHEN 'upb_ratio' THEN ['performance.current_upb', 'origination.orig_upb'] ELSE ['performance.current_interest_rate', 'origination.orig_interest_rate'] END) AS "column" FROM c""")  # fmt: skip
def feature_lineage(spark, d):
    """What three of the features read, of those that have values in the dataset."""
    names = ["fico", "upb_ratio", "rate_change"]
    pairs = spark.createDataFrame(feature_set.lineage(feature_set.chosen(names)), "feature string, column string")
    data = built(spark, d).select(*names)
    filled = data.agg(*(F.count(n).alias(n) for n in names)).unpivot([], names, "feature", "n").where("n > 0")
    return pairs.join(filled, "feature").select("feature", "column")
