"""The driver's tables in the roles of the engine's inputs, as DataFrames and as the same CTEs in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.functions.exprs import exact_sum, month, month_index

SEVERITY = {"error": 3, "purchase": 2, "click": 1}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a panel: one row a user and day, its state the most severe event."""
    e = read(spark, sf_dir, "events")
    severity = F.lit(0)
    for kind, level in SEVERITY.items():
        severity = F.when(F.col("event_type") == kind, level).otherwise(severity)
    return e.groupBy("user_id", F.col("ts").cast("date").alias("period")).agg(F.max(severity).alias("state"), F.count("*").alias("n_events"), exact_sum("value").alias("value"))


USER_DAYS = """panel AS (SELECT user_id, CAST(ts AS DATE) AS period,
  max(CASE event_type WHEN 'error' THEN 3 WHEN 'purchase' THEN 2 WHEN 'click' THEN 1 ELSE 0 END)::INTEGER AS state,
  count(*)::BIGINT AS n_events, sum(CAST(value AS DECIMAL(28,10)))::DOUBLE AS value FROM events GROUP BY 1, 2)"""


def customer_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a sparse monthly panel: a customer's month, its months on book, and its state.

    The state is the worst order status: F is bad (B), P paid off (P), O active (N)."""
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderstatus", month("o_orderdate").alias("period"))
    rank = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "P", 1).otherwise(0)
    p = o.groupBy("o_custkey", "period").agg(F.max(rank).alias("state"), F.count("*").alias("n_orders"), exact_sum("o_totalprice").alias("amount"))
    p = p.withColumn("first_period", F.min("period").over(Window.partitionBy("o_custkey"))).withColumn("mob", month_index("period") - month_index("first_period"))
    return p.withColumn("vintage", F.year("first_period")).withColumn("letter", F.when(F.col("state") == 2, "B").when(F.col("state") == 1, "P").otherwise("N"))


CUSTOMER_MONTHS = """cm0 AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS period,
  max(CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE 0 END)::INTEGER AS state, count(*)::BIGINT AS n_orders,
  sum(CAST(o_totalprice AS DECIMAL(28,10)))::DOUBLE AS amount FROM orders GROUP BY 1, 2),
cm AS (SELECT *, (year(period) * 12 + month(period) - year(first_period) * 12 - month(first_period))::INTEGER AS mob, year(first_period)::INTEGER AS vintage,
  CASE state WHEN 2 THEN 'B' WHEN 1 THEN 'P' ELSE 'N' END AS letter
  FROM (SELECT *, min(period) OVER (PARTITION BY o_custkey) AS first_period FROM cm0))"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as scored applicants: two integer risks with ties, their PDs, target, segments, month and split."""
    o = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")), "o_custkey")
    bad = (F.col("o_orderstatus") == "F").cast("int")
    return o.select(
        F.col("o_orderkey").alias("id"), bad.alias("y"), (((F.col("o_orderkey") * 37 + F.col("o_custkey") * 17) % 101) + bad * 13).cast("int").alias("risk_a"),
        (((F.col("o_orderkey") * 53 + F.col("o_custkey") * 29) % 97) + bad * 9).cast("int").alias("risk_b"), "segment", F.col("o_orderpriority").alias("priority"),
        month("o_orderdate").alias("period"), F.col("o_totalprice").alias("amount"), F.when(F.col("o_orderkey") % 5 < 3, "train").when(F.col("o_orderkey") % 5 == 3, "validation").otherwise("test").alias("split"),
    ).withColumn("pd_a", (F.col("risk_a") + 0.5) / 128).withColumn("pd_b", (F.col("risk_b") + 0.5) / 128)


SCORED = """scored AS (SELECT *, (risk_a + 0.5::DOUBLE) / 128 AS pd_a, (risk_b + 0.5::DOUBLE) / 128 AS pd_b FROM (
  SELECT o_orderkey AS id, (o_orderstatus = 'F')::INTEGER AS y,
    ((o_orderkey * 37 + o_custkey * 17) % 101 + (o_orderstatus = 'F')::INTEGER * 13)::INTEGER AS risk_a,
    ((o_orderkey * 53 + o_custkey * 29) % 97 + (o_orderstatus = 'F')::INTEGER * 9)::INTEGER AS risk_b,
    c_mktsegment AS segment, o_orderpriority AS priority, date_trunc('month', o_orderdate)::DATE AS period, o_totalprice AS amount,
    CASE WHEN o_orderkey % 5 < 3 THEN 'train' WHEN o_orderkey % 5 = 3 THEN 'validation' ELSE 'test' END AS split
  FROM orders JOIN customer ON c_custkey = o_custkey))"""
