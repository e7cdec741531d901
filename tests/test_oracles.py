"""Every query with SQL returns what DuckDB returns on the same tables."""

import glob
import math
import os

import pytest

from creditloom.plans import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>"):
        return None
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return bool(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    try:
        return round(float(v), 6)
    except (TypeError, ValueError):
        return v


def rows(frame):
    cols = sorted(frame.columns)
    return sorted((repr([plain(v) for v in r]) for r in frame[cols].astype(object).values.tolist())), cols


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data, con, name):
    got, cols = rows(QUERIES[name](spark, data).toPandas())
    want, want_cols = rows(con.execute(ORACLES[name]).df())
    assert cols == want_cols
    assert got == want
    # its last month has no group of the least size in the smallest tables; at sf0.01 it has three
    assert got or name == "segment_alerts"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"gbt_challenger"}))
def test_query_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_row_order_does_not_matter(spark, data):
    from creditloom.operators.panel import flag_panel, transition_counts
    from creditloom.plans.frames import user_days
    from pyspark.sql import functions as F

    panel = user_days(spark, data).cache()
    make = lambda p: sorted(map(tuple, transition_counts(flag_panel(p, "user_id", "state", F.col("state") == 3, carried=["value"]), "state", "value").collect()))
    assert make(panel) == make(panel.orderBy(F.rand(3)).repartition(3))


def test_later_rows_do_not_change_features(spark, data):
    from creditloom.operators.labels import look_back
    from creditloom.plans.frames import customer_months
    from creditloom.functions.exprs import month_index
    from pyspark.sql import functions as F

    p = customer_months(spark, data)
    make = lambda q: look_back(q, "o_custkey", month_index("period"), 6, {"n": lambda w: F.sum("n_orders").over(w)}).where("period < date '1997-01-01'").select("o_custkey", "period", "n")
    changed = p.withColumn("n_orders", F.when(F.col("period") >= "1997-01-01", 99).otherwise(F.col("n_orders")))
    assert make(p).exceptAll(make(changed)).count() == 0
