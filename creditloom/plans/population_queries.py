"""The development population: applicants whose order is settled (F bad, O good) are developed on, pending ones (P) only scored."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.operators import population, sampling
from creditloom.plans.frames import SCORED, read, scored
from creditloom.plans.registry import query
from creditloom.session import saved

FRACTIONS = {"train": 0.6, "validation": 0.2, "test": 0.2}

_POPULATION = f"""{SCORED}, tr AS (SELECT o_orderkey AS id, (o_orderstatus = 'F')::INTEGER AS y FROM orders WHERE o_orderstatus <> 'P'), te AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'P'),
  pub AS (SELECT s.id, CASE WHEN o.o_orderstatus <> 'P' THEN s.split END AS split FROM scored s JOIN orders o ON o.o_orderkey = s.id), fe AS (SELECT DISTINCT l_orderkey AS id FROM lineitem), sp AS (SELECT id, split FROM pub WHERE split IS NOT NULL),
  nb AS (SELECT split, count(*)::DOUBLE AS n, avg(y) AS rate FROM sp JOIN tr USING (id) GROUP BY split), al AS (SELECT (SELECT count(*) FROM tr)::DOUBLE AS tr, (SELECT count(*) FROM te)::DOUBLE AS te, (SELECT avg(y) FROM tr) AS rate, (SELECT count(*) FROM sp)::DOUBLE AS sp)"""


def _oracle() -> str:
    rows = []
    for s, share in FRACTIONS.items():
        n = f"(SELECT n FROM nb WHERE split = '{s}')"
        rate = f"(SELECT rate FROM nb WHERE split = '{s}')"
        rows += [
            (f"published/split/{s}", "published scores", f"(SELECT count(*) FROM pub WHERE split = '{s}')", n, "0"),
            (f"share/split/{s}", "split design", str(share), f"round({n} / sp, 6)", "1e-3"),
            (f"bad_rate/split/{s}", "stratified", "round(rate, 6)", f"round({rate}, 6)", f"greatest(1e-6, 1 / {n})"),
            (f"rows/split/{s}", "scorecard", f"(SELECT count(*) FROM pub WHERE split = '{s}')", n, "0"),
        ]
    missing = lambda a, b: f"(SELECT count(*) FROM {a} WHERE id NOT IN (SELECT id FROM {b}))"
    excluded = {
        "train rows without target": "(SELECT count(*) FROM tr WHERE y IS NULL)", "duplicate train ids": "(SELECT count(*) - count(DISTINCT id) FROM tr)", "duplicate test ids": "(SELECT count(*) - count(DISTINCT id) FROM te)",
        "train rows without split": missing("tr", "sp"), "split rows outside train": missing("sp", "tr"), "ids in several splits": "(SELECT count(*) FROM (SELECT id FROM sp GROUP BY id HAVING count(*) > 1))",
        "train rows without features": missing("tr", "fe"), "test rows without features": missing("te", "fe"), "feature rows of no applicant": "(SELECT count(*) FROM fe WHERE id NOT IN (SELECT id FROM tr) AND id NOT IN (SELECT id FROM te))",
    }
    rows += [(f"exclusion/{k}", "no exclusions", "0", v, "0") for k, v in excluded.items()]
    rows += [
        ("published/without split", "published scores", "(SELECT count(*) FROM pub WHERE split IS NULL)", "te", "0"), ("published/rows", "published scores", "(SELECT count(*) FROM pub)", "tr + te", "0"),
        ("published/duplicates", "published scores", "(SELECT count(*) - count(DISTINCT id) FROM pub)", "0", "0"), ("bad_rate/overall", "split summary", "(SELECT avg(y) FROM pub JOIN tr USING (id))", "rate", "1e-6"),
    ]
    parts = [f"SELECT '{f}' AS figure, '{src}' AS source, ({a})::DOUBLE AS claimed, ({b})::DOUBLE AS recounted, ({t})::DOUBLE AS tol FROM al" for f, src, a, b, t in rows]
    numbers = f"SELECT figure, source, round(claimed, 8) AS claimed, round(recounted, 8) AS recounted, coalesce(abs(claimed - recounted) <= tol, false) AS ok FROM ({' UNION ALL '.join(parts)})"
    return f"WITH {_POPULATION} {numbers} UNION ALL SELECT 'split fingerprint', 'split summary', NULL, NULL, true"


@query("population_reconciliation", _oracle())
def population_reconciliation(spark, d):
    """All checks of the population: line items by order in the role of the features, the scored table as what was published."""
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    settled = F.col("status") != "P"
    train = o.where(settled).select("id", (F.col("status") == "F").cast("int").alias("y"))
    features = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("id")).distinct()
    rows = saved(scored(spark, d).join(o, "id").select("id", F.when(settled, F.col("split")).alias("split"), F.when(settled, F.col("y")).alias("y")))  # read by six counts
    splits = rows.where("split is not null").select("id", "split")
    counts = population.recount(train, o.where(~settled), features, splits, rows, "id", "y", "split")
    text, number = F.lit(None).cast("string").alias("text"), F.lit(None).cast("double").alias("value")
    sizes = rows.where("split is not null").groupBy("split").agg(F.count("*").cast("double").alias("value")).select(F.concat(F.lit("rows/split/"), "split").alias("figure"), F.lit("scorecard").alias("source"), "value", text)
    rate = rows.agg(F.avg("y").alias("value")).select(F.lit("bad_rate/overall").alias("figure"), F.lit("split summary").alias("source"), "value", text)
    prints = sampling.split_fingerprint(splits, "id", "split").select(F.lit("split fingerprint").alias("figure"), F.lit("split summary").alias("source"), number, F.col("fingerprint").alias("text"))
    found = population.reconcile(counts, sizes.unionByName(rate).unionByName(prints), FRACTIONS)
    return found.select("figure", "source", F.round("claimed", 8).alias("claimed"), F.round("recounted", 8).alias("recounted"), "ok")
