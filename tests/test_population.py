"""The reconciliation of a population, on tables with every kind of fault."""

import pytest
from pyspark.sql import functions as F

from creditloom.operators import population, sampling


def tables(spark, train, test, features, splits, published):
    return (
        spark.createDataFrame(train, "id long, y int"), spark.createDataFrame([(i,) for i in test], "id long"), spark.createDataFrame([(i,) for i in features], "id long"),
        spark.createDataFrame(splits, "id long, split string"), spark.createDataFrame(published, "id long, split string"),
    )


def counted(spark, *parts):
    return population.recount(*tables(spark, *parts), "id", "y", "split")


@pytest.mark.parametrize("partitions", [1, 7])
def test_recount_of_faulty_tables(spark, partitions):
    train = [(1, 1), (2, 0), (3, None), (4, 0), (4, 0), (5, 1), (None, 0)]
    splits = [(1, "train"), (2, "train"), (3, "validation"), (4, "test"), (5, "train"), (5, "test"), (99, "test"), (None, "train")]
    published = [(1, "train"), (1, "train"), (2, "train"), (10, None), (11, None)]
    parts = [t.repartition(partitions) for t in tables(spark, train, [10, 11, 11], [1, 2, 4, 10, 50, None], splits, published)]
    row = population.recount(*parts, "id", "y", "split").first().asDict()
    want = {
        "rows/train": 7, "rows/test": 3, "rows/features": 6, "rows/splits": 8, "rows/published": 5, "rows/split/train": 4, "rows/split/validation": 1, "rows/split/test": 3,
        "published/split/train": 3, "published/split/test": 0, "published/without split": 2, "published/duplicates": 1, "exclusion/train rows without target": 1, "exclusion/duplicate train ids": 2,
        "exclusion/duplicate test ids": 1, "exclusion/train rows without split": 1, "exclusion/split rows outside train": 2, "exclusion/ids in several splits": 1,
        "exclusion/train rows without features": 3, "exclusion/test rows without features": 2, "exclusion/feature rows of no applicant": 2,
    }
    assert {k: row[k] for k in want} == want
    assert row["bad_rate/overall"] == pytest.approx(2 / 6)


def sound(n=100):
    split = lambda i: "train" if i % 5 < 3 else "validation" if i % 5 == 3 else "test"
    train = [(i, i // 5 % 2) for i in range(n)]
    splits = [(i, split(i)) for i in range(n)]
    return train, [n, n + 1], range(n + 2), splits, splits + [(n, None), (n + 1, None)]


def test_a_sound_population_has_no_failure(spark):
    parts = sound()
    finger = sampling.split_fingerprint(spark.createDataFrame(parts[3], "id long, split string"), "id", "split").first().fingerprint
    stated = spark.createDataFrame([("rows/split/train", "scorecard", 60.0, None), ("bad_rate/overall", "summary", 0.5, None), ("split fingerprint", "package", None, finger)], population.STATED)
    got = population.reconcile(counted(spark, *parts), stated, {"train": 0.6, "validation": 0.2, "test": 0.2}).collect()
    assert len(got) == 6 + 3 + 3 + 9 + 3 and all(r.ok for r in got)


def test_every_false_statement_fails(spark):
    train, test, features, splits, published = sound()
    stated = [("rows/split/train", "scorecard", 61.0, None), ("rows/split/test", "scorecard", None, None), ("no such figure", "summary", 1.0, None), ("split fingerprint", "package", None, "1-2-3"), ("split fingerprint", "summary", None, None), ("bad_rate/overall", "summary", 0.51, None)]
    counts = counted(spark, train, test, list(features)[1:], splits, published[1:] + published[-1:])
    got = {(r.figure, r.source) for r in population.reconcile(counts, spark.createDataFrame(stated, population.STATED), {"train": 0.5, "validation": 0.2}).collect() if not r.ok}
    want = {(f, s) for f, s, *_ in stated} | {("exclusion/train rows without features", "no exclusions"), ("published/split/train", "published scores"), ("published/without split", "published scores"), ("published/duplicates", "published scores"), ("share/split/train", "split design"), ("share/split/test", "split design")}
    assert got == want
    loose = population.reconcile(counts, spark.createDataFrame(stated[:1], population.STATED), {"train": 0.6, "validation": 0.2, "test": 0.2}, population.Tolerances(rows=1))
    assert {r.figure for r in loose.collect() if not r.ok} == {"exclusion/train rows without features", "published/duplicates"}


def test_empty_tables_and_bad_tolerances(spark):
    row = counted(spark, [], [], [], [], []).first()
    assert row["rows/train"] == 0 and row["bad_rate/overall"] is None and row["exclusion/duplicate train ids"] == 0
    got = population.reconcile(counted(spark, [], [], [], [], []), spark.createDataFrame([], population.STATED), {"train": 0.6, "validation": 0.2, "test": 0.2}).collect()
    assert {r.figure.split("/")[0] for r in got if not r.ok} == {"share", "bad_rate"}
    with pytest.raises(ValueError, match="negative"):
        population.Tolerances(share=-1.0)


def test_rows_go_to_their_id_before_they_are_counted(spark):
    """A task of a table's scan must not hold the counts of all ids it reads: no wide partial counts ahead of the shuffle."""
    ids = spark.range(100).select(F.col("id"), (F.col("id") % 2).alias("y"), F.lit("train").alias("split"))
    plan = population.recount(ids, ids, ids.select("id"), ids, ids, "id", "y", "split")._jdf.queryExecution().executedPlan().toString()
    wide = [at for at, line in enumerate(plan.splitlines()) if "HashAggregate(keys=[id#" in line]
    dealt = [at for at, line in enumerate(plan.splitlines()) if "REPARTITION_BY_NUM" in line]
    assert len(dealt) == 1 and wide and max(wide) < dealt[0]  # lines further down are earlier steps
