"""Comparison of published figures, a second AUC, head to head, and quota samples, against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import figures, metrics, sampling


def table(spark, rows):
    return spark.createDataFrame(rows, "module string, key string, value double")


def test_compare_names_every_problem(spark):
    published = table(spark, [("m", "same", 1.0), ("m", "near", 1.0), ("m", "apart", 1.0), ("m", "alone", 1.0), ("m", "twice", 1.0), ("m", "twice", 1.0), ("m", "empty", None), ("other", "near", 1.0)])
    again = table(spark, [("m", "same", 1.0), ("m", "near", 1.0005), ("m", "apart", 1.1), ("m", "fresh", 1.0), ("m", "twice", 1.0), ("m", "empty", 2.0), ("other", "near", 1.0005)])
    got = {(r.module, r.key): r.problem for r in figures.compare(published, again, {"m": 1e-3}).collect()}
    assert got == {("m", "same"): "", ("m", "near"): "", ("m", "apart"): "apart", ("m", "alone"): "not recomputed", ("m", "fresh"): "not published", ("m", "twice"): "repeated", ("m", "empty"): "no value", ("other", "near"): "apart"}
    assert all(r.ok == (r.problem == "") for r in figures.compare(published, again).collect())
    assert figures.compare(published.where("false"), again.where("false")).count() == 0


def test_figures_of_a_table(spark):
    df = spark.createDataFrame([("a", 1, 0.5, 3), (None, 2, None, 4)], "k string, s int, x double, n long")
    got = sorted((r.key, r.value) for r in figures.figures(df, "m", ["k", "s"], ["x", "n"]).where("value is not null").collect())
    assert got == [("-/2/n", 4.0), ("a/1/n", 3.0), ("a/1/x", 0.5)]


def scored(spark, n=500):
    rng = np.random.default_rng(12)
    y = (rng.random(n) < 0.3).astype(int)
    a, b = rng.integers(0, 15, n) + 3 * y, rng.integers(0, 11, n) + 2 * y
    return spark.createDataFrame([(i, int(y[i]), int(a[i]), int(b[i]), float(a[i] + 0.5) / 20, float(b[i] + 0.5) / 16) for i in range(n)], "id int, y int, ra int, rb int, pa double, pb double").cache()


def test_two_ways_to_an_auc(spark):
    rows = scored(spark).withColumn("g", F.col("id") % 3)
    one = {r.g: r.auc for r in metrics.discrimination(rows, "ra", "y", ["g"]).collect()}
    assert {r.g: pytest.approx(r.auc, abs=1e-12) for r in figures.rank_auc(rows, "ra", "y", ["g"]).collect()} == one
    assert figures.rank_auc(rows.where("y = 1"), "ra", "y").first().auc is None


def test_bands_add_up_to_the_rows(spark):
    rows = scored(spark).withColumn("model", F.lit("a"))
    whole = figures.calibration_figures(rows, "pa", "y", ["model"]).where("key like '%/n' or key like '%/bads' or key like '%/mean_pd'")
    checked = figures.compare(whole, figures.band_totals(rows, "pa", "y", "id", 7, {"model": "a"}), 1e-9).collect()
    assert len(checked) == 3 and all(r.ok for r in checked)


def test_head_to_head_by_hand(spark):
    rows = scored(spark)
    data = rows.collect()
    got = {(r.module, r.key): r.value for r in figures.head_to_head(rows, ("ra", "rb"), ("pa", "pb"), "y", "id", 0.5, 0.1).collect()}
    by = lambda c: sorted(data, key=lambda r: (-r[c], r.id))
    top = {c: {r.id for r in by(c)[:50]} for c in ("ra", "rb")}
    assert got["agreement", "top_overlap"] == len(top["ra"] & top["rb"]) / 50
    only = [r.y for r in data if r.id in top["ra"] - top["rb"]]
    assert got["agreement", "bad_rate_only_first_top"] == pytest.approx(sum(only) / len(only))
    cells = Counter((r.pa >= 0.5, r.pb >= 0.5) for r in data)
    assert got["swap_set", "only first rejects/n"] == cells[True, False] and got["swap_set", "both accept/n"] == cells[False, False]
    first = cells[True, True] + cells[True, False]
    assert got["decisions", "rejects_first"] == first and got["equal_volume", "bads_second_at_first_volume"] == sum(r.y for r in by("rb")[:first])


def test_comparison_identities_find_a_lost_cell(spark):
    found = figures.head_to_head(scored(spark), ("ra", "rb"), ("pa", "pb"), "y", "id", 0.5)
    for kept, fine in ((found, True), (found.where("key <> 'both reject/n'"), False)):
        sides = figures.comparison_identities(kept, 500)
        checked = figures.compare(*(sides.where(F.col("side") == s).drop("side") for s in ("published", "recomputed")))
        assert all(r.ok for r in checked.collect()) == fine


@pytest.mark.parametrize("n", [1, 10, 90, 5000])
def test_quota_sample_is_the_same_on_any_partitioning(spark, n):
    rng = random.Random(1)
    rows = [(i, rng.choice("aaaaaaab"), None if i % 50 == 0 else i % 3) for i in range(1200)] + [(5000, "rare", 1)]
    df = spark.createDataFrame(rows, "id int, s string, t int")
    got = [sorted(map(tuple, sampling.quota_sample(df.repartition(p), "id", ["s", "t"], n, 3).collect()), key=repr) for p in (1, 50)]
    assert got[0] == got[1]
    strata = {}
    for r in rows:
        strata.setdefault(r[1:], []).append(r)
    want = []
    for members in strata.values():
        quota = min(len(members), max(1, int(len(members) / len(rows) * n + 0.5)))
        want += sorted(members, key=lambda r: (hashlib.md5(f"{r[0]}:3".encode()).hexdigest(), r[0]))[:quota]
    assert got[0] == sorted(want, key=repr)


def test_quota_sample_of_nothing(spark):
    df = spark.createDataFrame([], "id int, s string")
    assert sampling.quota_sample(df, "id", ["s"], 5, 1).count() == 0
    with pytest.raises(ValueError):
        sampling.quota_sample(df, "id", ["s"], 0, 1)
