"""Checks of models' scores and tables by band, against plain Python."""

import random

import numpy as np
import pytest

from creditloom.operators import early_warning, model_checks


def test_bands_equal_numpy(spark):
    rng = random.Random(4)
    rows = [(i, rng.randrange(12), rng.randrange(2), rng.random()) for i in range(137)]
    got = model_checks.score_band_table(spark.createDataFrame(rows, "id long, s int, y int, p double").repartition(5), "s", "y", "p", "id", 7).orderBy("band").collect()
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    edges = np.quantile(np.arange(1, 138), np.linspace(0, 1, 8))
    band = [max(1, int(np.searchsorted(edges, i + 1, side="left"))) for i in range(137)]
    for r in got:
        of = [x for x, b in zip(order, band, strict=True) if b == r.band]
        assert (r.score_min, r.score_max, r.n) == (of[0][1], of[-1][1], len(of))
        assert r.bad_rate == pytest.approx(np.mean([x[2] for x in of])) and r.pd_mean == pytest.approx(np.mean([x[3] for x in of]))
    assert sum(r.n for r in got) == 137


def run(spark, scores, reported=(("a", 0.7), ("b", 0.8)), selected="b", weights=(1.0, 1.0, 1.0, 1.0), monthly=(("test", 1), ("test", 2))):
    dataset = spark.createDataFrame([(i, i % 2, "train" if i < 4 else "test") for i in range(10)], "id long, y int, split string")
    sample = spark.createDataFrame([(i % 2, w) for i, w in enumerate(weights)], "y int, w double")
    table = spark.createDataFrame(list(reported), "model string, value double")
    months = spark.createDataFrame(list(monthly), "split string, events long")
    events = spark.createDataFrame([("test", 3)], "split string, events long")
    scores = spark.createDataFrame(scores, "id long, p double, q double")
    out = model_checks.model_checks(dataset, scores, ["id"], ["p", "q"], table, {"a": 0.7, "b": 0.8}, selected, sample, "y", "w", months, events)
    return {r.check for r in out.collect() if not r.ok}


def test_model_checks_name_each_fault(spark):
    sound = [(i, 0.1 * i, 1.0) for i in range(10)]
    assert run(spark, sound) == set()
    assert run(spark, sound[1:]) == {"dataset rows scored once"}
    assert run(spark, sound + [(77, 0.5, 0.5)]) == {"scored rows beside them"}
    assert run(spark, sound + sound[:1]) == {"dataset rows scored once", "scored rows beside them"}
    assert run(spark, [(0, float("nan"), 0.5), (1, None, 0.5), (2, 0.5, 1.5), *sound[3:]]) == {"PDs outside 0 to 1"}
    assert run(spark, sound, reported=[("a", 0.7)]) == {"reported metrics as used", "place of the selected model"}
    assert run(spark, sound, selected="a") == {"place of the selected model"}
    assert run(spark, sound, weights=(1.0, 2.0, 1.0, 2.0)) == {"event rate of the weighted sample"}
    assert run(spark, sound, weights=()) == {"event rate of the weighted sample"}
    assert run(spark, sound, monthly=[("test", 2), ("train", 0)]) == {"monthly events apart"}


def test_scoring_rows(spark):
    scores = spark.createDataFrame([(1, True, 0.5), (2, False, 0.6), (3, None, 0.7)], "id long, scoring_row boolean, pd double")
    assert [tuple(r) for r in early_warning.scoring_rows(scores, ["id", "pd"]).collect()] == [(1, 0.5)]
    with pytest.raises(ValueError, match="age"):
        early_warning.scoring_rows(scores, ["id", "age"])
