"""The challenger's search: sampled grid, margins of every prefix, early stopping, weights."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from creditloom.operators import challenger


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 900
    x, z, c = rng.normal(size=n), rng.normal(size=n), rng.integers(0, 3, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x + (c == 1) - 0.5)))).astype(int)
    data = [(i, ("train", "train", "validation", "test")[i % 4], float(x[i]), float(z[i]), f"c{c[i]}", int(y[i]), 1.0 + 3 * int(y[i])) for i in range(n)]
    return spark.createDataFrame(data, "id int, split string, x double, z double, c string, y int, w double").cache()


def test_sampled_grid():
    space = {"depth": (2, 3, 4), "step": (0.1, 0.2)}
    picked = challenger.trials(space, 4, 7)
    assert picked == challenger.trials(space, 4, 7) and len({tuple(sorted(p.items())) for p in picked}) == 4
    assert len(challenger.trials(space, 99, 7)) == 6 and challenger.trials(space, 4, 8) != picked
    for wrong, n in (({}, 1), ({"depth": ()}, 1), ({"leaves": (3,)}, 1), (space, 0)):
        with pytest.raises(ValueError):
            challenger.trials(wrong, n, 1)


def test_best_round():
    assert challenger.best_round([0.1, 0.3, 0.3, 0.2, 0.9], 2) == 2  # stopped before the last
    assert challenger.best_round([0.1, 0.3, 0.3, 0.2, 0.9], 3) == 5
    assert challenger.best_round([0.0], 1) == 1


def test_margins_of_every_prefix(rows):
    found = challenger.fit_challenger(rows, ["x", "z"], ["c"], "y", grid=[{"depth": 3, "step": 0.3}], rounds=6, patience=6)
    *ahead, model = found.model.stages
    made = rows.where("split = 'test'")
    for stage in ahead:
        made = stage.transform(made)
    margins = {r.id: r.margins for r in challenger.margins_by_round(model, made).collect()}
    for k in range(1, len(model.trees) + 1):
        if k == len(model.trees):
            for r in model.transform(made).select("id", (2 * vector_to_array("rawPrediction")[1] / 2).alias("m")).collect():
                assert margins[r.id][-1] == pytest.approx(r.m)
    trees = {}
    for k, (tree, weight) in enumerate(zip(model.trees, model.treeWeights, strict=True)):
        for r in tree.transform(made).select("id", "prediction").collect():
            trees[r.id, k] = weight * r.prediction
    for i, got in margins.items():
        assert got == pytest.approx(np.cumsum([trees[i, k] for k in range(len(model.trees))]).tolist())


def test_the_selected_model_is_cut_at_its_best_round(rows):
    found = challenger.fit_challenger(rows, ["x", "z"], ["c"], "y", grid=[{"depth": 2, "step": 0.1}, {"depth": 4, "step": 0.5}], rounds=10, patience=2)
    chosen = next(row for row in found.log if row[4])
    assert len(found.log) == 2 and chosen[3] == max(row[3] for row in found.log) == found.validation_ap
    assert len(found.model.stages[-1].trees) == chosen[2] and found.params.endswith(f"rounds={chosen[2]}")
    pd = found.predict(rows.where("split = 'test'"))
    assert pd.agg(F.corr("pd", "y")).first()[0] > 0.2


def test_weights_raise_the_scores_of_the_weighted_class(rows):
    mean = {}
    for weight in (None, "w"):
        found = challenger.fit_challenger(rows, ["x"], ["c"], "y", grid=[{"depth": 2}], rounds=4, patience=4, weight=weight)
        mean[weight] = found.predict(rows).agg(F.avg("pd")).first()[0]
    assert mean["w"] > mean[None] + 0.1
