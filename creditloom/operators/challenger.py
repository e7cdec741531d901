"""Boosted-tree challenger: a sample of a grid, each ensemble cut at its best round by average precision on the validation rows."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.operators.metrics import average_precision

# what a trial may set, and the parameter of the trees that it stands for
SETTINGS = {"depth": "maxDepth", "step": "stepSize", "min_rows": "minInstancesPerNode", "share": "subsamplingRate"}
SPACE = {"depth": (2, 3), "step": (0.1, 0.3)}
MAX_TRIALS = 3
ROUNDS = 20
PATIENCE = 8


def trials(space: Mapping[str, Sequence[Any]], max_trials: int, seed: int) -> list[dict[str, Any]]:
    """Points of a grid to try: a seeded sample without repeats, all of them in a seeded order if they are few."""
    unknown = set(space) - set(SETTINGS)
    if unknown or not space or any(not len(v) for v in space.values()) or max_trials < 1:
        raise ValueError(f"unknown settings {sorted(unknown)}" if unknown else "the space needs settings with a value each, and a trial")
    names = sorted(space)
    grid = [dict(zip(names, point, strict=True)) for point in itertools.product(*(space[n] for n in names))]
    return [grid[i] for i in np.random.default_rng(seed).permutation(len(grid))[:max_trials]]


@dataclass(frozen=True)
class Challenger:
    model: PipelineModel
    params: str
    validation_ap: float
    importances: list[tuple[str, float]]
    log: list[tuple[int, str, int, float, bool]]  # trial, params, best round, validation AP, selected

    def predict(self, rows: DataFrame) -> DataFrame:
        return self.model.transform(rows).withColumn("pd", vector_to_array("probability")[1])


def _leaf_values(tree) -> list[float]:
    """Predictions of a tree's leaves from left to right, which is how leaves are numbered."""
    out, open_ = [], [tree._java_obj.rootNode()]
    while open_:
        node = open_.pop()
        if node.numDescendants() == 0:
            out.append(float(node.prediction()))
        else:
            open_ += [node.rightChild(), node.leftChild()]
    return out


def margins_by_round(model, rows: DataFrame, out: str = "margins") -> DataFrame:
    """``rows`` with the array of the ensemble's margins after 1, 2, ... trees: one pass finds the leaf of every tree, and
    running sums of the leaves' values give all rounds."""
    values = F.array(*(F.array(*(F.lit(w * v) for v in _leaf_values(t))) for t, w in zip(model.trees, model.treeWeights, strict=True)))
    placed = model.copy().setLeafCol("_leaves").transform(rows).withColumn("_leaves", vector_to_array("_leaves"))
    step = lambda i: F.get(F.get(values, i), F.get("_leaves", i).cast("int"))
    later = F.slice(F.sequence(F.lit(0), F.lit(len(model.trees) - 1)), 2, len(model.trees))
    summed = F.aggregate(later, F.array(step(F.lit(0))), lambda acc, i: F.array_append(acc, F.element_at(acc, -1) + step(i)))
    return placed.withColumn(out, summed).drop("_leaves")


def precision_by_round(model, rows: DataFrame, target: str) -> list[float]:
    """Average precision of every prefix of the ensemble."""
    each = margins_by_round(model, rows).select(target, F.posexplode("margins").alias("round", "margin"))
    found = average_precision(each.withColumn("margin", F.round("margin", 9)), "margin", target, ["round"]).collect()
    by_round = {r["round"]: r["average_precision"] for r in found}
    return [by_round.get(k) or 0.0 for k in range(len(model.trees))]


def best_round(scores: Sequence[float], patience: int) -> int:
    """The number of rounds to keep: the best up to the first ``patience`` rounds without a better one; earlier ones win ties."""
    best = 0
    for k, score in enumerate(scores):
        if score > scores[best] + 1e-9:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def fit_challenger(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, split: str = "split", grid: Sequence[Mapping[str, Any]] | None = None, rounds: int = ROUNDS, patience: int = PATIENCE,
                   weight: str | None = None, seed: int = 42) -> Challenger:
    """Categories are those of the training rows, others are kept apart; earlier trials win ties.

    Each trial grows ``rounds`` trees and is cut at its best round. Only the trial that is selected is grown again to that
    round, which gives the same trees, as each depends on those before it and the seed alone. ``weight`` counts in training;
    validation rows count alike."""
    grid = trials(SPACE, MAX_TRIALS, seed) if grid is None else grid
    train, validation = rows.where(F.col(split) == "train"), rows.where(F.col(split) == "validation")
    index = [StringIndexer(inputCol=c, outputCol=f"_{c}", handleInvalid="keep", stringOrderType="alphabetAsc") for c in categorical]
    names = [*numeric, *categorical]
    join = VectorAssembler(inputCols=[*numeric, *(f"_{c}" for c in categorical)], outputCol="_x", handleInvalid="keep")
    ahead = Pipeline(stages=[*index, join]).fit(train)
    made, held = ahead.transform(train).cache(), ahead.transform(validation).cache()

    def grow(point: Mapping[str, Any], count: int):
        settings = {SETTINGS[k]: v for k, v in point.items()} | ({"weightCol": weight} if weight else {})
        return GBTClassifier(featuresCol="_x", labelCol=target, maxIter=count, seed=seed, **settings).fit(made)

    try:
        found = []
        for point in grid:
            model = grow(point, rounds)
            scores = precision_by_round(model, held, target)
            keep = best_round(scores, patience)
            found.append((point, model, keep, scores[keep - 1]))
        at = 0
        for k, (*_, score) in enumerate(found):
            at = k if score > found[at][3] + 1e-9 else at
        point, model, keep, score = found[at]
        model = model if keep == len(model.trees) else grow(point, keep)
    finally:
        made.unpersist()
        held.unpersist()
    said = lambda p: ",".join(f"{k}={v}" for k, v in sorted(p.items()))
    weights = model.featureImportances.toArray()
    log = [(k + 1, said(p), n, float(s), k == at) for k, (p, _, n, s) in enumerate(found)]
    return Challenger(PipelineModel([*ahead.stages, model]), f"{said(point)},rounds={keep}", score, sorted(zip(names, map(float, weights), strict=True), key=lambda x: (-x[1], x[0])), log)


def _add_at(values, at: int, step: float):
    return F.transform(values, lambda v, i: v + F.when(i == at, step).otherwise(0.0))


def contributions(found: Challenger, rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each feature's share of the log-odds, along the paths of all trees: a split gives its feature the change of the
    node's value. With ``bias`` they add up to the model's margin. All of it is expressions of the columns."""
    model = found.model.stages[-1]
    x = vector_to_array("_x")
    width = len(names)

    def walk(node, weight: float):
        """Column of an array of contributions from a node on."""
        if node.numDescendants() == 0:
            return F.array(*(F.lit(0.0) for _ in range(width)))
        split, at = node.split(), node.split().featureIndex()
        value = x[at]
        if hasattr(split, "threshold") and "Continuous" in split.getClass().getSimpleName():
            left = value <= float(split.threshold())
        else:
            left = value.isin([float(v) for v in split.leftCategories()])
        sides = []
        for child in (node.leftChild(), node.rightChild()):
            step = weight * (child.prediction() - node.prediction())
            below = walk(child, weight)
            sides.append(_add_at(below, at, step))
        return F.when(left, sides[0]).otherwise(sides[1])

    made = found.model.transform(rows)
    total, bias = None, 0.0
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        root = tree._java_obj.rootNode()
        part = walk(root, float(weight))
        bias += float(weight) * root.prediction()
        total = part if total is None else F.zip_with(total, part, lambda a, b: a + b)
    made = made.withColumn("_c", total)
    return made.select(*rows.columns, F.lit(2 * bias).alias("bias"), *((2 * F.col("_c")[i]).alias(f"contribution_{n}") for i, n in enumerate(names)), (2 * vector_to_array("rawPrediction")[1]).alias("margin"))
