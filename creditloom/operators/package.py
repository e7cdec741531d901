"""Frozen model packages: binnings, points and calibration as plain data, with a fingerprint that is checked on load."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import asdict
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.operators.binning import Binning, Cell
from creditloom.operators.rules import fingerprint
from creditloom.operators.scorecard import Calibrator, Fit, Scorecard


def binning_payload(binnings: Mapping[str, Binning]) -> dict[str, Any]:
    """Plain data of binnings; an open edge is null."""
    body = {f: {**asdict(b), "cells": [{**asdict(c), "upper": None if math.isinf(c.upper) else c.upper} for c in b.cells]} for f, b in binnings.items()}
    return {"binnings": body, "fingerprint": fingerprint(body)}


def load_binnings(payload: Mapping[str, Any]) -> dict[str, Binning]:
    if fingerprint(payload["binnings"]) != payload["fingerprint"]:
        raise ValueError("the binnings were changed after they were frozen")
    cell = lambda c: Cell(c["n"], c["bad"], math.inf if c["upper"] is None else c["upper"], tuple(c["names"]))
    out = {}
    for f, b in payload["binnings"].items():
        missing = b["missing"]
        out[f] = Binning(**{**b, "cells": tuple(map(cell, b["cells"])), "missing": Cell(missing["n"], missing["bad"])})
    return out


def freeze(card: Scorecard, calibrator: Calibrator) -> dict[str, Any]:
    body = {
        "fit": asdict(card.fit), "scaling": {"base_score": card.base_score, "base_odds": card.base_odds, "pdo": card.pdo},
        "points": {f: card.points(f) for f in card.fit.features}, "base_points": card.base_points, "calibrator": asdict(calibrator), "binnings": binning_payload(card.binnings),
    }
    return {**body, "fingerprint": fingerprint(body)}


def load(package: Mapping[str, Any]) -> tuple[Scorecard, Calibrator]:
    """The model of a package, if nothing in it has changed and its points follow from its coefficients."""
    body = {k: v for k, v in package.items() if k != "fingerprint"}
    if fingerprint(body) != package["fingerprint"]:
        raise ValueError("the package was changed after it was frozen")
    fit = {**package["fit"], "features": tuple(package["fit"]["features"]), "dropped": tuple(map(tuple, package["fit"]["dropped"]))}
    card = Scorecard(Fit(**fit), load_binnings(package["binnings"]), **package["scaling"])
    if {f: card.points(f) for f in card.fit.features} != package["points"] or card.base_points != package["base_points"]:
        raise ValueError("the points do not follow from the coefficients")
    c = {**package["calibrator"], "xs": tuple(package["calibrator"]["xs"]), "ys": tuple(package["calibrator"]["ys"])}
    return card, Calibrator(**c)


def rescore(package: Mapping[str, Any], rows: DataFrame, reasons: int = 4) -> DataFrame:
    """Score, calibrated PD and reasons from a package alone, reasons in ``reasons`` columns."""
    card, calibrator = load(package)
    out = card.score(rows, reasons)
    return out.withColumn("pd_calibrated", calibrator.apply(F.col("log_odds_bad"))).withColumns({f"reason_{k + 1}": F.get("reasons", F.lit(k)) for k in range(reasons)})


def anchors(card: Scorecard, calibrator: Calibrator, scores=(500, 525, 550, 575, 600, 625, 650)) -> list[tuple[int, float]]:
    """Calibrated PDs at fixed scores."""
    import numpy as np

    odds = -(np.array(scores, float) - card.offset) / card.factor
    return list(zip(scores, map(float, calibrator.values(odds)), strict=True))
