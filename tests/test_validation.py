"""Order statistics, bootstrap and segments against plain numpy on small tables with ties, nulls and hot values."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import metrics, order_stats, rules, segments, uncertainty


@pytest.fixture(scope="module")
def values(spark):
    """A third of the rows share one value; some values and groups are null."""
    rng = random.Random(3)
    rows = [(i, None if i % 17 == 0 else f"g{i % 3}", None if i % 23 == 0 else 5.0 if i % 3 == 0 else rng.randint(0, 40) / 4, rng.randint(0, 9)) for i in range(600)]
    return spark.createDataFrame(rows, "id int, g string, v double, w int").repartition(5).cache()


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("parts", [1, 7])
def test_running_sums_do_not_depend_on_ranges(values, by, parts):
    got = {r.id: r for r in order_stats.running(values, {"upto": "w", "place": F.lit(1)}, [F.desc("v"), "id"], by, parts).collect()}
    groups = {}
    for r in values.collect():
        groups.setdefault(r.g if by else 0, []).append(r)
    for rows in groups.values():
        rows.sort(key=lambda r: (r.v is None, -(r.v or 0), r.id))
        for k, r in enumerate(rows):
            assert (got[r.id].place, got[r.id].place_all) == (k + 1, len(rows))
            assert (got[r.id].upto, got[r.id].upto_all) == (sum(x.w for x in rows[: k + 1]), sum(x.w for x in rows))


def test_ranks_and_codes(values):
    known = [r.v for r in values.collect() if r.v is not None]
    for r in order_stats.value_ranks(values.where("v IS NOT NULL"), "v").collect():
        places = [k + 1 for k, v in enumerate(sorted(known)) if v == r.v]
        assert (r.n, r.average_rank, r.code) == (len(places), sum(places) / len(places), sorted(set(known)).index(r.v))


def test_quantiles_are_linear(values):
    qs = [0.0, 0.1, 0.5, 0.77, 1.0]
    for r in order_stats.quantiles(values, "v", qs, ["g"]).collect():
        assert r.v == pytest.approx(np.quantile([x.v for x in values.collect() if x.g == r.g and x.v is not None], r.q))
    assert order_stats.quantiles(values.where("false"), "v", qs).count() == 0


def test_spearman_with_ties(values):
    rows = [(r.v, r.w) for r in values.collect() if r.v is not None]
    rank = lambda x: np.array([(np.array(x) < v).sum() + ((np.array(x) == v).sum() + 1) / 2 for v in x])
    want = np.corrcoef(rank([a for a, _ in rows]), rank([b for _, b in rows]))[0, 1]
    assert order_stats.spearman(values, "v", "w").first().spearman == pytest.approx(want)
    assert order_stats.spearman(values.withColumn("w", F.lit(1)), "v", "w").first().spearman is None


def test_no_window_over_all_rows(values):
    plan = metrics.equal_count_bands(values, "v", "id", 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") <= 3 and "Exchange SinglePartition" in plan  # the one over the ranges' totals


def scored_rows(spark, n=400, seed=4):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.3).astype(int)
    a, b = rng.integers(0, 12, n) + 4 * y, rng.integers(0, 9, n) + y
    rows = [(i, "u" if i % 2 else "v", int(y[i]), int(a[i]), int(b[i]), float((a[i] + 0.5) / 20), float((b[i] + 0.5) / 20), f"s{i % 4}" if i % 11 else None) for i in range(n)]
    return spark.createDataFrame(rows, "id int, split string, y int, ra int, rb int, pa double, pb double, seg string").cache()


MODELS = {"a": ("ra", "pa"), "b": ("rb", "pb")}


def plain_metrics(score, y, p, times):
    """Metrics of rows that count ``times`` times, by all pairs."""
    bad, good = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    pairs = times[bad][:, None] * times[good][None, :]
    won = (score[bad][:, None] > score[good][None, :]) + (score[bad][:, None] == score[good][None, :]) / 2
    auc = (pairs * won).sum() / pairs.sum()
    ks = max(abs(times[good][score[good] <= s].sum() / times[good].sum() - times[bad][score[bad] <= s].sum() / times[bad].sum()) for s in np.unique(score))
    return {"auc": auc, "gini": 2 * auc - 1, "ks": ks, "brier": (times * (p - y) ** 2).sum() / times.sum()}


@pytest.mark.parametrize("parts", [1, 5])
def test_replicates_equal_numpy_on_the_same_draws(spark, parts):
    rows, size = scored_rows(spark), 6
    got = {(r.split, r.model, r.replicate, r.metric): r.value for r in uncertainty.replicates(rows, MODELS, "y", ["split"], size, 9, parts).collect()}
    cells = rows.groupBy("split", "y", "ra", "pa", "rb", "pb").agg(F.count("*").alias("n")).withColumn("key", F.xxhash64(F.lit(9), "split", "y", "ra", "pa", "rb", "pb")).toPandas()
    assert len(got) == 2 * 2 * (size + 1) * 4
    for split, part in cells.groupby("split"):
        times = uncertainty.cell_draws(part["key"].to_numpy(), part["n"].to_numpy(), size)
        for model, (s, p) in MODELS.items():
            for k in range(size + 1):
                for metric, value in plain_metrics(part[s].to_numpy(), part["y"].to_numpy(), part[p].to_numpy(), times[:, k]).items():
                    assert got[split, model, k, metric] == pytest.approx(value, abs=1e-12)


def test_cells_of_one_score_in_several_turns(spark, monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(8)
    n = 50
    cells = pa.table({"s": np.sort(rng.integers(0, 6, n)).astype(float), "key": np.arange(n), "n": rng.integers(1, 5, n), "y": rng.integers(0, 2, n), "p": rng.random(n)})
    whole = [np.concatenate(x) if k < 2 else sum(x) for k, x in enumerate(zip(*uncertainty.by_score(cells, 3), strict=True))]
    monkeypatch.setattr(uncertainty, "CELLS_A_TURN", 4)
    turns = list(uncertainty.by_score(cells, 3))
    assert (np.concatenate([x[0] for x in turns]) == whole[0]).all() and (np.concatenate([x[1] for x in turns]) == whole[1]).all()
    assert sum(x[2] for x in turns) == pytest.approx(whole[2])


def test_intervals_have_the_spread_of_a_plain_bootstrap(spark):
    rows = scored_rows(spark, 600, 5)
    found = {(r.split, r.model, r.metric): r for r in uncertainty.intervals(uncertainty.replicates(rows, MODELS, "y", ["split"], 300), ["split"]).collect()}
    part = rows.where("split = 'u'").toPandas()
    y, rng, drawn = part["y"].to_numpy(), np.random.default_rng(1), []
    for _ in range(300):
        pick = np.concatenate([rng.choice(np.flatnonzero(y == c), (y == c).sum()) for c in (0, 1)])
        drawn.append(plain_metrics(part["ra"].to_numpy(), y, part["pa"].to_numpy(), np.bincount(pick, minlength=len(y)))["auc"])
    r = found["u", "a", "auc"]
    assert r.ci_low < r.estimate < r.ci_high and r.n == 300 and r.resamples == 300
    assert r.se == pytest.approx(np.std(drawn, ddof=1), rel=0.2)
    assert [r.ci_low, r.ci_high] == pytest.approx(np.quantile(drawn, [0.025, 0.975]), abs=0.02)


def test_differences_are_paired(spark):
    rows = scored_rows(spark).withColumn("rc", F.col("ra") * 2).withColumn("pc", F.col("pa"))
    drawn = uncertainty.replicates(rows, {"a": ("ra", "pa"), "b": ("rb", "pb"), "c": ("rc", "pc")}, "y", ["split"], 40)
    found = uncertainty.differences(drawn, "split", [("a", "c"), ("a", "b")], [("u", "v")]).collect()
    of = {(r.comparison, r.split, r.model, r.metric): r for r in found}
    same = of["c - a", "u", "both", "auc"]  # the same order on the same draws: nothing apart, ever
    assert (same.estimate, same.ci_low, same.ci_high, same.se, same.excludes_zero) == (0, 0, 0, 0, False)
    single = {(r.split, r.model, r.metric): r.estimate for r in uncertainty.intervals(drawn, ["split"]).collect()}
    assert of["b - a", "v", "both", "ks"].estimate == pytest.approx(single["v", "b", "ks"] - single["v", "a", "ks"])
    assert of["u - v", "u, v", "b", "brier"].estimate == pytest.approx(single["u", "b", "brier"] - single["v", "b", "brier"])
    assert not of["u - v", "u, v", "a", "gini"].paired


def test_bootstrap_of_one_class_and_of_nothing(spark):
    rows = scored_rows(spark)
    one = uncertainty.intervals(uncertainty.replicates(rows.where("y = 0"), MODELS, "y", ["split"], 3), ["split"]).collect()
    assert all((r.estimate is None) == (r.metric != "brier") for r in one)
    assert uncertainty.replicates(rows.where("false"), MODELS, "y", ["split"], 3).count() == 0
    with pytest.raises(ValueError):
        uncertainty.differences(rows, "split", [], [])


def test_checks_of_uncertainty(spark):
    found = spark.createDataFrame([("t", "a", "auc", 0.7, 0.6, 0.8), ("t", "a", "ks", 0.3, 0.31, 0.4)], "split string, model string, metric string, estimate double, ci_low double, ci_high double")
    published = spark.createDataFrame([("t", "a", "auc", 0.7), ("t", "b", "auc", 0.6)], "split string, model string, metric string, value double")
    got = {(r.check.split()[0], r.model, r.metric): r.ok for r in uncertainty.uncertainty_checks(found, published).collect()}
    assert got == {("interval", "a", "auc"): True, ("interval", "a", "ks"): False, ("estimate", "a", "auc"): True, ("estimate", "a", "ks"): False, ("estimate", "b", "auc"): False}


def test_segment_table(spark):
    rows = scored_rows(spark)
    table = {(r.split, r.model, r.segment, r.grp): r for r in segments.segment_table(rows, {"s": "seg"}, MODELS, "y", least=40, reject_above=0.4).collect()}
    plain = rows.toPandas().fillna({"seg": "(missing)"})
    assert {k[3] for k in table} == {"(all)", "(missing)", "s0", "s1", "s2", "s3"}
    for (split, model, _, grp), r in table.items():
        part = plain[(plain["split"] == split) & ((plain["seg"] == grp) | (grp == "(all)"))]
        s, p = (part[c].to_numpy() for c in MODELS[model])
        want = plain_metrics(s, part["y"].to_numpy(), p, np.ones(len(part)))
        assert (r.n, r.bads, r.reject_rate) == (len(part), part["y"].sum(), pytest.approx((p > 0.4).mean()))
        assert r.calibration_z == pytest.approx((part["y"].sum() - p.sum()) / np.sqrt((p * (1 - p)).sum()))
        if len(part) < 40:
            assert (r.note, r.auc, r.ks, r.auc_gap_vs_all) == ("few rows", None, None, None)
        else:
            assert (r.auc, r.ks) == (pytest.approx(want["auc"]), pytest.approx(want["ks"]))
        whole = table[split, model, "s", "(all)"]
        if grp == "(all)":
            assert r.auc_gap_vs_all is None and r.adverse_impact_ratio is None and r.share == 1
        else:
            most = max(1 - x.reject_rate for k, x in table.items() if k[:2] == (split, model) and k[3] != "(all)" and x.n >= 40)
            assert r.adverse_impact_ratio == pytest.approx((1 - r.reject_rate) / most) and r.share == pytest.approx(r.n / whole.n)
            assert r.auc is None or r.gini_gap_vs_all == pytest.approx(2 * (r.auc - whole.auc))


def test_segment_checks(spark):
    here, gone = segments.computable({"s": "seg", "x": "nowhere"}, ["seg", "y"])
    assert (here, gone) == ({"s": "seg"}, {"x": "nowhere"})
    with pytest.raises(ValueError, match="nowhere"):
        segments.computable({"x": "nowhere"}, ["seg"])
    rows = scored_rows(spark).withColumn("band", F.when(F.col("ra") >= 8, "1").when(F.col("ra") >= 4, "2").otherwise("3"))
    table = segments.segment_table(rows, {"s": "seg", "band": "band"}, MODELS, "y", least=10)
    checks = {(r.check, r.split, r.segment): r.ok for r in segments.segment_checks(table, gone, "band", "a").collect()}
    assert checks["columns are there", None, "x"] is False
    assert checks["groups make up the split", "u", "s"] and checks["bad rate falls with the band", "v", "band"]
    broken = segments.segment_checks(table.where("grp <> 's1'"), {}).collect()
    assert {r.segment: r.ok for r in broken} == {"s": False, "band": True}


def test_rules_over_segments_and_differences(spark):
    table = spark.createDataFrame(
        [("a", "t", "s", "(all)", 900, "", None, None), ("a", "t", "s", "x", 50, "pd too low", 0.4, -0.2), ("a", "t", "s", "y", 850, "", 1.0, 0.01), ("a", "t", "free", "z", 900, "pd too low", 0.1, -0.9)],
        "model string, split string, segment string, grp string, n int, calibration_flag string, adverse_impact_ratio double, auc_gap_vs_all double",
    )
    stability = spark.createDataFrame([("a", "output", "population", "all", "green"), ("a", "output", "population", "x", "red"), ("a", "feature", "population", "x", "amber"), ("a", "feature", "other", "all", "red")], "model string, kind string, sample string, segment string, light string")
    apart = spark.createDataFrame([("v - t", "a", "gini", 0.1, 0.05, 0.2), ("v - t", "b", "gini", -0.1, -0.2, -0.05), ("v - w", "a", "gini", 0.3, 0.2, 0.4)], "comparison string, model string, metric string, estimate double, ci_low double, ci_high double")
    found = {(r.model, r.measure): r.value for r in rules.measures("t", segments=table, stability=stability, differences=apart, least_group=100, sensitive=["s"]).collect()}
    assert found == {("a", "flagged_groups"): 0, ("a", "least_impact_ratio"): 0.4, ("a", "auc_gap"): 0.2, ("a", "output_light"): 0, ("a", "feature_light"): 1, ("a", "significant_gap"): 0.1, ("b", "significant_gap"): 0.0}


def test_recalibration_equals_plain_newton(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-8, 9, 500) / 4
    y = (rng.random(500) < 1 / (1 + np.exp(-(0.3 + 0.8 * x)))).astype(int)
    got = metrics.recalibrate(spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y, strict=True)], "x double, y int"), "x", "y")
    beta, design = np.zeros(2), np.stack([np.ones(500), x], axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ beta))
        beta += np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]), design.T @ (y - p))
    assert [got["intercept"], got["slope"]] == pytest.approx(beta.tolist(), abs=1e-9)
