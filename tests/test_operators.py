"""Hand-computed cases, and checks that catch what is broken on purpose."""

import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import binning, checks, labels, metrics, rules, sampling, scorecard, survival
from creditloom.sources import contracts, publish, readers


def months(spark, states, start=2019):
    rows = [(k, date(start + i // 12, 1 + i % 12, 1), s) for k, seq in states.items() for i, s in enumerate(seq) if s is not None]
    return spark.createDataFrame(rows, "id string, period date, state string")


def label_of(spark, seq, **kw):
    out = labels.label_windows(months(spark, {"a": seq}), "id", "state", 3, F.add_months, **kw).orderBy("period").first()
    return out.y, out.event_offset, out.exclusion_reason


@pytest.mark.parametrize(
    ("seq", "want"),
    [
        ("NNNN", (0, None, None)), ("NNBN", (1, 2, None)), ("NPNN", (0, None, None)), (["N", "N", None, "B"], (None, None, "incomplete_performance_window")),
        (["N", "B", None, "N"], (1, 1, None)), ("NXBN", (None, None, "incomplete_performance_window")), ("NN", (None, None, "incomplete_performance_window")), ("BNNN", (None, None, "already_bad_at_t")),
        ("XNNN", (None, None, "status_not_available_at_t")), ("PNNN", (None, None, "inactive_at_t")),
    ],
)
def test_labels(spark, seq, want):
    assert label_of(spark, seq) == want


def test_prior_bad_is_excluded_on_request(spark):
    p = months(spark, {"a": "BNNNN"})
    rows = labels.label_windows(p, "id", "state", 3, F.add_months, exclude_prior_bad=True).orderBy("period").collect()
    assert rows[1].exclusion_reason == "prior_bad_excluded"
    assert labels.label_windows(p, "id", "state", 3, F.add_months).orderBy("period").collect()[1].y == 0


def scored(spark, rows):
    return spark.createDataFrame(rows, "id int, s int, y int")


def test_discrimination_by_hand(spark):
    d = metrics.discrimination(scored(spark, [(1, 1, 0), (2, 2, 0), (3, 2, 1), (4, 3, 1)]), "s", "y").first()
    assert d.auc == pytest.approx((1 + 1 + 0.5 + 1) / 4) and d.ks == pytest.approx(0.5) and d.ks_threshold == 1
    assert d.tied_share == pytest.approx(0.25)


def test_one_class_has_no_auc(spark):
    assert metrics.discrimination(scored(spark, [(1, 1, 0), (2, 2, 0)]), "s", "y").first().auc is None


def test_average_precision_ties_enter_together(spark):
    rows = scored(spark, [(1, 3, 1), (2, 3, 0), (3, 2, 1), (4, 1, 0)])
    assert metrics.average_precision(rows, "s", "y").first()[0] == pytest.approx(0.5 * 0.5 + 0.5 * 2 / 3)


def test_chi2_tail():
    assert metrics.chi2_sf(15.507, 8) == pytest.approx(0.05, abs=1e-4)
    assert metrics.chi2_sf(0, 5) == 1 and metrics.chi2_sf(1, 1) == pytest.approx(0.3173, abs=1e-4)


def test_recalibration_of_true_odds(spark):
    rows = [(math.log(p / (1 - p)), y) for p in (0.2, 0.5, 0.8) for y in [1] * int(p * 100) + [0] * (100 - int(p * 100))]
    out = metrics.recalibrate(spark.createDataFrame(rows, "lo double, y int"), "lo", "y")
    assert out["slope"] == pytest.approx(1, abs=1e-6) and out["intercept"] == pytest.approx(0, abs=1e-6)


def test_survival_by_hand(spark):
    loans = spark.createDataFrame([("g", 0, 1, 1), ("g", 0, 2, 2), ("g", 1, 2, 1), ("g", 0, 2, 0)], "g string, entry int, time int, cause int")
    out = {r.mob: r for r in survival.survival_tables(loans, ["g"], 10).collect()}
    assert [out[m].at_risk for m in (0, 1, 2)] == [3, 4, 3]
    assert out[1].cif_default == pytest.approx(0.25) and out[2].cif_default == pytest.approx(0.25 + 0.75 / 3) and out[2].cif_payoff == pytest.approx(0.25)


def test_hazard_of_one_ends_survival(spark):
    loans = spark.createDataFrame([("g", 0, 1, 1), ("g", 0, 1, 1)], "g string, entry int, time int, cause int")
    assert survival.survival_tables(loans, ["g"], 3).orderBy(F.desc("mob")).first().km_default == 1.0


def test_woe_adjusts_every_bin():
    weights, value, adjusted = binning.woe([10, 10], [0, 5])
    assert adjusted and weights[0] == pytest.approx(math.log((10.5 / 16) / (0.5 / 6))) and value > 0
    assert binning.woe([10], [3])[1] == 0


def test_binning_merges():
    cell = lambda n, b, u=math.inf: binning.Cell(n, b, u)
    assert [c.n for c in binning.merge_small([cell(2, 1, 1), cell(50, 5, 2), cell(48, 20)], 100, 0.05)] == [52, 48]
    assert [c.n for c in binning.make_monotonic([cell(10, 1, 1), cell(10, 4, 2), cell(10, 3)], "increasing")] == [10, 20]
    shaped, shape = binning.make_unimodal([cell(100, 5, 1), cell(100, 30, 2), cell(100, 4)], 0.5)
    assert shape == "inverted_u" and len(shaped) == 3
    assert len(binning.merge_to([cell(10, k, k) for k in range(6)], 3)) == 3


def test_binning_is_fitted_on_training_rows_only(spark):
    rows = spark.createDataFrame([(float(i), int(i > 60 or i % 7 == 0), "ab"[i % 2], i < 100) for i in range(200)], "x double, y int, c string, train boolean")
    fit = lambda df: binning.fit_binnings(df.where("train"), ["x"], ["c"], "y")["x"].table()
    assert fit(rows) == fit(rows.withColumn("y", F.when(F.col("train"), F.col("y")).otherwise(1 - F.col("y"))))


def test_unknown_bins(spark):
    b = binning.fit_binnings(spark.createDataFrame([(float(i), i % 3 == 0 and 1 or 0, "ab"[i % 2]) for i in range(60)], "x double, y int, c string"), ["x"], ["c"], "y")
    row = spark.range(1).select(b["c"].label_of(F.lit("zz")).alias("l"), b["c"].woe_of(F.lit("zz")).alias("w"), b["x"].label_of(F.lit(None).cast("double")).alias("m")).first()
    assert (row.l, row.w, row.m) == ("other", 0.0, "missing")
    with pytest.raises(ValueError):
        binning.woe_lookup(spark.createDataFrame([("q",)], "k string"), "k", spark.createDataFrame([("p", 0.1)], "label string, woe double"))


def test_scorecard_and_calibration():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 2))
    p = 1 / (1 + np.exp(1 + x[:, 0]))
    fit = scorecard.fit_sign_stable(["a", "b"], x, 100 * (1 - p), 100 * p, resamples=10)
    assert fit.features[0] == "a" and fit.coefficients["a"] == pytest.approx(-1, abs=0.05)
    iso = scorecard.fit_calibrator("isotonic", np.array([0.0, 1, 2, 3]), np.array([9.0, 5, 6, 1]), np.array([1.0, 5, 4, 9]))
    assert list(iso.values(np.array([0.0, 1, 2, 3]))) == pytest.approx([0.1, 0.45, 0.45, 0.9])
    platt = scorecard.fit_calibrator("platt", np.array([-1.0, 1]), np.array([80.0, 20]), np.array([20.0, 80]))
    assert platt.b == pytest.approx(math.log(4), abs=1e-6)


def test_selection_drops_twins():
    corr = np.array([[1, 0.9, 0.1], [0.9, 1, 0.1], [0.1, 0.1, 1]])
    said = {f: step for f, step, _ in scorecard.select_features({"a": 0.3, "b": 0.4, "c": 0.01}, corr, np.eye(3))}
    assert said == {"a": "correlation", "b": "selected", "c": "iv_min"}


def test_contract_rejects_and_catches(spark):
    with pytest.raises(ValueError):
        contracts.parse_contract({"name": "x", "format": "xml"})
    with pytest.raises(ValueError):
        contracts.parse_contract({"name": "x", "format": "csv", "tables": {"t": {"columns": {"a": {"colour": 1}}}}})
    c = contracts.parse_contract({"name": "x", "format": "csv", "tables": {"t": {"primary_key": ["a"], "columns": {"a": {"dtype": "integer", "nullable": False, "high": 5}}}}})
    bad = {r.rule for r in checks.check_table(spark.createDataFrame([(1,), (1,), (9,), (None,)], "a long"), c.tables["t"]).where("not ok").collect()}
    assert bad == {"not_null", "range", "primary_key"}
    with pytest.raises(ValueError):
        checks.stop_if_failed(spark.createDataFrame([("c", 1.0, 2.0, "s", False)], checks.CHECK_SCHEMA), "step")


def test_pipe_files_round_trip(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "x.txt").write_text("F19Q1|201903| 7 \nF19Q2|201904|NA\n")
    spec = {"name": "s", "format": "pipe", "tables": {"p": {"columns": {"id": {}, "m": {"dtype": "yyyymm"}, "n": {"dtype": "integer", "na_values": ["NA"]}}}}}
    c = contracts.parse_contract(spec)
    readers.check_field_count(spark, c.tables["p"], readers.raw_files(spark, c.tables["p"], str(tmp_path)))
    assert readers.ingest(spark, c, str(tmp_path), str(tmp_path / "out")) == {"p": 2}
    rows = publish.load(spark, str(tmp_path / "out" / "p")).orderBy("id").collect()
    assert [(r.m, r.n, r.source_file) for r in rows] == [(date(2019, 3, 1), 7, "x.txt"), (date(2019, 4, 1), None, "x.txt")]
    (tmp_path / "p" / "y.txt").write_text("only|two\n")
    with pytest.raises(ValueError):
        readers.check_field_count(spark, c.tables["p"], readers.raw_files(spark, c.tables["p"], str(tmp_path)))


def test_strict_casts(spark):
    from creditloom.sources.contracts import ColumnSpec

    with pytest.raises(Exception):  # noqa: B017
        spark.createDataFrame([("x1",)], "a string").select(readers.typed(ColumnSpec("a", "integer"), F.col("a"))).collect()


def test_apportion_and_split(spark):
    assert sampling.apportion(10, {"a": 0.55, "b": 0.25, "c": 0.2}) == {"a": 6, "b": 2, "c": 2} or sum(sampling.apportion(10, {"a": 0.55, "b": 0.25, "c": 0.2}).values()) == 10
    rows = spark.range(101).withColumn("g", F.col("id") % 2)
    n = {(r.g, r.split): r["count"] for r in sampling.stratified_split(rows, "id", ["g"], {"a": 0.6, "b": 0.4}, 1).groupBy("g", "split").count().collect()}
    assert n[0, "a"] + n[0, "b"] == 51 and n[0, "a"] in (30, 31)


def test_rules(spark):
    bound = rules.Bound
    bounds = [bound("blocking_checks", "failed_checks", "remediate", start=1), bound("auc_ci_lower", "auc_ci_low", "remediate", low=0.6), bound("auc_ci_lower", "auc_ci_low", "note", low=0.7),
              bound("flagged_bands", "flagged_bands", "note", start=2), bound("slope", "slope", "note", low=0.9, high=1.1), bound("slope", "slope_z", "remediate", high=3), bound("output_psi", "output_light", "note", start=1)]
    found = rules.measures(
        "test", intervals=spark.createDataFrame([("a", "test", "auc", 0.65), ("b", "test", "auc", 0.7)], "model string, split string, metric string, ci_low double"),
        bands=spark.createDataFrame([("a", "test", True), ("a", "test", True), ("b", "test", True)], "model string, split string, flagged boolean"),
        calibration=spark.createDataFrame([("a", "test", 1.1, -3.0, 1.0), ("b", "test", 0.89, 3.5, 1.0)], "model string, split string, slope double, slope_z_vs_1 double, ratio_bad_rate_to_pd double"),
        checks=spark.createDataFrame([("package", False), ("stability", False)], "module string, ok boolean"),
    )
    got = {(r.rule, r.model): (r.outcome, r.value, r.verdict) for r in rules.conclude(found, bounds).collect()}
    assert got["auc_ci_lower", "a"][:2] == ("note", 0.65) and got["auc_ci_lower", "b"][0] == "pass"
    assert got["flagged_bands", "a"][0] == "note" and got["flagged_bands", "b"][0] == "pass"
    assert got["slope", "a"][0] == "pass" and got["slope", "b"][:2] == ("remediate", 0.89)
    assert got["blocking_checks", "b"][:2] == ("remediate", 1.0) and got["output_psi", "a"][:2] == ("skipped", None)
    assert {v for _, _, v in got.values()} == {"remediate"}
    with pytest.raises(ValueError):
        rules.conclude(found, [bound("no_such_rule", "x", "note")])
    assert rules.recommend({"a": "pass", "b": "note"}, "a", "b", {"estimate": 0.1, "ci_low": 0.05, "ci_high": 0.2}) == {"deploy": "b", "benchmark": "a"}
    assert rules.recommend({"a": "pass", "b": "note"}, "a", "b", None)["deploy"] == "a"


def test_availability_and_manifest():
    m = rules.Availability({"x_*": {"timing": "post_decision", "use": True}}, {"timing": "application", "use": True})
    with pytest.raises(ValueError):
        m.resolve("x_1")
    assert m.usable(["y"]) == ["y"]
    with pytest.raises(ValueError):
        rules.Availability({}, {"use": False}).gate({"f": ["y"]})
    assert rules.fingerprint({"a": 0.1 + 0.2}) == rules.fingerprint({"a": 0.3})
    assert rules.latest_ok([{"run_id": "1", "steps": {"s": "ok"}}, {"run_id": "2", "steps": {"s": "failed"}}], "s") == "1"
    assert rules.check_definitions({}) and rules.worst(["pass", "note"]) == "note"


def test_package_round_trip(spark, tmp_path):
    from creditloom.operators import package
    from creditloom.sources import sinks

    rows = spark.createDataFrame([(float(i % 50), "ab"[i % 2], int((i * 7) % 50 < i % 50 - 10)) for i in range(500)], "x double, c string, y int")
    fits = binning.fit_binnings(rows, ["x"], ["c"], "y", binning.BinningSpec(initial_bins=5, max_bins=4))
    x, good, bad = scorecard.patterns(rows, fits, "y")
    card = scorecard.Scorecard(scorecard.fit_sign_stable(list(fits), x, good, bad, resamples=5, least=0.51), fits)
    frozen = package.freeze(card, scorecard.Calibrator("platt", 0.1, 0.9))
    again = package.rescore(frozen, rows, 2)
    assert again.select("score").exceptAll(card.score(rows).select("score")).count() == 0
    assert len(package.anchors(*package.load(frozen))) == 7
    with pytest.raises(ValueError):
        package.load({**frozen, "base_points": frozen["base_points"] + 1})
    sinks.write_outputs({"t": again.groupBy("score").count()}, {"n": 1}, str(tmp_path / "out"))
    tables, metrics_back = sinks.read_outputs(spark, str(tmp_path / "out"), "t")
    assert tables["t"].agg(F.sum("count")).first()[0] == 500 and metrics_back == {"n": 1}


def test_stream_book(spark, tmp_path, data):
    from creditloom.streaming.book import stream_book, write_book

    events = spark.read.parquet(f"{data}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = write_book(stream_book(stream, "ts", F.when(F.col("event_type") == "error", 3).otherwise(0), [0, 3]), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = events.groupBy(F.date_trunc("day", "ts").alias("period")).agg(F.count("*").alias("rows"))
    assert got.count() > 0 and got.join(want, ["period", "rows"]).count() == got.count()
