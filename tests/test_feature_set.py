"""The feature registry by hand: frames by calendar, lineage, what stops it, and the checks of its dataset."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from creditloom.operators import feature_set
from creditloom.operators.rules import Availability
from creditloom.sources import publish

PERF = "loan_id int, period date, loan_age int, current_upb double, current_interest_rate double, current_non_interest_bearing_upb double, delinquency_status string, modification_flag string, payment_deferral_flag string, delinquency_due_to_disaster string, borrower_assistance_plan string"
ORIG = ", ".join([*(f"{c} double" for c in feature_set.ORIGINATION_NUMBERS), *(f"{c} string" for c in feature_set.ORIGINATION_CLASSES)])
LABEL = "loan_id int, period date, split string, regime string, y int, event_offset int, bucket_at_t string, ever_bad_before boolean, exclusion_reason string"


def months(*states, start=1, skip=()):
    return [(1, date(2020, start + k, 1), k, 100.0 - k, 4.0, 10.0 if s == "03" else None, s, " Y" if s == "02" else " ", "", None, "F" if s == "01" else " ") for k, s in enumerate(states) if k not in skip]


@pytest.fixture(scope="module")
def origination(spark):
    return spark.createDataFrame([(1, 700.0, 80.0, 85.0, None, 3.5, 200.0, 360.0, 0.0, 2.0, 1.0, "P", "C", "R", "SF", "N", None, "TX")], f"loan_id int, {ORIG}")


def labels_of(spark, rows, **more):
    return spark.createDataFrame([(r[0], r[1], more.get("split", "train"), "new", more.get("y", 0), None, "current", True, more.get("reason")) for r in rows], LABEL)


def build(spark, rows, origination, labels=None, names=None, month=date(2030, 1, 1), **kw):
    made = feature_set.dataset(spark.createDataFrame(rows, PERF), origination, labels or labels_of(spark, rows), 3, month, names, **kw)
    return {r.period.month: r for r in made.collect()}


def test_all_features_by_hand(spark, origination):
    got = build(spark, months("00", "01", "02", "XX", "03", "00"), origination)
    assert len(feature_set.registry()) == 34 and len(got) == 6
    assert [got[m].bucket_num for m in range(1, 7)] == [0, 1, 2, None, 3, 0]
    assert [got[m].bucket_change_1m for m in range(1, 7)] == [0, 1, 1, None, None, -3]
    assert [got[m].months_30plus_window for m in range(1, 7)] == [0, 1, 2, 2, 2, 1]
    assert [got[m].max_bucket_window for m in range(1, 7)] == [0, 1, 2, 2, 3, 3]
    assert [got[m].months_since_delinquent for m in range(1, 7)] == [999, 0, 0, 1, 0, 1]
    assert [got[m].history_months_window for m in range(1, 7)] == [1, 2, 3, 3, 3, 3]
    assert [got[m].assistance_months_window for m in range(1, 7)] == [0, 1, 1, 1, 0, 0]
    r = got[5]
    assert (r.upb_ratio, r.paydown_window, r.rate_change) == (96 / 200, 2 / 200, 0.5)
    assert (r.non_interest_bearing_share, got[6].non_interest_bearing_share) == (10 / 96, 0)
    assert (got[3].modified, r.modified, r.payment_deferral, r.disaster, r.ever_90plus_before_t) == (1, 0, 0, 0, 1)
    assert (r.fico, r.orig_dti, r.occupancy_status, r.harp_indicator, got[2].assistance_plan_at_t, r.assistance_plan_at_t) == (700, None, "P", None, "F", "none")


def test_windows_count_months_not_rows(spark, origination):
    got = build(spark, months("01", "01", "01", "00", "00", "00", skip=(2, 3, 4)), origination)
    assert got[6].months_30plus_window == 0 and got[6].history_months_window == 1 and got[6].bucket_change_1m == 0
    assert got[6].months_since_delinquent == 4


def test_later_months_change_nothing(spark, origination):
    short, long = months("00", "01", "00"), months("00", "01", "00", "03", "03")
    a, b = build(spark, short, origination), build(spark, long, origination)
    assert all(a[m] == b[m] for m in (1, 2, 3))


def test_one_sort_for_all_features(spark):
    rows = spark.createDataFrame(months("00", "01"), PERF)
    plan = feature_set.panel_features(rows, feature_set.chosen(None), 12)._jdf.queryExecution().executedPlan().toString().split("\n")
    final = [line for line in plan if "Sort [" in line or "Exchange hash" in line]
    assert len([x for x in final if "Sort" in x]) == 1 and len([x for x in final if "Exchange" in x]) == 1


def test_names_and_lineage_are_held_against_the_matrix(spark, origination):
    with pytest.raises(ValueError, match="unknown"):
        feature_set.chosen(["fico", "nothing"])
    with pytest.raises(ValueError, match="twice"):
        feature_set.chosen(["fico", "fico"])
    assert feature_set.lineage(feature_set.chosen(["upb_ratio"])) == [("upb_ratio", "origination.orig_upb"), ("upb_ratio", "performance.current_upb")]
    matrix = Availability({"performance.current_upb": {"timing": "unknown", "use": False}}, {"timing": "application", "use": True})
    with pytest.raises(ValueError, match="upb_ratio"):
        build(spark, months("00"), origination, names=["fico", "upb_ratio"], matrix=matrix)
    assert build(spark, months("00"), origination, names=["fico"], matrix=matrix)[1].fico == 700


def test_rows_to_score(spark, origination):
    rows = months("00", "00", "00")
    for reason, kept in (("incomplete_performance_window", True), (None, True), ("already_bad_at_t", False)):
        labels = labels_of(spark, rows[2:], split=None, y=None, reason=reason)
        got = build(spark, rows, origination, labels, ["fico"], date(2020, 3, 1), bands={"fico": [("low", None, 699), ("high", 700, None)]})
        assert set(got) == ({3} if kept else set())
        if kept:
            assert (got[3].split, got[3].scoring_row, got[3].y, got[3].fico_band) == ("scoring", True, None, "high")


def test_loans_without_origination_and_empty_tables(spark, origination):
    got = build(spark, months("01"), origination.where("false"), names=["fico", "upb_ratio", "bucket_num"])
    assert (got[1].fico, got[1].upb_ratio, got[1].bucket_num) == (None, None, 1)
    empty = spark.createDataFrame([], PERF)
    data = feature_set.dataset(empty, origination, spark.createDataFrame([], LABEL), 3, date(2020, 1, 1))
    assert data.count() == 0
    checks = {r.check: r.ok for r in feature_set.dataset_checks(data, spark.createDataFrame([], LABEL)).collect()}
    assert checks == {"repeated keys": True, "there are rows to score": False, "rows to score that are bad or unknown": True}


def test_checks_find_what_is_lost_or_repeated(spark, origination):
    rows = months("00", "01", "00", "00")
    labels = labels_of(spark, rows, y=1)
    data = feature_set.dataset(spark.createDataFrame(rows, PERF), origination, labels, 3, date(2020, 4, 1), ["fico"])
    of = lambda df: {r.check: r.ok for r in feature_set.dataset_checks(df, labels).collect()}
    assert all(of(data).values())
    assert not of(data.where("period <> date '2020-02-01'"))["train: rows"]
    assert not of(data.unionByName(data.limit(1)))["repeated keys"]
    assert not of(data.withColumn("bucket_at_t", F.lit("dpd90plus")))["rows to score that are bad or unknown"]


def test_dataset_is_published_by_month(spark, origination, tmp_path):
    rows = months("00", "01", "00")
    data = feature_set.dataset(spark.createDataFrame(rows, PERF), origination, labels_of(spark, rows), 3, date(2020, 3, 1), ["fico"])
    made = publish.publish(data, str(tmp_path / "data"), "dataset", partition_by=["period"])
    assert made["rows"] == 3 and {f["name"].split("/")[0] for f in made["files"]} == {f"period=2020-0{m}-01" for m in (1, 2, 3)}
    assert publish.load(spark, str(tmp_path / "data")).count() == 3
