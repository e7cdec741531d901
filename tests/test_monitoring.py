"""Flows with gaps and late exits, alerts in both directions, stability by hand and against one column at a time."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from creditloom.operators import flows, metrics, stability
from creditloom.operators.stability import Watched

EXIT = "state = 9"


def days(spark, rows):
    return spark.createDataFrame([(k, date(2024, 1, p), s) for k, p, s in rows], "key int, period date, state int")


def test_flows_by_hand(spark):
    p = days(spark, [(1, 1, 0), (1, 2, 0), (1, 3, 9), (2, 1, 0), (2, 3, 0), (3, 2, 9), (4, 1, 9), (4, 2, None), (5, 6, 0), (6, 1, 0)])
    got = {r.period.day: r[1:] for r in flows.flows(p, "key", EXIT).collect()}
    # start, exits from it, exits outside it, entries, end, gone unseen
    assert got[1] == (0, 0, 1, 3, 3, None)
    assert got[2] == (1, 0, 1, 1, 2, 2)  # 2 and 6 do not report; 4 comes back after its exit
    assert got[3] == (1, 1, 0, 1, 1, 1)
    assert got[6] == (0, 0, 0, 1, 1, None)  # no period before it
    assert all(r.ok for r in flows.flow_checks(flows.flows(p, "key", EXIT), p, EXIT).collect())


def test_checks_fail_where_a_flow_is_wrong(spark):
    p = days(spark, [(1, 1, 0), (1, 2, 9), (2, 1, 0), (2, 2, 0)])
    wrong = flows.flows(p, "key", EXIT).withColumns({"end_loans": F.col("end_loans") + 1, "gone_unseen": F.lit(-1), "exits_from_start": F.lit(0)})
    assert not any(r.ok for r in flows.flow_checks(wrong, p, EXIT).collect())


def test_empty_book(spark):
    p = spark.createDataFrame([], "key int, period date, state int")
    assert flows.flows(p, "key", EXIT).isEmpty()


def test_alerts_know_the_worse_direction(spark):
    t = spark.createDataFrame([(1, 0.10, 0.5, 0.0), (2, 0.10, 0.5, 0.0), (3, 0.12, 0.3, 1.0), (4, 0.05, 0.9, None)], "period int, up double, down double, zero double")
    got = {(r.metric, r.period): r for r in flows.trailing_alerts(t, {"up": "higher", "down": "lower", "zero": "higher"}, 2, 0.1, 0.25).collect()}
    assert [got["up", k].light for k in (1, 2, 3, 4)] == [None, "green", "amber", "green"]
    assert [got["down", k].light for k in (1, 2, 3, 4)] == [None, "green", "red", "green"]
    assert [got["zero", k].light for k in (1, 2, 3, 4)] == [None, None, None, None]
    assert got["up", 4].periods_before == 2 and got["up", 1].periods_before == 0 and round(got["up", 4].baseline, 9) == 0.11
    for bad in ({"other": "higher"}, {"up": "worse"}):
        with pytest.raises(ValueError):
            flows.trailing_alerts(t, bad, 2, 0.1, 0.25)


def sample(spark):
    return spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'old' when id % 3 = 1 then 'near' else 'far' end as s", "if(id % 50 = 7, null, cast(id * 7919 % 101 + if(id % 3 = 2, 30, 0) as double)) as x",
        "case when id % 3 = 2 and id % 5 = 0 then 'new' when id % 11 = 0 then null else concat('l', id % 4) end as c", "id % 7 = 0 as b", "if(id % 3 = 1, 'u', if(id % 2 = 0, 'u', 'v')) as g",
    )


def test_one_count_equals_one_column_at_a_time(spark):
    rows = sample(spark).cache()
    watched = [Watched("output", "m", "x"), Watched("feature", "m", "c"), Watched("feature", "m", "b")]
    found = stability.stability(stability.label_counts(rows, "s", "old", ["near", "far"], watched, "g"))
    got = {(r.name, r.segment, r.current): r for r in found.collect()}
    assert len(got) == 6 + 3 and ("x", "v", "near") not in got  # near has no rows of v
    for (name, segment, current), r in got.items():
        part = rows if segment == "all" else rows.where(F.col("g") == segment)
        old, new = part.where("s = 'old'"), part.where(F.col("s") == current)
        want = metrics.psi_numeric(old, new, "x") if name == "x" else metrics.psi_categorical(old, new, name)
        assert r.psi == pytest.approx(want.agg(F.sum("contribution")).first()[0], abs=1e-9), (name, segment, current)
        assert (r.n_reference, r.n_current) == (old.count(), new.count())
        assert r.missing_current == pytest.approx(new.where(F.col(name).isNull()).count() / new.count())
    assert got["x", "all", "far"].light == "red" and got["b", "all", "near"].light == "green"


def test_kinds_of_columns_and_refusals(spark):
    rows = sample(spark)
    assert [stability.is_categorical(rows, c) for c in "xcb"] == [False, True, True]
    with pytest.raises(ValueError, match="kind"):
        Watched("score", "m", "x")
    with pytest.raises(ValueError, match="reference"):
        stability.label_counts(rows, "s", "none", ["far"], [Watched("feature", "m", "c")])


def test_checks_of_stability(spark):
    rows = sample(spark)
    table = stability.stability(stability.label_counts(rows, "s", "old", ["near", "far"], [Watched("output", "m", "x")], "g"))
    ours = {r.segment: r.psi for r in table.where("current = 'far'").collect()}
    published = spark.createDataFrame([("m", "all", ours["all"]), ("m", "u", ours["u"] + 1), ("m", "w", 0.0)], "model string, segment string, psi double")
    got = {r.check: r.ok for r in stability.stability_checks(table, "far", 0.1, published).collect()}
    assert got == {"stable: m x near": True, "published: m all": True, "published: m u": False, "published: m w": False}
    assert not any(r.ok for r in stability.stability_checks(table, "near", 0.1).where("check like '%far'").collect())


def test_rows_are_read_once_for_all_columns_and_segments(spark):
    count = spark.sparkContext.accumulator(0)

    def seen(i):
        count.add(1)
        return ("old" if i % 2 else "near", "g" if i % 3 else "h", float(i % 37), float(i % 11))

    rows = spark.createDataFrame(spark.sparkContext.parallelize(range(2000), 1).map(seen), "s string, g string, x double, z double")
    watched = [Watched("output", "m", "x"), Watched("output", "n", "x"), Watched("feature", "m", "z")]
    found = stability.stability(stability.label_counts(rows, "s", "old", ["near"], watched, "g")).collect()
    assert len(found) == 7 and 2000 <= count.value < 4000  # and a few rows to see that the reference has some
    by = {(r.model, r.name, r.segment): (r.n_reference, r.n_current) for r in found}
    assert by["m", "x", "all"] == by["n", "x", "all"] == by["m", "z", "all"] == (1000, 1000)
    assert by["m", "x", "g"] == (sum(i % 2 == 1 and i % 3 > 0 for i in range(2000)), sum(i % 2 == 0 and i % 3 > 0 for i in range(2000)))
