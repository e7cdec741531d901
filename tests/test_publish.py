"""Published tables that survive dead writes, and joins that name what is wrong with them."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from creditloom.operators import joins
from creditloom.sources import contracts, publish, readers


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(i, f"k{i % 3}") for i in range(30)], "id int, k string")


def rows(df):
    return sorted(map(tuple, df.select("id", "k").collect()))


def test_versions_replace_each_other(spark, table, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(publish.PublishError, match="nothing"):
        publish.load(spark, path)
    first = publish.publish(table, path, "make", details={"of": "x"}, partition_by=["k"])
    assert first["rows"] == 30 and first["previous"] is None and all(len(f["sha256"]) == 64 for f in first["files"])
    assert rows(publish.load(spark, path)) == rows(table)
    second = publish.publish(table.where("id < 5"), path, "make")
    assert second["previous"] == first["version"] and rows(publish.load(spark, path)) == rows(table.where("id < 5"))
    third = publish.publish(table.where("id < 4"), path, "make")
    kept = {x for x in os.listdir(path) if x.startswith("v")}
    assert kept == {second["version"], third["version"]}


@pytest.mark.parametrize("dies", ["write_text", "replace", "_digests"])
def test_a_write_that_dies_leaves_the_old_table(spark, table, tmp_path, monkeypatch, dies):
    path = str(tmp_path / "t")
    publish.publish(table, path, "make")

    def die(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(publish, dies, die)
        with pytest.raises(RuntimeError, match="killed"):
            publish.publish(table.where("id < 5"), path, "make")
    assert rows(publish.load(spark, path)) == rows(table)
    publish.publish(table.where("id < 3"), path, "make", keep=0)
    assert len([x for x in os.listdir(path) if x.startswith(("v", "_next"))]) == 1  # what the dead write left is gone


def test_a_failing_job_leaves_the_old_table(spark, table, tmp_path):
    path = str(tmp_path / "t")
    publish.publish(table, path, "make")
    with pytest.raises(Exception, match="boom"):
        publish.publish(table.withColumn("k", F.when(F.col("id") == 7, F.raise_error(F.lit("boom"))).otherwise(F.col("k"))), path, "make")
    assert rows(publish.load(spark, path)) == rows(table)


def test_changed_files_and_manifests_are_found(spark, table, tmp_path):
    path = str(tmp_path / "t")
    made = publish.publish(table.coalesce(1), path, "make")
    folder = f"{path}/{made['version']}"
    text = publish.read_text(spark, f"{folder}/manifest.json")
    publish.write_text(spark, f"{folder}/manifest.json", text.replace('"rows": 30', '"rows": 31'))
    with pytest.raises(publish.PublishError, match="manifest was changed"):
        publish.load(spark, path)
    publish.write_text(spark, f"{folder}/manifest.json", text)
    table.limit(3).coalesce(1).write.parquet(str(tmp_path / "other"))
    extra = next(x for x in os.listdir(tmp_path / "other") if x.endswith(".parquet"))
    os.rename(tmp_path / "other" / extra, f"{folder}/data/{extra}")
    with pytest.raises(publish.PublishError, match="files are not"):
        publish.load(spark, path)
    assert publish.load(spark, path, verify=False).count() == 33


def test_the_chain_of_inputs(spark, table, tmp_path):
    raw, made = str(tmp_path / "raw"), str(tmp_path / "made")
    publish.publish(table, raw, "read")
    publish.publish(publish.load(spark, raw).where("id > 3"), made, "filter", inputs=[raw])
    assert publish.load(spark, made).count() == 26
    publish.publish(table.where("id > 1"), raw, "read")
    with pytest.raises(publish.PublishError, match="another version"):
        publish.load(spark, made)
    with pytest.raises(publish.PublishError, match="not published"):
        publish.publish(table, made, "filter", inputs=[str(tmp_path / "nowhere")])


def contract():
    return contracts.parse_contract({"name": "s", "format": "pipe", "tables": {"p": {"files": "p*.txt.gz", "columns": {"a": {"dtype": "integer"}, "b": {}}}}})


def test_ingest_stops_before_it_reads(spark, tmp_path):
    c = contract()
    with pytest.raises(readers.RawDataError, match="no raw files"):
        readers.ingest(spark, c, str(tmp_path), str(tmp_path / "out"))
    for name, text in (("p2", "3|z\n"), ("p1", "1|x\n2|y\n")):
        with gzip.open(tmp_path / f"{name}.txt.gz", "wt") as f:
            f.write(text)
    assert [f["name"] for f in readers.raw_files(spark, c.tables["p"], str(tmp_path))] == ["p1.txt.gz", "p2.txt.gz"]
    assert readers.ingest(spark, c, str(tmp_path), str(tmp_path / "out")) == {"p": 3}
    made = publish.manifest(spark, str(tmp_path / "out/p"))
    assert [f["name"] for f in made["details"]["raw_files"]] == ["p1.txt.gz", "p2.txt.gz"]
    assert sorted(r.a for r in publish.load(spark, str(tmp_path / "out/p")).collect()) == [1, 2, 3]
    for text, said in (("1|x|y\n", "3 fields"), ("", "empty")):
        with gzip.open(tmp_path / "p3.txt.gz", "wt") as f:
            f.write(text)
        with pytest.raises(readers.RawDataError, match=said):
            readers.ingest(spark, c, str(tmp_path), str(tmp_path / "out"))
    assert publish.load(spark, str(tmp_path / "out/p")).count() == 3


def frames(spark, a, b):
    return {"a": spark.createDataFrame([(k, 1) for k in a], "k int, x int"), "b": spark.createDataFrame([(k, 2) for k in b], "k int, y int")}


@pytest.mark.parametrize(
    ("a", "b", "said"),
    [([1, 2], [1], "1 missing in b"), ([1], [1, 2, 3], "2 missing in a"), ([1, 2, 2], [1, 2], "1 repeated in a"), ([1, 2], [1, 1, 2], "1 repeated in b"), ([1, None], [1], "1 null keys"), ([], [], None), ([2, 1], [1, 2], None)],
)
def test_guarded_joins(spark, a, b, said):
    out, guard = joins.complete_join(frames(spark, a, b), ["k"], "pairing")
    got = sorted(r.k for r in out.collect())
    if said is None:
        assert guard.verify()["rows"] == len(got) == len(a)
    else:
        with pytest.raises(joins.JoinError, match=f"pairing: .*{said}"):
            guard.verify()


def test_three_frames_and_allowed_counts(spark):
    of = {**frames(spark, [1, 2, 3], [1, 2]), "c": spark.createDataFrame([(1, 5), (2, 6), (4, 7)], "k int, z int")}
    out, guard = joins.complete_join(of, ["k"], "three", allowed=["missing_in_a", "missing_in_b", "missing_in_c"])
    assert sorted(map(tuple, out.select("k", "x", "y", "z").collect())) == [(1, 1, 2, 5), (2, 1, 2, 6)]
    assert guard.verify() == {"rows": 2, "null_keys": 0, "missing_in_a": 1, "missing_in_b": 2, "missing_in_c": 1, "repeated_in_a": 0, "repeated_in_b": 0, "repeated_in_c": 0}
    with pytest.raises(ValueError, match="more than one"):
        joins.complete_join({"a": of["a"], "b": of["a"]}, ["k"], "twice")


def test_a_guarded_join_scans_its_frames_once(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    side = spark.read.parquet(str(tmp_path / "t"))
    out, guard = joins.complete_join({"a": side.select("id"), "b": side}, ["id"], "once")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "CollectMetrics" in plan
    assert out.count() == 30 and guard.verify()["rows"] == 30
