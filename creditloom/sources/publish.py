"""Published tables: a version is written whole beside the old one, then made current by one rename.

A folder holds versions and a file ``_current`` that names one. Readers follow it, so a write that dies leaves the old
table as it was. Each version has a manifest: the files with sizes and SHA-256, rows, what it was made from and by
which step, and a fingerprint over all of it. All access is by Hadoop's file systems, through Spark."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators.rules import fingerprint

CURRENT = "_current"
MANIFEST = "manifest.json"


class PublishError(ValueError):
    """A published table is not there, is not what was published, or does not follow from its inputs any more."""


def _place(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop has them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def files(spark: SparkSession, pattern: str) -> list[dict[str, Any]]:
    """Path, name, bytes and time of change of the files that fit a pattern, by path."""
    fs, place = _place(spark, pattern)
    found = [s for s in (fs.globStatus(place) or []) if not s.isDirectory()]
    return sorted(({"path": s.getPath().toString(), "name": s.getPath().getName(), "bytes": s.getLen(), "modified_ms": s.getModificationTime()} for s in found), key=lambda f: f["path"])


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, unpacked by its ending; nothing more is read."""
    fs, place = _place(spark, path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    stream = fs.open(place)
    try:
        stream = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, place = _place(spark, path)
    out = fs.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or nothing where there is none."""
    fs, place = _place(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another, in one step where the file system has that."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    _, old = _place(spark, source)
    _, new = _place(spark, target)
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), conf).rename(old, new, options)


def _digests(spark: SparkSession, folder: str) -> list[dict[str, Any]]:
    """Name, bytes and SHA-256 of a version's data files, hashed where Spark reads them."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    inside = F.element_at(F.split("path", "/data/"), -1)
    rows = read.select(inside.alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).collect()  # one row a file
    return sorted((r.asDict() for r in rows), key=lambda r: r["name"])


def manifest(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """The manifest of the current version, or nothing; an error if it was changed."""
    version = read_text(spark, f"{path}/{CURRENT}")
    if version is None:
        return None
    text = read_text(spark, f"{path}/{version}/{MANIFEST}")
    if text is None:
        raise PublishError(f"{path}: version {version} has no manifest")
    found = json.loads(text)
    if fingerprint({k: v for k, v in found.items() if k != "fingerprint"}) != found["fingerprint"]:
        raise PublishError(f"{path}: the manifest was changed")
    return found


def publish(df: DataFrame, path: str, step: str, inputs: Sequence[str] = (), details: Mapping[str, Any] | None = None, partition_by: Sequence[str] = (), keep: int = 1) -> dict[str, Any]:
    """Write ``df`` as the new current version of ``path`` and return its manifest.

    ``inputs`` are published tables that it was made from: their fingerprints are kept, which chains the manifests.
    ``keep`` older versions stay."""
    spark = df.sparkSession
    made_from = {}
    for other in inputs:
        found = manifest(spark, other)
        if found is None:
            raise PublishError(f"{step}: input {other} is not published")
        made_from[other] = found["fingerprint"]
    before = read_text(spark, f"{path}/{CURRENT}")
    version = f"v{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{version}/data")
    data = spark.read.schema(df.schema).parquet(f"{path}/{version}/data")
    body = {"step": step, "version": version, "previous": before, "rows": data.count(), "schema": df.schema.simpleString(), "files": _digests(spark, f"{path}/{version}/data"), "inputs": made_from, "details": dict(details or {})}
    body = json.loads(json.dumps(body, default=str))
    body["fingerprint"] = fingerprint(body)
    write_text(spark, f"{path}/{version}/{MANIFEST}", json.dumps(body, sort_keys=True, indent=1))
    write_text(spark, f"{path}/_next-{version}", version)
    replace(spark, f"{path}/_next-{version}", f"{path}/{CURRENT}")
    _forget(spark, path, {version, *_line(spark, path, before, keep)})
    return body


def _line(spark: SparkSession, path: str, version: str | None, count: int) -> list[str]:
    """A version and those before it, ``count`` in all."""
    out = []
    while version is not None and len(out) < count:
        out.append(version)
        text = read_text(spark, f"{path}/{version}/{MANIFEST}")
        version = json.loads(text)["previous"] if text else None
    return out


def _forget(spark: SparkSession, path: str, kept: set[str]) -> None:
    """Drop other versions, among them what dead writes have left."""
    fs, place = _place(spark, path)
    for status in fs.listStatus(place):
        name = status.getPath().getName()
        if (status.isDirectory() and name.startswith("v") and name not in kept) or name.startswith("_next-"):
            fs.delete(status.getPath(), True)


def load(spark: SparkSession, path: str, verify: bool = True) -> DataFrame:
    """The current version of a published table; with ``verify`` its files must be those of the manifest, byte by byte, and
    its inputs must still be what it was made from."""
    found = manifest(spark, path)
    if found is None:
        raise PublishError(f"{path}: nothing is published")
    data = f"{path}/{found['version']}/data"
    if verify:
        if _digests(spark, data) != found["files"]:
            raise PublishError(f"{path}: the files are not those of the manifest")
        for other, was in found["inputs"].items():
            now = manifest(spark, other)
            if now is None or now["fingerprint"] != was:
                raise PublishError(f"{path}: made from another version of {other}")
    return spark.read.parquet(data)
