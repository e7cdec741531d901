"""Readers and writers by contract: CSV with a header, pipe-delimited text without one, parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.sources import publish
from creditloom.sources.contracts import ColumnSpec, DTYPES, SourceContract, TableSpec


class RawDataError(ValueError):
    """Raw files are missing or are not what the contract says."""


def typed(spec: ColumnSpec, raw: Column) -> Column:
    """Trimmed, null tokens as null, strictly cast: a value that is not of the type fails the run."""
    text = F.trim(raw)
    for token in ("", *spec.na_values):
        text = F.nullif(text, F.lit(token))
    if spec.dtype == "yyyymm":
        return F.to_date(text, "yyyyMM")
    return text.cast(DTYPES[spec.dtype])


def raw_files(spark: SparkSession, spec: TableSpec, folder: str) -> list[dict[str, Any]]:
    """The raw files of a table, by name; a table without any stops the run."""
    found = publish.files(spark, f"{folder}/{spec.files or spec.name}")
    if not found:
        found = publish.files(spark, f"{folder}/{spec.files or spec.name}/*")
    if not found:
        raise RawDataError(f"{spec.name}: no raw files at {folder}/{spec.files or spec.name}")
    return found


def check_field_count(spark: SparkSession, spec: TableSpec, files: Sequence[Mapping[str, Any]], delimiter: str = "|") -> None:
    """Stop where a file is empty or its first line has another number of fields than the contract; only that is read."""
    for file in files:
        line = publish.first_line(spark, file["path"])
        if not line:
            raise RawDataError(f"{spec.name}: {file['name']} is empty")
        fields = len(line.split(delimiter))
        if fields != len(spec.columns):
            raise RawDataError(f"{spec.name}: {file['name']} has {fields} fields, the contract {len(spec.columns)}")


def read_table(spark: SparkSession, contract: SourceContract, name: str, folder: str) -> DataFrame:
    """A contracted table; pipe files also get the name of the file that each row comes from."""
    spec = contract.tables[name]
    path = f"{folder}/{spec.files or name}"
    if contract.format == "parquet":
        return spark.read.parquet(path)
    if contract.format == "csv":
        raw = spark.read.csv(path, header=True, inferSchema=False)
        known = {c.name: c for c in spec.columns}
        return raw.select(*(typed(known[c], F.col(c)).alias(c) if c in known else F.col(c) for c in raw.columns))
    schema = T.StructType([T.StructField(c.name, T.StringType()) for c in spec.columns])
    raw = spark.read.schema(schema).csv(path, sep="|", header=False, quote="")
    return raw.select(*(typed(c, F.col(c.name)).alias(c.name) for c in spec.columns), F.col("_metadata.file_name").alias("source_file"))


def fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and time of change of each file that a path holds."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    return files.withColumn("name", F.element_at(F.split("path", "/"), -1)).drop("path")


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Write parquet (zstd) and return the number of rows that it holds."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path).count()


def ingest(spark: SparkSession, contract: SourceContract, folder: str, out: str) -> Mapping[str, int]:
    """Every table of a source, read by contract and published as parquet with a manifest of its raw files; rows by table.

    All tables' files are looked at before the first is read."""
    raw = {name: raw_files(spark, spec, folder) for name, spec in contract.tables.items()}
    if contract.format not in ("parquet", "csv"):
        for name, spec in contract.tables.items():
            check_field_count(spark, spec, raw[name])
    rows = {}
    for name in contract.tables:
        details = {"raw_files": [{k: f[k] for k in ("name", "bytes", "modified_ms")} for f in raw[name]]}
        rows[name] = publish.publish(read_table(spark, contract, name, folder), f"{out}/{name}", f"ingest {name}", details=details)["rows"]
    return rows
