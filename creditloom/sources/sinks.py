"""Outputs: small tables as single CSV files, metrics as JSON, readers of both."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from creditloom.sources import publish


def write_outputs(tables: Mapping[str, DataFrame], metrics: Mapping[str, Any], folder: str) -> list[str]:
    """Every table as one CSV part under its name (they are reports, of a few rows), and the metrics beside them."""
    for name, df in tables.items():
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
    spark = SparkSession.active()
    publish.write_text(spark, f"{folder}/metrics.json", json.dumps(metrics, sort_keys=True, default=str, indent=1))
    return [*tables, "metrics.json"]


def read_outputs(spark: SparkSession, folder: str, *names: str) -> tuple[dict[str, DataFrame], Any]:
    tables = {n: spark.read.csv(f"{folder}/{n}", header=True, inferSchema=True) for n in names}
    return tables, json.loads(publish.read_text(spark, f"{folder}/metrics.json"))


def failures_first(rules: DataFrame) -> DataFrame:
    """Rule results with failures on top, errors before warnings."""
    return rules.orderBy("ok", "severity", "table", "column", "rule")
