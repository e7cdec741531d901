"""History tables reduced to one row an entity, then joined to the entities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aggregate_history(history: DataFrame, key: str, aggs: Mapping[str, Column], row_filter: str | None = None) -> DataFrame:
    """One row a key; the filter is an expression of the configuration."""
    rows = history.where(F.expr(row_filter)) if row_filter else history
    return rows.groupBy(key).agg(*(c.alias(n) for n, c in aggs.items()))


def join_histories(entities: DataFrame, key: str, histories: Mapping[str, DataFrame]) -> DataFrame:
    """Left joins of reduced histories; absence is a flag has_<name>, and null, never zero."""
    marked = [h.withColumn(f"has_{name}", F.lit(1)) for name, h in histories.items()]
    out = reduce(lambda a, b: a.join(b, key, "left"), marked, entities)
    return out.withColumns({f"has_{name}": F.coalesce(f"has_{name}", F.lit(0)) for name in histories})


def coverage(features: DataFrame, flags: Sequence[str], by: str) -> DataFrame:
    """Share of rows with each history."""
    return features.groupBy(by).agg(F.count("*").alias("rows"), *(F.avg(f).alias(f"share_{f}") for f in flags))


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def missing_shares(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, share) of nulls of many columns in one scan."""
    one = frame.agg(*(F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns))
    return one.unpivot([], list(columns), "column", "share")
