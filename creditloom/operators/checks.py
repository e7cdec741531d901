"""Contract rules and reconciliation checks.

All rules of a table are counted in one scan; only keys need a shuffle. A check row is (check, claimed, recounted,
source, ok)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.sources.contracts import ColumnSpec, TableSpec, dtype_matches

CHECK_SCHEMA = "check string, claimed double, recounted double, source string, ok boolean"
RULE_SCHEMA = "table string, column string, rule string, violations long, rows long, severity string, ok boolean"


def column_rules(spec: ColumnSpec) -> dict[str, Column]:
    """The condition of a violation of each rule of a column."""
    c = F.col(spec.name)
    out: dict[str, Column] = {}
    if not spec.nullable:
        out["not_null"] = c.isNull()
    if spec.allowed is not None:
        out["allowed"] = c.isNotNull() & ~c.isin(list(spec.allowed))
    if spec.low is not None or spec.high is not None:
        bad = F.lit(False)
        if spec.low is not None:
            bad = bad | (c < spec.low)
        if spec.high is not None:
            bad = bad | (c > spec.high)
        out["range"] = c.isNotNull() & bad & ~(c.isin(list(spec.sentinels)) if spec.sentinels else F.lit(False))
    if spec.pattern is not None:
        out["pattern"] = c.isNotNull() & ~c.cast("string").rlike(f"^(?:{spec.pattern})$")
    return out


def check_table(frame: DataFrame, spec: TableSpec) -> DataFrame:
    """One row a rule: types by the schema, column rules and size in one aggregate, duplicate keys in another."""
    spark = frame.sparkSession
    present = [c for c in spec.columns if c.name in frame.columns]
    rules = [(c, rule, bad) for c in present for rule, bad in column_rules(c).items()]
    found = frame.agg(F.count("*").alias("n"), *(F.count(F.when(bad, 1)).alias(f"v{i}") for i, (_, _, bad) in enumerate(rules)), *(F.count(F.when(F.col(c.name).isNull(), 1)).alias(f"m{i}") for i, c in enumerate(present))).first()
    n = found["n"]
    rows = [(spec.name, None, "min_rows", int(n < spec.min_rows), n, "error", n >= spec.min_rows)]
    for c in spec.columns:
        if c.name not in frame.columns:
            rows.append((spec.name, c.name, "present", 1, n, "error", False))
        else:
            ok = dtype_matches(c.dtype, frame.schema[c.name].dataType)
            rows.append((spec.name, c.name, "dtype", int(not ok), n, "error", ok))
    rows += [(spec.name, c.name, rule, found[f"v{i}"], n, c.severity, found[f"v{i}"] == 0) for i, (c, rule, _) in enumerate(rules)]
    rows += [(spec.name, c.name, "max_missing", found[f"m{i}"], n, c.severity, found[f"m{i}"] <= c.max_missing * n) for i, c in enumerate(present) if c.max_missing is not None]
    if spec.primary_key:
        dup = duplicate_keys(frame, spec.primary_key).count()
        rows.append((spec.name, ",".join(spec.primary_key), "primary_key", dup, n, "error", dup == 0))
    return spark.createDataFrame(rows, RULE_SCHEMA)


def duplicate_keys(frame: DataFrame, key: Iterable[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return frame.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")


def orphans(child: DataFrame, key: str, *parents: tuple[DataFrame, str]) -> DataFrame:
    """Rows whose key, where it has one, is in none of the parents; null keys of parents match nothing."""
    known = None
    for frame, column in parents:
        keys = frame.select(F.col(column).alias("_key"))
        known = keys if known is None else known.union(keys)
    return child.where(F.col(key).isNotNull()).join(known.distinct(), F.col(key) == F.col("_key"), "left_anti")


def check_row(check: str, claimed: Column, recounted: Column, source: str, tolerance: float = 0.0) -> Column:
    """A struct of one check; a null is never within the tolerance."""
    ok = F.coalesce(F.abs(claimed.cast("double") - recounted.cast("double")) <= tolerance, F.lit(False))
    return F.struct(F.lit(check).alias("check"), claimed.cast("double").alias("claimed"), recounted.cast("double").alias("recounted"), F.lit(source).alias("source"), ok.alias("ok"))


def check_rows(one_row: DataFrame, *checks: Column) -> DataFrame:
    return one_row.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def stop_if_failed(checks: DataFrame, step: str) -> None:
    failed = [r.check for r in checks.where(~F.coalesce("ok", F.lit(False))).limit(20).collect()]
    if failed:
        raise ValueError(f"{step}: failed checks: {', '.join(failed)}")


def empty_checks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CHECK_SCHEMA)
