"""Data contracts: what a source's tables must look like. Unknown keys, types, formats and severities are errors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields
from typing import Any

from pyspark.sql import types as T

DTYPES = {"integer": T.LongType(), "number": T.DoubleType(), "string": T.StringType(), "date": T.DateType(), "yyyymm": T.DateType()}
SEVERITIES = ("error", "warning")
FORMATS = ("csv", "pipe", "parquet")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str = "string"
    nullable: bool = True
    max_missing: float | None = None
    allowed: Sequence[Any] | None = None
    low: float | None = None
    high: float | None = None
    sentinels: Sequence[float] = ()
    pattern: str | None = None
    na_values: Sequence[str] = ()
    severity: str = "error"

    def __post_init__(self):
        if self.dtype not in DTYPES:
            raise ValueError(f"{self.name}: unknown dtype {self.dtype}")
        if self.severity not in SEVERITIES:
            raise ValueError(f"{self.name}: unknown severity {self.severity}")


@dataclass(frozen=True)
class ForeignKey:
    column: str
    references: Sequence[tuple[str, str]]  # (table, column)


@dataclass(frozen=True)
class TableSpec:
    name: str
    files: str = ""
    columns: Sequence[ColumnSpec] = ()
    primary_key: Sequence[str] = ()
    foreign_keys: Sequence[ForeignKey] = ()
    min_rows: int = 0

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, DTYPES[c.dtype]) for c in self.columns])


@dataclass(frozen=True)
class SourceContract:
    name: str
    format: str
    tables: Mapping[str, TableSpec] = field(default_factory=dict)

    def __post_init__(self):
        if self.format not in FORMATS:
            raise ValueError(f"{self.name}: unknown format {self.format}")


def _strict(kind: type, raw: Mapping[str, Any], where: str) -> dict[str, Any]:
    unknown = set(raw) - {f.name for f in fields(kind)}
    if unknown:
        raise ValueError(f"{where}: unknown keys {sorted(unknown)}")
    return dict(raw)


def parse_contract(raw: Mapping[str, Any]) -> SourceContract:
    """A contract from a plain mapping, such as a YAML or JSON file holds."""
    tables = {}
    for name, t in raw.get("tables", {}).items():
        t = _strict(TableSpec, {"name": name, **t}, name)
        t["columns"] = tuple(ColumnSpec(**_strict(ColumnSpec, {"name": c, **(spec or {})}, f"{name}.{c}")) for c, spec in t.get("columns", {}).items())
        t["foreign_keys"] = tuple(ForeignKey(k["column"], tuple(map(tuple, k["references"]))) for k in t.get("foreign_keys", ()))
        known = {c.name for c in t["columns"]}
        if known and not set(t.get("primary_key", ())) <= known:
            raise ValueError(f"{name}: the primary key names unknown columns")
        tables[name] = TableSpec(**t)
    return SourceContract(**_strict(SourceContract, {**raw, "tables": tables}, raw.get("name", "contract")))


def dtype_matches(dtype: str, actual: T.DataType) -> bool:
    """Whether a column's type is one that the contract's type admits."""
    whole = isinstance(actual, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if dtype == "integer":
        return whole
    if dtype == "number":
        return whole or isinstance(actual, (T.FloatType, T.DoubleType, T.DecimalType))
    if dtype == "string":
        return isinstance(actual, T.StringType)
    return isinstance(actual, T.DateType)
