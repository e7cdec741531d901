"""Joins that must match one to one: violations are counted while the join runs, and named when it is done."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


class JoinError(ValueError):
    """A join did not match as it must."""


@dataclass(frozen=True)
class Guard:
    """What a guarded join has counted. Its rows may be used once :meth:`verify` has passed, after the first action on them."""

    name: str
    observation: Observation
    allowed: frozenset[str]

    def counts(self) -> dict[str, int]:
        return {k: int(v) for k, v in self.observation.get.items()}

    def verify(self) -> dict[str, int]:
        """The counts, or an error that names the join and what is wrong with it."""
        found = self.counts()
        wrong = {k: n for k, n in found.items() if n and k not in self.allowed and k != "rows"}
        if wrong:
            raise JoinError(f"{self.name}: " + ", ".join(f"{n} {k.replace('_', ' ')}" for k, n in sorted(wrong.items())))
        return found


def complete_join(frames: Mapping[str, DataFrame], on: Sequence[str], name: str, allowed: Sequence[str] = ()) -> tuple[DataFrame, Guard]:
    """The inner join of all frames on their keys, and a guard of it.

    The guard counts, for each frame, keys that it lacks (``missing_in_<frame>``) and rows beyond the first of a key
    (``repeated_in_<frame>``), and keys with a null (``null_keys``); ``allowed`` names counts that may be above 0. Counting
    needs no scan or shuffle of its own: the frames' keys are counted in the partitions that the join sorts anyway, and the
    join is a full one whose other rows are dropped once they are counted. Frames must not share columns beside the keys."""
    shared = [c for df in frames.values() for c in df.columns if c not in on]
    if len(shared) != len(set(shared)):
        raise ValueError(f"{name}: columns in more than one frame: {sorted({c for c in shared if shared.count(c) > 1})}")
    marked = [df.withColumn(f"_n_{k}", F.row_number().over(Window.partitionBy(*on).orderBy(F.lit(1)))) for k, df in frames.items()]
    joined = reduce(lambda a, b: a.join(b, list(on), "full"), marked)
    null = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    has = {k: F.col(f"_n_{k}").isNotNull() for k in frames}
    whole = ~null & reduce(Column.__and__, has.values())
    counts = [F.count(F.when(~null & ~here, 1)).alias(f"missing_in_{k}") for k, here in has.items()]
    counts += [F.count(F.when(~null & (F.col(f"_n_{k}") > 1), 1)).alias(f"repeated_in_{k}") for k in frames]
    seen = Observation(name)
    out = joined.observe(seen, F.count(F.when(whole, 1)).alias("rows"), F.count(F.when(null, 1)).alias("null_keys"), *counts)
    return out.where(whole).drop(*(f"_n_{k}" for k in frames)), Guard(name, seen, frozenset(allowed))
