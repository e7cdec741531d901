"""Running sums, places, ranks and quantiles along a total order, without a window over all rows.

Rows are dealt into ranges of the order. A range's own running sum is a window inside the range; what lies before it is
the sum of the totals of the ranges before, a table of one row a range. So no task holds more than a range, however
large a group is, and the only window without partition keys runs over the ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.exprs import ratio
from creditloom.session import saved


def in_ranges(rows: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """``rows`` with the number of their range as ``_part``; equal keys share one. The rows are checkpointed, since Spark
    draws the borders of the ranges anew each time it plans them."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return saved(rows.repartitionByRange(parts, *by, *order).withColumn("_part", F.spark_partition_id()))


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of keys, nulls included, where ``right`` has them with an underscore ahead."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


def running(rows: DataFrame, sums: Mapping[str, str | Column], order: Sequence[str | Column], by: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """``rows`` with, for each name, the sum of its column over the group's rows up to this one, and name_all, the sum over
    the whole group. Rows that are equal in ``order`` come one after the other in no set order."""
    ranged = in_ranges(rows.withColumns({f"_{n}": F.col(c) if isinstance(c, str) else c for n, c in sums.items()}), order, by, parts)
    keys = [*by, "_part"]
    totals = ranged.groupBy(*keys).agg(*(F.sum(f"_{n}").alias(n) for n in sums))
    ahead = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(*(F.col(k).alias(f"_{k}") for k in keys), *(F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(f"_before_{n}") for n in sums), *(F.sum(n).over(whole).alias(f"{n}_all") for n in sums))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({n: F.sum(f"_{n}").over(inside) for n in sums})
    out = local.join(offsets, same(local, offsets, keys))
    kept = [c for c in rows.columns if c not in sums]
    return out.select(*(local[c] for c in kept), *((local[n] + F.col(f"_before_{n}")).alias(n) for n in sums), *(f"{n}_all" for n in sums))


def numbered(rows: DataFrame, order: Sequence[str | Column], by: Sequence[str] = ()) -> DataFrame:
    """``rows`` with their place in the group, from 1, and the group's size (``place``, ``place_all``)."""
    return running(rows, {"place": F.lit(1)}, order, by)


def value_ranks(rows: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, value, n, code, average_rank): each distinct value's rows, its ordinal code from 0, and the rank that its rows
    share, the mean of their places. Nulls are values, before all others."""
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("n"))
    ran = running(counts, {"upto": "n", "code": F.lit(1)}, [value], by)
    return ran.select(*by, value, "n", (F.col("code") - 1).alias("code"), (F.col("upto") - (F.col("n") - 1) / 2).alias("average_rank"))


def with_average_ranks(rows: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """``rows`` with the average rank of each column of ``values`` under the name it maps to."""
    for value, name in values.items():
        ranks = value_ranks(rows, value).select(F.col(value).alias(f"_{value}"), F.col("average_rank").alias(name))
        rows = rows.join(ranks, same(rows, ranks, [value])).drop(f"_{value}")
    return rows


def quantiles(rows: DataFrame, value: str, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by, q, value): the linear quantiles of the values that are not null, exact."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    return quantiles_of_counts(counts, value, qs, by)


def quantiles_of_counts(counts: DataFrame, value: str, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """:func:`quantiles` from counts (by, _v, _n); a value may have several rows."""
    ran = running(counts, {"upto": "_n"}, ["_v"], by)
    place = lambda q: q * (F.col("upto_all") - 1)
    holds = lambda at: (at >= F.col("upto") - F.col("_n")) & (at < F.col("upto"))
    each = F.array(*(F.lit(float(q)) for q in qs))
    met = ran.withColumn("q", F.explode(F.filter(each, lambda q: holds(F.floor(place(q))) | holds(F.ceil(place(q))))))
    at = place(F.col("q"))
    ends = met.groupBy(*by, "q").agg(F.max(at).alias("_at"), F.max(F.when(holds(F.floor(at)), F.col("_v"))).alias("_low"), F.max(F.when(holds(F.ceil(at)), F.col("_v"))).alias("_high"))
    share = F.col("_at") - F.floor("_at")
    return ends.select(*by, "q", F.when(share == 0, F.col("_low")).otherwise((1 - share) * F.col("_low") + share * F.col("_high")).cast("double").alias(value))


def spearman(rows: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Rank correlation, ties sharing their mean rank, over rows that have both values; from counts of pairs of values."""
    pairs = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*by, a, b).agg(F.count("*").alias("_n"))
    out = pairs
    for value, name in ((a, "__rank_a"), (b, "__rank_b")):
        counts = pairs.groupBy(*by, F.col(value).alias("_v")).agg(F.sum("_n").alias("_c"))
        ranks = running(counts, {"upto": "_c"}, ["_v"], by).select(*(F.col(k).alias(f"_{k}") for k in by), F.col("_v").alias(f"_{value}"), (F.col("upto") - (F.col("_c") - 1) / 2).alias(name))
        out = out.join(ranks, same(out, ranks, [*by, value])).drop(*(f"_{k}" for k in by), f"_{value}")
    n, x, y = F.col("_n"), F.col("__rank_a"), F.col("__rank_b")
    # ranks about their mean keep the sums small
    total = out.groupBy(*by).agg(F.sum("_n").alias("_rows"))
    total = total.select(*(F.col(k).alias(f"_{k}") for k in by), ((F.col("_rows") + 1) / 2).alias("_mid"))
    out = out.join(total, same(out, total, by)) if by else out.join(F.broadcast(total))  # one row without groups
    dx, dy = x - F.col("_mid"), y - F.col("_mid")
    return out.groupBy(*by).agg(ratio(F.sum(n * dx * dy), F.sqrt(F.sum(n * dx * dx) * F.sum(n * dy * dy))).alias("spearman"))
