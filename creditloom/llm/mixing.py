"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Each source's rows, in a hashed order, are cut into blocks. A source of weight w (a share of all slots) gives its
block k the release time floor(k / w) and the deadline ceil((k + 1) / w); at every slot the released block with the
earliest deadline goes next. On one line of slots this meets every deadline, so at any point each source has been
given its share to within less than one block. Weights are taken as whole numbers of 2**-40, and times are computed in
whole numbers, so nothing drifts however long the table is.

Where a source runs out, time passes faster for the others: a slot stands at the time at which the ideal, perfectly
divided mixture has given out as many blocks, which keeps the ratio of the remaining weights.

Blocks are scheduled on the driver, which sees counts by source only: a block has ``block_rows`` rows, or more where that
would make more than MAX_BLOCKS blocks, so the schedule of all blocks has a bounded size and is broadcast. Rows find
their place by arithmetic: no task needs to see a whole source. There may be MAX_SOURCES sources; a table of more is
refused with an error, since their schedule would not be bounded.

No row is dropped or repeated: the mixture is an order. A null source is a source of its own; sources without a given
weight share the least given one by their numbers of rows. Rows with a null id are spread by their other columns. Rows
that repeat an id take neighbouring places, by their other columns; rows alike in every column are interchangeable.
Texts are not looked at but for that. Columns named block, slot or position are replaced. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.llm.spark_util import table

BLOCK_ROWS = 16
MAX_BLOCKS = 1 << 18
MAX_SOURCES = 10_000
ROWS_A_BUCKET = 40_000
EXPONENT = 0.5
_UNIT = 1 << 40


def windows(weights: list[int], blocks: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Source, number, release and deadline of all blocks.

    Block k of source i is released at floor(T(k / w)) and due by ceil(T((k + 1) / w)), where T(v) is the number of
    blocks that the ideal mixture has given out at time v. Source j is then at its v * w_j-th block, or has run out."""
    w, n = np.array(weights, np.int64), np.array(blocks, np.int64)
    out = []
    for i in range(len(w)):
        k = np.arange(n[i] + 1)
        gone = -(-n * w[i] // w)  # from this k on, source j has run out
        order = np.argsort(gone, kind="stable")
        ended = np.searchsorted(gone[order], k, side="right")
        given = np.concatenate([[0], np.cumsum(n[order])])[ended]
        active = w.sum() - np.concatenate([[0], np.cumsum(w[order])])[ended]
        times = given * w[i] + k * active  # T, times w_i
        out.append((np.full(n[i], i), k[:-1], times[:-1] // w[i], -(-times[1:] // w[i])))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def schedule(weights: list[int], blocks: list[int]) -> list[list[int]]:
    """The slot of each block, by source; ``weights`` are whole numbers, below 2**41 in sum."""
    source, number, release, due = windows(weights, blocks)
    order = np.lexsort((number, source, release))
    jobs = list(zip(release[order].tolist(), due[order].tolist(), source[order].tolist(), strict=True))
    places: list[list[int]] = [[] for _ in blocks]
    ready: list[tuple[int, int]] = []
    at = 0
    for slot in range(len(jobs)):
        while at < len(jobs) and jobs[at][0] <= slot:
            heapq.heappush(ready, jobs[at][1:])
            at += 1
        deadline, i = heapq.heappop(ready)
        if slot >= deadline:
            raise AssertionError("a deadline was missed")
        places[i].append(slot)  # a source's blocks have rising deadlines
    return places


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", source_col: str = "source", seed: int = 0) -> DataFrame:
    """``docs`` with the columns block (its number in the source), slot (of the block) and position (of the row).

    ``weights`` are the targets by source; without them a source weighs as its number of rows to the power EXPONENT.
    Ordering by position gives the mixture."""
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("block", "slot", "position")]
    rows = docs.select(*kept)
    found = rows.groupBy(F.col(source_col).cast("string").alias("s")).agg(F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if not found:
        return rows.withColumns({c: F.lit(None).cast("long") for c in ("block", "slot", "position")})
    found.sort(key=lambda r: (-r.n, r.s is not None, r.s or ""))
    counts, total = [r.n for r in found], sum(r.n for r in found)
    if weights is None:
        wanted = [n**EXPONENT for n in counts]
    else:
        others = sum(r.n for r in found if r.s not in weights)
        wanted = [weights[r.s] if r.s in weights else min(weights.values(), default=1.0) * r.n / others for r in found]
    size = max(block_rows, -(-total // MAX_BLOCKS))
    whole = [max(1, round(w / sum(wanted) * _UNIT)) for w in wanted]
    slots = schedule(whole, [-(-n // size) for n in counts])

    # both tables are bounded: by MAX_SOURCES, and by MAX_BLOCKS and one block more for each source
    known = spark.createDataFrame([(r.s, i) for i, r in enumerate(found)], "_s string, _i int")
    places = spark.createDataFrame(list(enumerate(slots)), "_i int, _slots array<int>")
    tagged = rows.join(F.broadcast(known), F.col(source_col).cast("string").eqNullSafe(F.col("_s"))).drop("_s")
    bits = max(8, math.ceil(math.log2(total / ROWS_A_BUCKET)))
    rest = F.xxhash64(*(c for c, t in rows.dtypes if "map<" not in t and t != "variant"))
    tagged = tagged.withColumn("_h", F.xxhash64(F.lit(seed), F.coalesce(F.xxhash64(F.when(F.col(id_col).isNotNull(), F.col(id_col))), F.lit(0).cast("long")), F.when(F.col(id_col).isNull(), rest)))
    tagged = tagged.withColumn("_b", F.shiftrightunsigned("_h", 64 - bits))
    before = F.sum("_n").over(Window.partitionBy("_i").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = tagged.groupBy("_i", "_b").agg(F.count("*").alias("_n")).select("_i", "_b", F.coalesce(before, F.lit(0)).alias("_offset"))
    # within a bucket, whose hashes share their first bits, rows are numbered in the order of the rest
    numbered = tagged.withColumn("_r", F.row_number().over(Window.partitionBy("_i", "_b").orderBy("_h", id_col, rest)))
    numbered = numbered.join(offsets, ["_i", "_b"]).withColumn("_p", F.col("_r") + F.col("_offset") - 1)
    placed = numbered.withColumn("block", F.floor(F.col("_p") / size).cast("long")).join(F.broadcast(places), "_i")
    placed = placed.withColumn("slot", F.get("_slots", F.col("block").cast("int")).cast("long"))
    return placed.withColumn("position", F.col("slot") * size + F.col("_p") % size).select(*kept, "block", "slot", "position")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs).select("doc_id", "source", "block", "slot", "position")
