"""A stated set of query vectors against all vectors, block by block.

Rows are dealt into blocks by a hash of their ids, queries into chunks; each (block, chunk) is one group of bounded
size, whatever the table holds. A block's index is built where the block is searched.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from creditloom.llm.spark_util import ship


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows whose vector is not null, not empty, and finite in every component; components as double."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & fine)


def matrices(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of the vectors of each length in a group."""
    ids = table.column("id").combine_chunks().to_numpy(zero_copy_only=False)
    vecs = table.column("vec").combine_chunks()
    length = np.diff(vecs.offsets.to_numpy())
    flat = vecs.flatten().to_numpy(zero_copy_only=False)
    begin = vecs.offsets.to_numpy()[:-1] - vecs.offsets.to_numpy()[0]
    for d in np.unique(length):
        at = np.flatnonzero(length == d)
        yield ids[at], flat[(begin[at][:, None] + np.arange(d)[None, :])]


def search(vectors: DataFrame, queries: DataFrame, k: int, find: Callable, score_type: str, block_rows: int, query_rows: int) -> DataFrame:
    """The ``k`` best (query_id, rank, vec_id, score) of each query over all blocks, ties to the smaller vec_id.

    ``find(ids, rows, query_ids, queries, k)`` returns arrays (query_id, vec_id, score) with the best k of one block.
    Vectors are compared with queries of their own length.
    """
    ship(vectors.sparkSession)
    blocks = max(1, math.ceil(vectors.count() / block_rows))
    chunks = max(1, math.ceil(queries.count() / query_rows))
    left = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = queries.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit("chunk")), F.lit(chunks)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    kind = pa.int64() if score_type == "long" else pa.float64()

    def one(block: pa.Table, asked: pa.Table) -> pa.Table:
        by_length = {q.shape[1]: (ids, q) for ids, q in matrices(asked)}
        parts = [find(ids, rows, *by_length[rows.shape[1]], k) for ids, rows in matrices(block) if rows.shape[1] in by_length]
        cols = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [[], [], []]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], kind)], names=["query_id", "vec_id", "score"])

    found = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(one, f"query_id long, vec_id long, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id, best first."""
    if len(score) > 8 * k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= kth)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]
