"""Exact top-k by inner product with the threshold algorithm over sorted per-dimension lists.

Each block of vectors keeps, for every dimension, its rows in order of that component. A query walks its lists from
the end that its own component favours, deeper by a factor each time, scores every row it meets for the first time,
and stops when no unseen row can beat the k-th score: the bound is the inner product of the query with the values
at which its lists stand.

Components are quantised to floor(scale * x). Vectors that are null, empty, or hold a null or non-finite component
take no part, on either side; vectors are compared with those of their own length; a query is not its own candidate,
nor is any row with its id. With fewer candidates than k all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm.spark_util import table
from creditloom.llm.vector_grid import best, search, usable

BLOCK_ROWS = 4096
QUERY_ROWS = 1024
FIRST_DEPTH = 16


def threshold_search(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best k rows of one block for each query (whole numbers, exact): query ids, row ids, scores."""
    n, dims = rows.shape
    lists = np.argsort(rows, axis=0, kind="stable")  # ascending; column d is the list of dimension d
    values = np.take_along_axis(rows, lists, axis=0)
    # doubles hold every partial sum exactly below 2**53, and multiply faster
    peak = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * dims
    kind = np.float64 if peak < 2**53 else np.int64
    rows, asked = rows.astype(kind), queries.astype(kind)
    out_q, out_v, out_s = [], [], []
    for q, own in zip(asked, query_ids, strict=True):
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        unseen = ids != own
        got = np.flatnonzero(~unseen)[:0]
        score = np.zeros(0, kind)
        at, depth = 0, FIRST_DEPTH
        while True:
            to = min(n, at + depth)
            fresh = np.zeros(n, bool)
            fresh[lists[n - to : n - at, up]] = True
            fresh[lists[at:to, down]] = True
            if not len(up) and not len(down):  # the zero query: every row scores 0
                fresh[:] = True
                to = n
            new = np.flatnonzero(fresh & unseen)
            unseen[new] = False
            got, score = np.concatenate([got, new]), np.concatenate([score, rows[new] @ q])
            if to == n or not unseen.any():
                break
            keep = best(ids[got], score, k)
            got, score = got[keep], score[keep]
            bound = q[up] @ values[n - to, up] + q[down] @ values[to - 1, down]
            if len(score) == k and score[-1] > bound:
                break
            at, depth = to, depth * 2
        keep = best(ids[got], score, k)
        out_q.append(np.full(len(keep), own))
        out_v.append(ids[got[keep]])
        out_s.append(score[keep].astype(np.int64))
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_s)


def _find(ids, rows, query_ids, queries, k):
    return threshold_search(ids, rows.astype(np.int64), query_ids, queries.astype(np.int64), k)


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` with the highest inner product, for each query."""
    whole = F.transform("vec", lambda x: F.floor(x * scale).cast("double"))
    sides = [usable(df, id_col, vec_col).select("id", whole.alias("vec")) for df in (vectors, queries)]
    return search(*sides, k, _find, "long", BLOCK_ROWS, QUERY_ROWS)


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk(vectors, vectors.where("vec_id % 50 = 0"), 5)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
