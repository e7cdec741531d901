"""Approximate nearest neighbours by stable projections: a kd-tree on few dimensions and a chi-square stopping test.

Vectors are scaled to unit length, where the nearest by cosine is the nearest by distance, and projected on a few
Gaussian directions. For a pair at distance r the squared projected distance over r**2 follows a chi-square law.
A query takes projected neighbours from the kd-tree in order of their projected distance and verifies each on the
original vectors. It stops when a point that beats the k-th verified distance would, with the given confidence,
have come already: when (next projected distance / k-th distance)**2 passes the quantile of the law.

Every row is indexed. Vectors that are null, empty, zero, or hold a null or non-finite component take no part, on
either side; a query is not its own candidate. With fewer candidates than k all are returned.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm.spark_util import table
from creditloom.llm.vector_grid import best, search, usable

BLOCK_ROWS = 8192
QUERY_ROWS = 1024
PROJECTED = 8
LEAF = 32
CONFIDENCE = 0.98
SEED = 7


def chi2_quantile(p: float, dims: int) -> float:
    """Quantile of the chi-square law with an even number of degrees of freedom, by bisection of its closed form."""
    if dims % 2:
        raise ValueError("an even number of projections is needed")

    def cdf(x: float) -> float:
        term = total = math.exp(-x / 2)
        for i in range(1, dims // 2):
            term *= x / 2 / i
            total += term
        return 1 - total

    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


class KdTree:
    """Points split at the median of the widest dimension, down to leaves; a leaf keeps its bounding box."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        todo, leaves = [np.arange(len(points))], []
        while todo:
            at = todo.pop()
            box = points[at]
            if len(at) <= leaf:
                leaves.append(at)
                continue
            d = int(np.argmax(box.max(axis=0) - box.min(axis=0)))
            half = len(at) // 2
            order = np.argpartition(box[:, d], half)
            todo += [at[order[:half]], at[order[half:]]]
        self.points = points
        self.leaves = leaves
        self.low = np.array([points[x].min(axis=0) for x in leaves])
        self.high = np.array([points[x].max(axis=0) for x in leaves])

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """Squared distance from the query to each leaf's box."""
        gap = np.maximum(np.maximum(self.low - query, query - self.high), 0)
        return (gap * gap).sum(axis=1)


def srs_search(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, dims: int = PROJECTED, confidence: float = CONFIDENCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest k rows of one block found for each query: query ids, row ids, cosines."""
    norm, qnorm = np.sqrt(np.einsum("ij,ij->i", rows, rows)), np.sqrt(np.einsum("ij,ij->i", queries, queries))
    ids, rows, norm = ids[norm > 0], rows[norm > 0], norm[norm > 0]
    query_ids, queries, qnorm = query_ids[qnorm > 0], queries[qnorm > 0], qnorm[qnorm > 0]
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if not len(ids) or not len(query_ids):
        return empty
    directions = np.random.default_rng(SEED).standard_normal((rows.shape[1], dims))
    tree = KdTree((rows / norm[:, None]) @ directions)
    asked = (queries / qnorm[:, None]) @ directions
    limit = chi2_quantile(confidence, dims)
    out = []
    for own, q, length, p in zip(query_ids, queries, qnorm, asked, strict=True):
        bound = tree.bounds(p)
        order = np.argsort(bound, kind="stable")
        step, at = 4, 0
        wait, wait_d = np.zeros(0, np.int64), np.zeros(0)  # met, not yet next in line
        got, score = np.zeros(0, np.int64), np.zeros(0)
        while True:
            to = min(len(order), at + step)
            new = np.concatenate([tree.leaves[x] for x in order[at:to]]) if to > at else wait[:0]
            gap = tree.points[new] - p
            wait, wait_d = np.concatenate([wait, new]), np.concatenate([wait_d, (gap * gap).sum(axis=1)])
            frontier = bound[order[to]] if to < len(order) else np.inf  # all nearer ones have been met
            due = wait_d <= frontier
            ready = wait[due]
            ready = ready[ids[ready] != own]
            wait, wait_d = wait[~due], wait_d[~due]
            got = np.concatenate([got, ready])
            score = np.concatenate([score, np.einsum("ij,j->i", rows[ready], q) / (norm[ready] * length)])
            keep = best(ids[got], score, k)
            got, score = got[keep], score[keep]
            if to == len(order):
                break
            if len(got) == k and frontier > limit * max(0.0, 2 - 2 * score[-1]) + 1e-12:
                break
            at, step = to, step * 2
        out.append((np.full(len(got), own), ids[got], score))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): about the k rows of ``vectors`` with the largest cosine, for each query."""
    return search(usable(vectors, id_col, vec_col), usable(queries, id_col, vec_col), k, srs_search, "double", BLOCK_ROWS, QUERY_ROWS)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"), 5)
