"""Nearest neighbours by vantage-point trees, one per shard of the vectors.

A tree node picks a vantage point and parts its vectors at the median distance to
it; each part keeps the range of its distances. For a query at distance d from
the vantage point no vector of a part with range [lo, hi] is nearer than
max(lo - d, d - hi), by the triangle inequality, so a part whose bound passes the
k-th best distance found so far times ``factor`` is left out. With factor 1 the
search is exact; smaller factors leave out more.

In a leaf one matrix product gives all squared distances up to rounding. Only pairs
that may still be among the k nearest are measured component by component, so an
exact distance is computed for few pairs even where the tree leaves out nothing.

Queries run in blocks against shards: both are hash parts of bounded size, joined
on (shard, block). All queries of a block walk a tree together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD = 4096  # vectors of a tree
BLOCK = 4096  # queries that walk together
LEAF = 512  # vectors that meet their queries in one matrix product
TOGETHER = 512  # queries of one product
LEAST_SHARDS = 32  # a small table is still spread over as many tasks, of 256 vectors or more
SLACK = 1e-9  # relative room for rounding in the bounds
TINY = 1e-300  # room for what underflows in a product


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, component by component in order, in double precision."""
    total = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        total += (a[:, d, None] - b[None, :, d]) ** 2
    return np.sqrt(total)


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row to the row beside it, summed as in ``distances``."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += (a[:, d] - b[:, d]) ** 2
    return np.sqrt(total)


@dataclass
class Node:
    rows: np.ndarray | None = None  # of a leaf
    vantage: np.ndarray | None = None
    parts: tuple = ()  # (lo, hi, node) of each part


def build(vectors: np.ndarray, rows: np.ndarray) -> Node:
    """Tree over some rows; vectors at one distance from a vantage point may all be equal, hence a leaf."""
    if len(rows) <= LEAF:
        return Node(rows=rows)
    vantage = vectors[rows[len(rows) // 2]]
    d = distances(vantage[None, :], vectors[rows])[0]
    order = np.argsort(d, kind="stable")
    d, rows = d[order], rows[order]
    if d[0] == d[-1]:
        return Node(rows=rows)
    cut = max(1, int(np.searchsorted(d, d[len(d) // 2], "left")))
    return Node(vantage=vantage, parts=tuple(
        (x[0], x[-1], build(vectors, r)) for x, r in ((d[:cut], rows[:cut]), (d[cut:], rows[cut:]))))


class Search:
    """k nearest of a block of queries in one tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.ids, self.vectors, self.query_ids, self.queries = ids, vectors, query_ids, queries
        self.factor = factor
        self.best = np.full((len(queries), k), np.inf)
        self.best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)

    def walk(self, node: Node, active: np.ndarray) -> None:
        if not len(active):
            return
        if node.rows is not None:
            for k in range(0, len(node.rows), 1024):
                self._leaf(node.rows[k:k + 1024], active)
            return
        d = distances(self.queries[active], node.vantage[None, :])[:, 0]
        with np.errstate(invalid="ignore"):  # infinite distances bound nothing
            bounds = [np.maximum(lo - d, d - hi) - SLACK * (1 + d + hi) for lo, hi, _ in node.parts]
        bounds = [np.where(np.isnan(x), -np.inf, x) for x in bounds]
        first = np.argmin(bounds, axis=0)
        # the nearer part first, for each query on its own
        for turn in (0, 1):
            for p, (_, _, child) in enumerate(node.parts):
                go = (first == p) == (turn == 0)
                go &= bounds[p] <= self.best[active, -1] * self.factor
                self.walk(child, active[go])

    def _leaf(self, rows: np.ndarray, active: np.ndarray) -> None:
        for at in range(0, len(active), TOGETHER):
            self._meet(rows, active[at:at + TOGETHER])

    def _meet(self, rows: np.ndarray, active: np.ndarray) -> None:
        k = self.best.shape[1]
        a, b = self.queries[active], self.vectors[rows]
        with np.errstate(over="ignore", invalid="ignore"):  # what overflows is measured below
            lengths = (a * a).sum(1)[:, None] + (b * b).sum(1)
            squares = lengths - 2 * (a @ b.T)
            room = lengths * (8 * (a.shape[1] + 4) * np.finfo(float).eps) + TINY
            own = self.ids[rows] == self.query_ids[active, None]
            most = np.where(own, np.inf, squares + room)
            limit = self.best[active, -1] ** 2
            if most.shape[1] > k:
                limit = np.fmin(limit, np.partition(most, k - 1, axis=1)[:, k - 1])
            far = squares - room > (limit * (1 + SLACK))[:, None]
        i, j = np.nonzero(~(far | own))
        if not len(i):
            return
        # the pairs left beside the nearest so far, by query, distance and id
        at = np.concatenate([np.repeat(np.arange(len(active)), k), i])
        d = np.concatenate([self.best[active].ravel(), paired(a[i], b[j])])
        ids = np.concatenate([self.best_ids[active].ravel(), self.ids[rows[j]]])
        order = np.lexsort((ids, d, at))
        first = np.searchsorted(at[order], np.arange(len(active)))
        order = order[first[:, None] + np.arange(k)]
        self.best[active], self.best_ids[active] = d[order], ids[order]


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components that are not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, factor: float = 1.0,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other vectors of each query.

    ``is_query`` is a condition on the column ``vec_id``. Nearest first, ties to
    the smaller id; fewer candidates give fewer rows. Vectors that are null, zero
    or hold null or non-finite components take no part, nor do null ids; of rows
    that share an id the least vector stands. Only vectors of one length are
    compared. An empty table gives an empty table.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    count, asked = rows.select(F.count("*"), F.count_if(is_query)).first()
    shards = max(math.ceil(count / SHARD), min(LEAST_SHARDS, math.ceil(count / 256)), 1)
    blocks = max(math.ceil(asked / BLOCK), 1)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    side = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("block", every(blocks))
    ask = rows.filter(is_query).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")) \
        .withColumn("shard", every(shards))
    keys = ["dim", "shard", "block"]

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        flat = table.column("v").combine_chunks()
        flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
        values = flat.flatten().to_numpy(zero_copy_only=False)
        return table.column("vec_id").to_numpy(), values.reshape(len(table), -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = ([], [], [])
        if len(left) and len(right):
            ids, data = matrix(left)
            query_ids, queries = matrix(right)
            order = np.argsort(ids, kind="stable")
            search = Search(ids[order], data[order], query_ids, queries, k, factor)
            search.walk(build(search.vectors, np.arange(len(ids))), np.arange(len(queries)))
            q, r = np.nonzero(np.isfinite(search.best))
            found = (query_ids[q], search.best_ids[q, r], search.best[q, r])
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()),
                         "score": pa.array(found[2], pa.float64())})

    near = side.groupBy(*keys).cogroup(ask.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
