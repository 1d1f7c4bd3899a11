"""Nearest neighbours by largest inner product, with a vantage-point tree per shard.

One more coordinate gives all vectors of a shard the same length; then the largest inner
product is the smallest Euclidean distance, and the triangle inequality holds. A tree
splits its shard by the distance to vantage points. For a query, each leaf has a lower bound
of its distances; leaves whose bound times ``relaxation`` exceeds the distance of the k-th
neighbour so far are skipped. A factor of one therefore gives the exact result; larger
factors skip more.

Vectors are dealt to shards by a hash of their id, queries to blocks, and each pair of shard
and block is one group of bounded size; every group returns at most k rows per query. Copies
of a vector form one point of the tree that keeps its k + 1 smallest ids, more than which a
query can never return.

Ids that are null and vectors that are null, empty, zero or hold nulls or non-finite numbers
take no part. Rows with the same id count once, with the smallest of their vectors in array
order. Vectors of different lengths never meet. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8192
BLOCK_ROWS = 2048
LEAF_ROWS = 128
_QUERIES_AT_ONCE = 512
_SLACK = 1e-9


@dataclass(frozen=True)
class Leaf:
    """Points of a leaf and the rings around vantage points that hold all of them."""

    rows: np.ndarray
    rings: tuple[tuple[int, float, float], ...]


class VantageTree:
    """Tree over the rows of one matrix; deterministic for a given order of the rows."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        norms = np.einsum("ij,ij->i", points, points)
        self.points = points
        self.longest = float(norms.max(initial=0.0))
        # The extra coordinate that makes all points equally long.
        self._extra = np.sqrt(np.maximum(0.0, self.longest - norms))
        self.leaves: list[Leaf] = []
        self.vantage: list[int] = []
        self._split(np.arange(len(points)), (), leaf_rows)

    def _distances(self, rows: np.ndarray, vantage: int) -> np.ndarray:
        inner = self.points[rows] @ self.points[vantage] + self._extra[rows] * self._extra[vantage]
        return np.sqrt(np.maximum(0.0, 2 * (self.longest - inner)))

    def _split(self, rows: np.ndarray, rings: tuple, leaf_rows: int) -> None:
        todo = [(rows, rings)]
        while todo:
            rows, rings = todo.pop()
            if len(rows) <= leaf_rows:
                if len(rows):
                    self.leaves.append(Leaf(rows, rings))
                continue
            vantage = int(rows[len(rows) * 2 // 3])
            number = len(self.vantage)
            self.vantage.append(vantage)
            away = self._distances(rows, vantage)
            order = np.argsort(away, kind="stable")
            for half in (order[: len(order) // 2], order[len(order) // 2 :]):
                ring = (number, float(away[half].min()), float(away[half].max()))
                todo.append((rows[half], (*rings, ring)))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Lower bound of the distance of each query (row) to the points of each leaf."""
        own = np.einsum("ij,ij->i", queries, queries)[:, None]
        inner = queries @ self.points[self.vantage].T
        away = np.sqrt(np.maximum(0.0, own + self.longest - 2 * inner))
        out = np.zeros((len(queries), len(self.leaves)))
        for i, leaf in enumerate(self.leaves):
            for number, low, high in leaf.rings:
                d = away[:, number]
                np.maximum(out[:, i], np.maximum(low - d, d - high), out=out[:, i])
        return out

    def search(
        self, queries: np.ndarray, k: int, relaxation: float = 1.0
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Pairs (query row, point row) that hold the k best points of each query, and the
        number of products computed. More than k are returned where scores nearly tie."""
        own = np.einsum("ij,ij->i", queries, queries)
        bound = self.bounds(queries)
        best = np.full((len(queries), k), -np.inf)
        slack = _SLACK * (1 + np.sqrt(own * self.longest))
        pairs, products = [], 0
        # Leaves that are near most queries first, so that the k-th scores rise early.
        for i in np.argsort(bound.mean(axis=0), kind="stable"):
            rows = self.leaves[i].rows
            kth = np.sqrt(np.maximum(0.0, own + self.longest - 2 * best[:, 0]))
            near = np.flatnonzero(np.isinf(best[:, 0]) | (bound[:, i] * relaxation <= kth + 1e-9))
            if not len(near):
                continue
            scores = queries[near] @ self.points[rows].T
            products += scores.size
            merged = np.concatenate([best[near], scores], axis=1)
            best[near] = np.sort(np.partition(merged, len(rows), axis=1)[:, len(rows) :], axis=1)
            q, p = np.nonzero(scores >= (best[near, 0] - slack[near])[:, None])
            pairs.append((near[q], rows[p], scores[q, p]))
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), products
        q, p, s = (np.concatenate(x) for x in zip(*pairs, strict=True))
        kept = s >= best[q, 0] - slack[q]
        return q[kept], p[kept], products


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed in the order of the components."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def _nearest_in_shard(queries: pa.Table, points: pa.Table, k: int, relaxation: float) -> Iterator[pa.Table]:
    ids, vectors = points.column("vec_id").to_numpy(), _matrix(points.column("embedding"))
    order = np.lexsort([ids])
    distinct, member = np.unique(vectors[order], axis=0, return_inverse=True)
    ids, member = ids[order], member.reshape(-1)
    # The k + 1 smallest ids of each distinct vector, in rising order.
    by_point = np.argsort(member, kind="stable")
    starts = np.searchsorted(member[by_point], np.arange(len(distinct) + 1))
    tree = VantageTree(distinct)
    names = queries.column("vec_id").to_numpy()
    wanted = _matrix(queries.column("embedding"))
    sequence = np.argsort(names, kind="stable")
    for low in range(0, len(names), _QUERIES_AT_ONCE):
        part = sequence[low : low + _QUERIES_AT_ONCE]
        q, p, _ = tree.search(wanted[part], k + 1, relaxation)
        scores = inner_products(wanted[part][q], distinct[p])
        counts = np.minimum(starts[p + 1] - starts[p], k + 1)
        at = np.repeat(starts[p] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        found, query, score = ids[by_point[at]], names[part][np.repeat(q, counts)], np.repeat(scores, counts)
        other = found != query
        found, query, score = found[other], query[other], score[other]
        ranked = np.lexsort([found, -score, query])
        found, query, score = found[ranked], query[ranked], score[ranked]
        begins = np.flatnonzero(np.append(True, query[1:] != query[:-1])[: len(query)])
        rank = np.arange(len(query)) - np.repeat(begins, np.diff(np.append(begins, len(query))))
        kept = rank < k
        yield pa.table({"query_id": query[kept], "vec_id": found[kept], "score": score[kept]})


def usable(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, embedding, dim`` of the vectors that take part, one per id."""
    vector = F.col("embedding")

    def bad(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return (
        df.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
        .where(F.col("vec_id").isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0))
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
        .withColumn("dim", F.size("embedding"))
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    relaxation: float = 1.0,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest other ids of each query, nearest first.

    Both sides come from ``usable``. The score is the inner product in double precision.
    """
    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))

    def dealt(seed: int, parts: int):
        return F.pmod(F.xxhash64(F.lit(seed), F.col("vec_id")), F.lit(parts)).cast("int")

    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    points = vectors.withColumn("shard", dealt(1, shards)).withColumn("block", every_block)
    asked = queries.withColumn("block", dealt(2, blocks)).withColumn("shard", every_shard)
    keys = ("dim", "shard", "block")

    def search(left, right):
        fields = [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
        empty = pa.schema(fields).empty_table()
        if not left.num_rows or not right.num_rows:
            return empty
        return pa.concat_tables([empty, *_nearest_in_shard(left, right, k, relaxation)])

    found = (
        asked.groupBy(*keys)
        .cogroup(points.groupBy(*keys))
        .applyInArrow(search, "query_id long, vec_id long, score double")
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
