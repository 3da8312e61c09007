"""Approximate nearest neighbours by collision counting (query-aware hashing).

Each hash function is one random projection. A block of vectors keeps, for each projection,
its vectors in the order of their projected values. A query opens a window around its own
value in every order; a vector that lies in the windows of enough projections is verified
by its true inner product. All windows widen by the same factor (virtual rehashing: no further
tables) until at least ``LEAST`` vectors of the block, and a fifth of them, are verified; a block
of at most ``LEAST`` is verified whole. As windows only grow, the first width that is enough is
found by halving the steps between one that is enough and one that is not.

The largest inner product becomes the smallest distance by one more coordinate, which lifts
every vector to the length of the longest one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

BLOCK, CHUNK = 4096, 2048
PROJECTIONS, COLLIDE, VERIFY, WIDEN, START = 64, 0.62, 0.2, 1.08, 0.5
ASKED = math.ceil(COLLIDE * PROJECTIONS)
# FIRST: steps of widening to begin with; TOGETHER: queries that widen their windows at a time.
LEAST, CELLS, FIRST, TOGETHER = 600, 256, 10, 16


def _axes(size: int, seed: int) -> np.ndarray:
    """Random projections; within a set of ``size`` they are orthogonal, which steadies counts."""
    random = np.random.default_rng(seed)
    sets = [np.linalg.qr(random.standard_normal((size, size)))[0] for _ in range(-(-PROJECTIONS // size))]
    return np.hstack(sets)[:, :PROJECTIONS] * math.sqrt(size)


class CollisionIndex:
    """Sorted projections of one block, and its search."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, seed: int = 3):
        self.ids, self.vectors = ids, vectors
        self.axes = _axes(vectors.shape[1] + 1, seed)
        lift = np.sqrt(np.maximum(longest ** 2 - (vectors ** 2).sum(axis=1), 0))
        values = np.hstack([vectors, lift[:, None]]) @ self.axes / max(longest, 1e-300)
        order = np.argsort(values, axis=0, kind="stable")
        ordered = np.take_along_axis(values, order, axis=0).T
        # All orders as one ascending array: each in a range of its own.
        self.reach = float(np.abs(values).max(initial=0)) + 1
        self.shift = np.arange(PROJECTIONS) * 4 * self.reach
        self.start = np.arange(PROJECTIONS) * len(ids)
        self.sorted = (ordered + self.shift[:, None]).ravel()
        # Place of every vector in each order, in ``CELLS`` equal parts: a window is a range of them.
        self.places = np.empty((PROJECTIONS, len(ids)), np.uint8)
        np.put_along_axis(self.places, order.T, self._cells(np.arange(len(ids)))[None, :], axis=1)

    def _cells(self, places: np.ndarray) -> np.ndarray:
        return (places * CELLS // len(self.ids)).astype(np.uint8)

    def _collided(self, centres: np.ndarray, halves: np.ndarray) -> np.ndarray:
        """[queries, vectors]: whether a vector lies in enough windows of ``centres`` ± ``halves``.

        Windows end with the part of the order that their end lies in.
        """
        n = len(self.ids)
        low = np.clip(centres - halves[:, None], -self.reach, self.reach) + self.shift
        high = np.clip(centres + halves[:, None], -self.reach, self.reach) + self.shift
        first = self._cells(np.minimum(np.searchsorted(self.sorted, low) - self.start, n - 1))
        last = self._cells(np.maximum(np.searchsorted(self.sorted, high, side="right") - self.start - 1, 0))
        width = np.where(last >= first, last - first, 0).astype(np.uint8)
        hits = np.zeros((len(centres), n), np.uint8)
        for row, at, wide in zip(self.places, first.T[:, :, None], width.T[:, :, None]):
            hits += (row[None, :] - at) <= wide
        return hits >= ASKED

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query, ids and inner products of the block's ``k`` best verified vectors."""
        n = len(self.ids)
        need = max(k + 1 + math.ceil(VERIFY * n), LEAST)
        if need >= n:
            chosen = np.ones((len(queries), n), bool)
        else:
            lengths = np.maximum(np.sqrt((queries ** 2).sum(axis=1)), 1e-300)
            chosen = self._first_enough(queries @ self.axes[:-1] / lengths[:, None], need)
        return [self._best(query, np.flatnonzero(found), mine, k) for query, found, mine in zip(queries, chosen, own)]

    def _best(self, query: np.ndarray, found: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        scores, ids = self.vectors[found] @ query, self.ids[found]
        other = ids != own
        ids, scores = ids[other], scores[other]
        if len(ids) > k:
            # Everything below the k-th best score goes before the rest is put in order.
            good = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            ids, scores = ids[good], scores[good]
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best]

    def _first_enough(self, centres: np.ndarray, need: int) -> np.ndarray:
        """What collides in the narrowest windows that ``need`` vectors collide in, for each query."""
        q = np.arange(len(centres))
        low, high = np.full(len(q), -1), np.full(len(q), FIRST)
        best = np.zeros((len(q), len(self.ids)), bool)
        open_ = q
        while len(open_):
            found = self._collided(centres[open_], START * WIDEN ** high[open_])
            # Windows that hold everything are enough, however vectors are spread.
            enough = found.sum(axis=1) >= need
            best[open_] = found
            open_ = open_[~enough]
            low[open_], high[open_] = high[open_], high[open_] + 4
        while len(open_ := q[high - low > 1]):
            middle = (low[open_] + high[open_]) // 2
            found = self._collided(centres[open_], START * WIDEN ** middle)
            enough = found.sum(axis=1) >= need
            best[open_[enough]] = found[enough]
            high[open_[enough]], low[open_[~enough]] = middle[enough], middle[~enough]
        return best


def nearest(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the queries: rows whose id is divisible by ``every``.

    Candidates are all rows but the query's own id. Scores are inner products in double
    precision, ranked from 1, ties to the smaller id. Vectors that are null, empty, zero or
    hold null or non-finite components take no part, nor do rows without an id; vectors of
    different lengths never meet. Rows that repeat an id are candidates of their own. With
    fewer than ``k`` candidates all are returned; without queries, none.

    Queries (a stated part of the rows) meet all rows in blocks: a task has one block of about
    4096 vectors and up to about 2048 queries, and returns at most ``k`` rows a query.
    """
    value = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select("vec_id", value.alias("v")).where(
        F.col("vec_id").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("v", lambda x: x != 0))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q"), F.max(length).alias("longest")).first()
    blocks, chunks = max(1, math.ceil(facts["n"] / BLOCK)), max(1, math.ceil(facts["q"] / CHUNK))
    longest = facts["longest"] or 1.0
    rows = rows.withColumn("size", F.size("v"))
    grid = ["size", "block", "chunk"]
    base = (rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    asked = (rows.where(is_query).withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(chunks)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        values = table.column("v").combine_chunks().flatten().to_numpy()
        return table.column("vec_id").to_numpy(), values.reshape(table.num_rows, -1)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        queries, ids, scores, counts = [], [], [], []
        if left.num_rows and right.num_rows:
            own, points = matrix(left)
            # A block that came out too large for 16-bit places is searched in parts.
            for at in range(0, len(own), 60_000):
                index = CollisionIndex(own[at:at + 60_000], points[at:at + 60_000], longest)
                asking, rows = matrix(right)
                for cut in range(0, len(asking), TOGETHER):
                    some = asking[cut:cut + TOGETHER]
                    for query, (found, score) in zip(some, index.search(rows[cut:cut + TOGETHER], some, k)):
                        queries.append(query)
                        counts.append(len(found))
                        ids.append(found)
                        scores.append(score)
        return pa.table({
            "query_id": pa.array(np.repeat(np.array(queries, np.int64), np.array(counts, np.int64)), pa.int64()),
            "vec_id": pa.array(np.concatenate(ids) if ids else [], pa.int64()),
            "score": pa.array(np.concatenate(scores) if scores else [], pa.float64())})

    found = (base.select(*grid, F.col("vec_id").cast("bigint").alias("vec_id"), "v").groupBy(*grid)
             .cogroup(asked.select(*grid, F.col("vec_id").cast("bigint").alias("vec_id"), "v").groupBy(*grid))
             .applyInArrow(search, "query_id bigint, vec_id bigint, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
