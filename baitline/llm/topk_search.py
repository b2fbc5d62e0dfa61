"""Exact top-k search by inner product, by no-random-access aggregation.

The candidates of a task form blocks. In a block every dimension is a list sorted by its
component. For a query the lists are read from their best end (largest first where the
query's component is positive, smallest first where it is negative), all to the same depth.
What has been read gives each candidate a lower bound (unread components at their worst)
and an upper bound (unread components at the last value read). Reading stops when only a
handful of candidates can still reach the k-th best lower bound; their scores are then
resolved exactly. The k-th score of earlier blocks of the task counts as a bound too.

Queries are a stated set: they are taken in blocks of bounded size, each broadcast, against
all candidates where they stand. Only k rows per query and task are shuffled.

Components are integers (``quantised``). Cases: vectors that are null, empty or hold a null or
non-finite component take no part, nor do rows without an id; of vectors with different lengths
the shorter one counts as continued by zeros; a query is never compared with rows of its own
id; a repeated candidate is a candidate as often as it occurs, a repeated query is one query
(its first vector in the order of components); ties go to the smaller id; with fewer than k candidates
all are returned; an empty table gives an empty table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERY_BLOCK = 4096
DEPTHS = (0.1, 0.3, 0.6, 0.8, 1.0)
FIRST_ROWS, BLOCK_ROWS = 512, 4096  # the first block is small and gives the others their bound
QUERY_ROWS = 256


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(odd, F.lit(True))


def quantised(vector: Column, scale: int = 256) -> Column:
    """Every component x as floor(scale * x)."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows of a matrix, continued by zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(lengths.max(initial=0)))
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    at = np.concatenate(([0], np.cumsum(lengths)))
    for k, n in enumerate(lengths):
        out[k, :n] = values[at[k]:at[k] + n]
    return out


class Block:
    """Candidates with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n = len(ids)
        order = np.argsort(vectors, axis=0, kind="stable")
        self.lists = np.take_along_axis(vectors, order, 0).astype(np.float64)
        self.place = np.empty(vectors.shape, np.int64)  # where each component stands in its list
        np.put_along_axis(self.place, order, np.broadcast_to(np.arange(n)[:, None], order.shape), 0)

    def _bounds(self, up: np.ndarray, down: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of every candidate for every query after ``depth`` entries of each list.

        ``up`` and ``down`` are the positive and negative parts of the queries: the first read a
        list from its large end, the others from its small end. Components read count as they are, others lie
        between the last one read and the worst of the list.
        """
        n, both_low, both_high = len(self.ids), 0.0, 0.0
        values = self.vectors.astype(np.float64)
        for weight, read, last, worst in (
                (up, self.place >= n - depth, self.lists[n - depth], self.lists[0]),
                (down, self.place < depth, self.lists[depth - 1], self.lists[-1])):
            known = weight @ np.where(read, values, 0.0).T
            unread = (~read).astype(np.float64).T
            both_high = both_high + known + (weight * last) @ unread
            both_low = both_low + known + (weight * worst) @ unread
        return both_low, both_high

    def best(self, queries: np.ndarray, own: np.ndarray, k: int,
             floors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query ids and scores of the candidates that may be among the k best, all resolved.

        ``floors``: scores that k candidates of other blocks have reached. All queries read to the same
        depth at once; a query is done when few candidates can still qualify.
        """
        n, out = len(self.ids), [(self.ids[:0], np.zeros(0, np.int64))] * len(queries)
        asked = np.arange(len(queries))
        # The sums are exact as long as whole numbers are; beyond that bounds are widened.
        largest = np.abs(self.lists).max(0)
        slack = 1e-9 * (np.abs(queries).astype(np.float64) @ largest)
        for share in DEPTHS if n > 4 * k else DEPTHS[-1:]:
            depth = max(1, min(n, int(n * share)))
            weight = queries[asked].astype(np.float64)
            low, high = self._bounds(np.maximum(weight, 0), np.minimum(weight, 0), depth)
            other = self.ids[None, :] != own[asked][:, None]
            low = np.where(other, low - slack[asked, None], -np.inf)
            bound = floors[asked]
            if n >= k:
                bound = np.maximum(bound, np.partition(low, n - k, 1)[:, n - k])
            left = other & (high + slack[asked, None] >= bound[:, None])
            done = (left.sum(1) <= max(4 * k, n // 50)) | (depth == n)
            for r in np.flatnonzero(done):
                who, q = np.flatnonzero(left[r]), asked[r]
                out[q] = self.ids[who], self.vectors[who] @ queries[q]
            asked = asked[~done]
            if not len(asked):
                break
        return out


def _search(queries: tuple[np.ndarray, np.ndarray], k: int):
    """Per task the k best candidates of every query."""
    ids, vectors = queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2 for _ in ids]
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch.column(1), vectors.shape[1])
            every = batch.column(0).to_numpy(zero_copy_only=False)
            asked = np.pad(vectors, ((0, 0), (0, matrix.shape[1] - vectors.shape[1])))
            at = 0
            while at < len(every):
                end = at + (BLOCK_ROWS if begun else FIRST_ROWS)
                block, at, begun = Block(every[at:end], matrix[at:end]), end, True
                for a in range(0, len(ids), QUERY_ROWS):  # the bounds of so many queries are held at once
                    part = slice(a, a + QUERY_ROWS)
                    floors = np.array([s[-1] if len(s) == k else -np.inf for _, s in best[part]])
                    found = block.best(asked[part], ids[part], k, floors)
                    for q, (near, value) in enumerate(found, a):
                        who, score = np.concatenate((best[q][0], near)), np.concatenate((best[q][1], value))
                        order = np.lexsort((who, -score))[:k]
                        best[q] = who[order], score[order]
        size = [len(who) for who, _ in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(ids, size)),
             pa.array(np.concatenate([w for w, _ in best]) if len(ids) else np.zeros(0, np.int64)),
             pa.array(np.concatenate([s for _, s in best]) if len(ids) else np.zeros(0, np.int64))],
            names=["query_id", "vec_id", "score"])
    return run


def top_k(candidates: DataFrame, queries: DataFrame, k: int, key: str = "vec_id",
          vector: str = "vector", block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of every query.

    ``vector`` is an array of integers. The queries are read block by block (about ``block``
    rows each, by a hash of the id), so neither driver nor executor holds more than one block.
    """
    spark = candidates.sparkSession
    rows = candidates.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    rows = rows.filter("id IS NOT NULL AND v IS NOT NULL")
    asked = (queries.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
             .filter("id IS NOT NULL AND v IS NOT NULL").groupBy("id").agg(F.min("v").alias("v")))
    blocks = asked.count() // block + 1
    found = None
    for b in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        width = max((len(r.v) for r in own), default=0)
        matrix = np.zeros((len(own), width), np.int64)
        for r, row in enumerate(own):
            matrix[r, :len(row.v)] = row.v
        known = spark.sparkContext.broadcast((np.array([r.id for r in own], np.int64), matrix))

        def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            return _search(known.value, k)(batches)
        part = rows.mapInArrow(run, "query_id long, vec_id long, score long")
        found = part if found is None else found.union(part)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
