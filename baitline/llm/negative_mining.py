"""Hard negatives of anchors by Fagin's threshold algorithm.

A task keeps its candidates in blocks; in a block every dimension is a list sorted by its
component. An anchor reads the lists from their best end (the largest components where its
own is positive, the smallest where it is negative), all to the same depth. A
candidate met for the first time is scored at once, in integers, by random access to its
whole vector. The components last read give the threshold, which no candidate still unmet
exceeds. Reading stops once the threshold lies strictly below the k-th score of every
window that is asked for (so ties are never missed) or below all the window allows.

An anchor's positives are its best rows of the same label: one window without bounds over the
block's rows of that label. Its negatives lie, per positive, between two shares of the positive's score and
carry another label. Anchors are a stated set: they go in blocks of bounded size, each broadcast, against
all candidates where they stand; at most k rows per window and task are shuffled, so
neither a large label nor a large group of copies meets in one task.

Cases: rows without id, label or vector, with an empty vector or a component that is
null or not finite take no part (``usable``); a shorter vector counts as continued by zeros;
an anchor is never compared with rows of its own id; a repeated anchor is one anchor (its
smallest label and vector); a repeated candidate counts as often as it occurs; ties go to the
smaller id; with fewer rows than asked all are returned; an empty table gives an empty one; other
columns are ignored. Sums that 64 bits cannot hold raise an error.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baitline.llm.common import saved, shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ANCHOR_BLOCK = 4096
BLOCK_ROWS = 8192
FIRST_DEPTH = 8   # list entries read per dimension before the threshold is first compared


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows of a matrix, continued by zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(width, int(lengths.max(initial=0)))
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


class Lists:
    """Candidates with one sorted list per dimension, readable from both ends."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        n, width = vectors.shape
        up = np.argsort(vectors, axis=0, kind="stable").T
        self.order = np.ascontiguousarray(np.stack((up, up[:, ::-1])))  # worst first, best first
        self.value = np.take_along_axis(vectors.T[None], self.order, 2)
        self.largest = int(np.abs(vectors).max(initial=0))
        # Whole numbers are exact in floating point as long as no sum leaves the mantissa.
        self.vectors, self.narrow, self.wide = vectors, vectors.astype(np.float32), vectors.astype(np.float64)

    def scores(self, who: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        most = self.largest * int(np.abs(anchor).max(initial=0)) * len(anchor)
        if most < 1 << 24:
            return (self.narrow[who] @ anchor.astype(np.float32)).astype(np.int64)
        if most < 1 << 53:
            return (self.wide[who] @ anchor.astype(np.float64)).astype(np.int64)
        if most >= 1 << 63:
            raise OverflowError("inner products may exceed 64 bits")
        return self.vectors[who] @ anchor

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int]], k: int,
               floors: list[int | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window [low, high] the candidates that may be among its ``k`` best, with scores.

        ``floors``: scores that k candidates of other blocks have reached in the window.
        """
        n = len(self.ids)
        used = np.flatnonzero(anchor)
        side = (anchor[used] > 0).astype(np.int64)
        seen = ~allowed
        ids, scores = [], []
        depth, step = 0, FIRST_DEPTH
        while depth < n:
            upto = min(n, depth + step)
            met = np.zeros(n, bool)
            if len(used):
                met[self.order[side, used, depth:upto].ravel()] = True
            else:  # every score is 0
                met[:], upto = True, n
            new = np.flatnonzero(met & ~seen)
            seen |= met
            ids.append(self.ids[new])
            scores.append(self.scores(new, anchor))
            depth, step = upto, step * 2
            if depth == n or seen.all():
                break
            threshold = sum(a * v for a, v in zip(anchor[used].tolist(), self.value[side, used, depth - 1].tolist()))
            every = np.concatenate(scores)
            if all(self._closed(every, threshold, low, high, k, floor)
                   for (low, high), floor in zip(windows, floors)):
                break
        who, score = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (ids, scores))
        out = []
        for low, high in windows:
            inside = np.flatnonzero((score >= low) & (score <= high))
            best = inside[np.lexsort((who[inside], -score[inside]))[:k]]
            out.append((who[best], score[best]))
        return out

    @staticmethod
    def _closed(score: np.ndarray, threshold: int, low: int, high: int, k: int, floor: int | None) -> bool:
        if low > high or threshold < low or (floor is not None and threshold < floor):
            return True
        inside = score[(score >= low) & (score <= high)]
        return len(inside) >= k and threshold < np.partition(inside, len(inside) - k)[len(inside) - k]


LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def _searched(known, k: int, negatives: bool):
    """Worker: per task the ``k`` best candidates of every window of every anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, windows = known.value
        best = [[(np.zeros(0, np.int64),) * 2 for _ in w] for w in windows]

        def compare(rows: pa.Table) -> None:
            matrix = _matrix(rows["v"].combine_chunks(), vectors.shape[1])
            own, kind = rows["id"].to_numpy(), rows["label"].to_numpy()
            asked = np.pad(vectors, ((0, 0), (0, matrix.shape[1] - vectors.shape[1])))
            if negatives:
                parts = {None: Lists(own, kind, matrix)}
            else:
                parts = {}
                for one in np.intersect1d(kind, labels):
                    at = np.flatnonzero(kind == one)
                    parts[int(one)] = Lists(own[at], kind[at], matrix[at])
            for q, (me, label) in enumerate(zip(ids.tolist(), labels.tolist())):
                lists = parts.get(None if negatives else label)
                if lists is None or not windows[q]:
                    continue
                allowed = lists.labels != label if negatives else lists.ids != me
                if negatives:
                    allowed &= lists.ids != me
                floors = [int(s[-1]) if len(s) == k else None for _, s in best[q]]
                found = lists.search(asked[q], allowed, windows[q], k, floors)
                for w, (who, score) in enumerate(found):
                    who, score = (np.concatenate(x) for x in zip(best[q][w], (who, score)))
                    order = np.lexsort((who, -score))[:k]
                    best[q][w] = who[order], score[order]

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                compare(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            compare(pa.Table.from_batches(held))
        sizes = [[len(who) for who, _ in w] for w in best]
        flat = [pair for w in best for pair in w]
        none = [(np.zeros(0, np.int64),) * 2]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(ids, [sum(s) for s in sizes])),
            pa.array(np.concatenate([np.repeat(np.arange(len(s)), s) for s in sizes] + [none[0][0]]).astype(np.int32)),
            pa.array(np.concatenate([who for who, _ in flat + none])),
            pa.array(np.concatenate([score for _, score in flat + none]))],
            names=["anchor_id", "window", "vec_id", "score"])
    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3,
                   low_percent: int = 50, high_percent: int = 95, key: str = "vec_id", label: str = "label",
                   vector: str = "vector", block: int = ANCHOR_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vector`` is an array of integers. The negatives of a positive are the best rows of another
    label with low_percent <= 100 * negative score / positive score <= high_percent.
    """
    spark = rows.sparkSession
    folder = shared_folder(spark)
    shape = [F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
             F.col(vector).cast("array<long>").alias("v")]
    there = "id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL"
    rows = rows.select(*shape).filter(there)
    asked = (anchors.select(*shape).filter(there).groupBy("id")
             .agg(F.min(F.struct("label", "v")).alias("row")).select("id", "row.label", "row.v"))
    asked = saved(asked, folder, "anchors")
    schema = "anchor_id long, window int, vec_id long, score long"
    blocks, result = asked.count() // block + 1, None
    for b in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        width = max((len(r.v) for r in own), default=0)
        vectors = np.zeros((len(own), width), np.int64)
        for r, row in enumerate(own):
            vectors[r, :len(row.v)] = row.v
        ids, labels = (np.array([r[c] for r in own], np.int64) for c in ("id", "label"))
        sc = spark.sparkContext
        first = sc.broadcast((ids, labels, vectors, [[(LOWEST, HIGHEST)]] * len(own)))
        best = saved(_ranked(rows.mapInArrow(_searched(first, positives, False), schema), positives),
                     folder, f"positives-{b}")
        # At most ``positives`` rows per anchor of the block.
        windows: dict[int, list[tuple[int, int]]] = {i: [] for i in ids.tolist()}
        for row in best.orderBy("anchor_id", "rank").collect():
            windows[row.anchor_id].append((-(-low_percent * row.score // 100), high_percent * row.score // 100))
        second = sc.broadcast((ids, labels, vectors, [windows[i] for i in ids.tolist()]))
        found = _ranked(rows.mapInArrow(_searched(second, negatives, True), schema), negatives)
        named = best.select("anchor_id", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"),
                            F.col("score").alias("positive_score"))
        part = found.join(named, ["anchor_id", "window"]).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))
        result = part if result is None else result.union(part)
    return result
