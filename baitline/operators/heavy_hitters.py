"""The most frequent values of arrays, found by summaries that merge, then counted exactly.

A task keeps counts of hashed values. When there are too many it keeps the ``size`` largest and
takes the next one's count off each of them (Misra and Gries): no count is then too small by more than
what was taken off in all, and a value left out has no more uses than that. The tasks' summaries add up
by hash, and so does what they took off. If the sum stays below the n-th largest count, every
value that can belong to the n most frequent ones is among those whose count plus that sum reaches the n-th;
otherwise the summaries were too small and are made again, four times as large.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline.plans.scale import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZE = 1 << 18
MOST_SIZE = 1 << 24
MOST_CANDIDATES = 8  # times n
MOST_VALUES = 1 << 18  # array values a task works on at a time


def few_values(batch: pa.RecordBatch, columns: list[int | str], most: int = MOST_VALUES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``most`` array values; a longer row comes alone."""
    lengths = [batch.column(c).value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for c in columns]
    ends = np.cumsum(np.sum(lengths, axis=0, dtype=np.int64))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, before + most, "right")), first + 1)
        yield batch.slice(first, last - first)
        first = last


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order], first)


class Summary:
    """Counts of at most ``size`` values, each too small by ``lost`` at most."""

    def __init__(self, size: int):
        self.size, self.lost = size, 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        if not len(keys):
            return
        self.keys, self.counts = _added(np.concatenate((self.keys, keys)), np.concatenate((self.counts, counts)))
        if len(self.keys) > 4 * self.size:
            self.trim()

    def trim(self) -> None:
        n = len(self.keys)
        if n <= self.size:
            return
        off = int(np.partition(self.counts, n - self.size - 1)[n - self.size - 1])
        kept = self.counts > off
        self.keys, self.counts = self.keys[kept], self.counts[kept] - off
        self.lost += off


def summarise(values: DataFrame, column: str, size: int = SIZE) -> DataFrame:
    """value, n: merged counts of an array<long> column; the row without a value says what was taken off."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Summary(size)
        for batch in batches:
            for rows in few_values(batch, [0]):
                flat = rows.column(0).flatten().to_numpy(zero_copy_only=False)
                held.add(*np.unique(flat, return_counts=True))
            pa.default_memory_pool().release_unused()
        held.trim()
        for k in range(0, len(held.keys), 1 << 16):
            part = slice(k, k + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(held.keys[part]), pa.array(held.counts[part])],
                                             names=["value", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([held.lost])], names=["value", "n"])

    found = values.select(column).mapInArrow(run, "value long, n long")
    return found.groupBy("value").agg(F.sum("n").alias("n"))


def candidates(values: DataFrame, column: str, n: int, size: int = SIZE) -> np.ndarray | None:
    """Sorted values among which the ``n`` most frequent ones are, ties included.

    None if summaries cannot tell: more than ``MOST_CANDIDATES`` times n values tie, or counts
    are so even that summaries of ``MOST_SIZE`` values lose too much. Then only a full count helps.
    """
    while size <= MOST_SIZE:
        merged = cut_lineage(summarise(values, column, size))
        lost = merged.filter("value IS NULL").agg(F.sum("n")).first()[0] or 0
        best = merged.filter("value IS NOT NULL").orderBy(F.desc("n")).limit(n).agg(
            F.count("n").alias("rows"), F.min("n").alias("last")).first()
        last = best.last if best.rows == n else 0  # fewer than n values: all are wanted
        if lost == 0 or lost < last:
            likely = merged.filter(F.col("value").isNotNull() & (F.col("n") >= last - lost))
            rows = likely.limit(MOST_CANDIDATES * n + 1).toArrow()["value"].to_numpy()
            if len(rows) <= MOST_CANDIDATES * n:
                return np.sort(rows)
            if lost == 0:
                return None
        size *= 4
    return None
