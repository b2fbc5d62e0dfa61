"""A seeded order of all rows whose places are computed, not sorted for.

Row i of n goes to place ``p(i)``, where p is a keyed permutation of 0..n-1: the number is cut into two digits
of about the root of n, and rounds add to either digit a keyed function of the other one. The digits span up to
a root more numbers than there are rows; a place beyond the rows is permuted again until it lies among them
(cycle walking). How often that can be needed is found exactly beforehand, from the few numbers beyond.

No key is sampled and nothing is ranked: every part gets the same number of rows, whatever the keys, and a retry
or another number of parts gives the same order.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property
from math import isqrt

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.plans.scale import lookup_join, measure

PRIME = 2_147_483_647  # products of two smaller numbers fit 64 bits; its predecessor is no multiple of 5
ROUNDS = 8
MOST_ROWS = 1 << 50  # the numbers beyond the rows, at most the root of this, are looked at on the driver
ROWS_PER_PART = 1_000_000


@dataclass(frozen=True)
class Permutation:
    n: int
    seed: int = fv.SEED

    def __post_init__(self):
        if not 0 < self.n <= MOST_ROWS:
            raise ValueError(f"1 to {MOST_ROWS} rows, not {self.n}")

    @property
    def high(self) -> int:
        return isqrt(self.n - 1) + 1

    @property
    def low(self) -> int:
        return -(-self.n // self.high)

    @property
    def keys(self) -> list[tuple[int, int]]:
        """Per round a factor and a summand."""
        def number(k: int, use: str) -> int:
            return int(hashlib.md5(f"{self.seed}:{k}:{use}".encode()).hexdigest()[:15], 16) % (PRIME - 1) + 1
        return [(number(k, "times"), number(k, "plus")) for k in range(ROUNDS)]

    def once(self, x: np.ndarray) -> np.ndarray:
        """The permutation of all numbers the digits span."""
        digits = [x // self.low, x % self.low]
        for k, (times, plus) in enumerate(self.keys):
            y = (digits[1 - k % 2] * times + plus) % PRIME
            y4 = y * y % PRIME
            y4 = y4 * y4 % PRIME
            digits[k % 2] = (digits[k % 2] + y4 * y % PRIME) % (self.high, self.low)[k % 2]
        return digits[0] * self.low + digits[1]

    @cached_property
    def walks(self) -> int:
        """Further passes after which every row's place lies among the rows.

        The numbers beyond that are reached from beyond k times in a row get fewer with k as long as a row may
        need k + 1 passes; those left in the end only lead to each other, and no row leads there.
        """
        beyond, passes = np.arange(self.n, self.high * self.low), 0
        while True:
            held = self.once(beyond)
            held = held[held >= self.n]
            if len(held) == len(beyond):
                return passes
            beyond, passes = held, passes + 1

    def with_place(self, df: DataFrame, number: str, out: str = "place") -> DataFrame:
        """Add the place of the row whose number (0 to n - 1) stands in ``number``; null for null."""
        names = [c for c in df.columns if c != out]
        held = df.withColumn("_x", F.col(number).cast("bigint")).select(*names, "_x")
        for walk in range(self.walks + 1):
            held = held.select("*", F.expr(f"_x div {self.low}").alias("_0"), (F.col("_x") % self.low).alias("_1"))
            for k, (times, plus) in enumerate(self.keys):
                to, by = f"_{k % 2}", f"_{1 - k % 2}"
                y, size = F.col("_y"), (self.high, self.low)[k % 2]
                held = (held.withColumn("_y", (F.col(by) * F.lit(times) + F.lit(plus)) % PRIME)
                        .withColumn("_4", y * y % PRIME).withColumn("_4", F.col("_4") * F.col("_4") % PRIME)
                        .withColumn(to, (F.col(to) + F.col("_4") * y % PRIME) % size))
            found = F.col("_0") * self.low + F.col("_1")
            held = held.select(*names, (F.when(F.col("_x") < self.n, F.col("_x")).otherwise(found)
                                        if walk else found).alias("_x"))
        return held.withColumnRenamed("_x", out)


def numbered_files(spark: SparkSession, path: str, out: str = "number") -> DataFrame:
    """Rows of Parquet files with their number: files in the order of their names, rows as they stand.

    Numbers come from the place in the file and the sizes of the files before; no row is moved or ordered.
    """
    rows = spark.read.parquet(path)
    names = [c for c in rows.columns if c != out]
    placed = rows.select(*names, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    # One row per file.
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    held = lookup_join(placed, starts, "_file", ["_at"], size=measure(sizes, "_file"), how="inner")
    return held.select(*names, (F.col("_start") + F.col("_at")).alias(out))


def permuted_files(spark: SparkSession, path: str, seed: int = fv.SEED, out: str = "place",
                   rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """All rows of Parquet files in a seeded order, ready to be written.

    Part k holds the places from ``k * rows_per_part`` on, in order. An empty table gives an empty one; a column
    named like ``out`` is replaced; copies of a row are rows of their own.
    """
    n = spark.read.parquet(path).count()
    if not n:
        rows = spark.read.parquet(path)
        return rows.drop(out).withColumn(out, F.lit(None).cast("bigint"))
    held = Permutation(n, seed).with_place(numbered_files(spark, path, "_number"), "_number", out).drop("_number")
    part = F.expr(f"cast(`{out}` div {rows_per_part} as int)")
    return held.repartitionById(-(-n // rows_per_part), part).sortWithinPartitions(out)
