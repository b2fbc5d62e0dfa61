"""A Bloom filter built by a distributed aggregation, to keep rows without a partner out of a shuffle.

The filter is made of blocks of 64 KB. A hash names its block, so the hashes of a table are
dealt to the blocks by one shuffle of eight bytes each, and every block is filled by one
group of about fifty thousand of them. The filter grows with the table up to ``MOST_BLOCKS`` (32 MB, what is broadcast at
most); beyond that more rows pass than need to, and the join behind the filter still decides.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BITS = 1 << 19
MOST_BLOCKS = 512
BITS_PER_KEY = 10
PROBES = 7


def _places(hashes: np.ndarray) -> np.ndarray:
    """The bits of each hash inside its block, one row per probe."""
    h = hashes.view(np.uint64)
    step = (h >> np.uint64(19)) | np.uint64(1)
    return (h + np.arange(PROBES, dtype=np.uint64)[:, None] * step) & np.uint64(BLOCK_BITS - 1)


def _block_of(h: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h, 40), F.lit(blocks)).cast("int")


def _filled(group: pa.Table) -> pa.Table:
    bits = np.zeros(BLOCK_BITS // 8, np.uint8)
    places = _places(group.column("h").combine_chunks().to_numpy()).ravel()
    np.bitwise_or.at(bits, (places >> np.uint64(3)).astype(np.int64),
                     np.left_shift(1, (places & np.uint64(7)).astype(np.int64)).astype(np.uint8))
    return pa.table({"block": pa.array([group.column("block")[0].as_py()], pa.int32()),
                     "bits": pa.array([bits.tobytes()])})


class Bloom:
    """Which rows may have a partner in a table's column."""

    def __init__(self, table: DataFrame, column: str, rows: int):
        self.blocks = min(MOST_BLOCKS, rows * BITS_PER_KEY // BLOCK_BITS + 1)
        hashed = table.filter(F.col(column).isNotNull()).select(F.xxhash64(column).alias("h"))
        dealt = hashed.withColumn("block", _block_of(F.col("h"), self.blocks))
        bits = np.zeros((self.blocks, BLOCK_BITS // 8), np.uint8)
        for row in dealt.groupBy("block").applyInArrow(_filled, "block int, bits binary").collect():
            bits[row.block] = np.frombuffer(row.bits, np.uint8)
        self.known = table.sparkSession.sparkContext.broadcast(bits)

    def may_hold(self, column: Column) -> Column:
        """True for every value of the table and for about one in a hundred others; null never."""
        known = self.known

        @F.pandas_udf("boolean")
        def probe(hashes: pd.Series, block: pd.Series) -> pd.Series:
            bits, rows = known.value, block.to_numpy()
            there = np.ones(len(rows), bool)
            for place in _places(np.ascontiguousarray(hashes.to_numpy())):
                held = bits[rows, (place >> np.uint64(3)).astype(np.int64)]
                there &= (held >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            return pd.Series(there)
        h = F.xxhash64(column)
        return column.isNotNull() & probe(h, _block_of(h, self.blocks))
