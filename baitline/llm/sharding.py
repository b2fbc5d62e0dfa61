"""Shards of equal size in bytes, by sampled splitters.

Records are ordered by (hash of the text, id), so equal texts lie together. A sample of the
keys, weighted by size, gives the splitters: quantiles that cut the order into ranges of about
equal bytes. Ranges that turn out overfull are subdivided by a sample of their own keys. The
exact bytes of all ranges then say where each of the shards begins, and records are placed by
the bytes before them inside their range only. A group of equal texts stays in one shard: those
larger than ``group_share`` of a shard are dealt out first, the largest to the emptiest shard, and
the small ones fill all shards up to one level. Only a group larger than a whole shard is cut, between records.

Law ``bytes``: sizes of shards differ by at most twice ``group_share`` of a shard plus one
record, unless groups that must stay whole fill a shard beyond that level.

Only keys, sizes and hashes are shuffled, in as many ranges as the data needs, so no task sees
a shard as a whole. Splitters are collected to the driver: at most about ``splitters`` per
round, a fixed number.

Cases: a null text has 0 bytes and counts 1 like every record; a null id orders first and is
returned as null; equal ids and repeated rows are records of their own, told apart by their
place in the order (the partition and row number they were read at, fixed before anything
depends on it); more shards than records leaves shards empty; extra columns are not read; an
empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baitline.llm.common import saved, shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLITTERS = 65_536
ROUNDS = 6
GROUP_SHARE = 0.005
RANGE_ROWS = 200_000


def _sample(rows: DataFrame, rate: float, round_no: int) -> DataFrame:
    """Keys, each taken with a chance of its size times the rate; the same on every retry."""
    chance = F.pmod(F.xxhash64("h", "tie", F.lit(round_no)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return rows.filter(chance < F.col("size") * F.lit(rate)).select("h", "tie")


def _ranges(rows: DataFrame, cuts: list[tuple[int, int]]) -> DataFrame:
    """Add the number of the range between splitters (h, tie)."""
    known = rows.sparkSession.sparkContext.broadcast(
        np.array(sorted(cuts), dtype=[("h", "<i8"), ("tie", "<i8")]))

    @F.pandas_udf("int")
    def place(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        cut = known.value
        for h, tie in parts:
            h, tie = h.to_numpy(np.int64), tie.to_numpy(np.int64)
            lo = np.searchsorted(cut["h"], h)
            hi = np.searchsorted(cut["h"], h, "right")
            for k in np.flatnonzero(hi > lo):  # splitters inside a group of equal texts
                lo[k] += np.searchsorted(cut["tie"][lo[k]:hi[k]], tie[k], "right")
            yield pd.Series(lo.astype(np.int32))
    return rows.withColumn("range", place("h", "tie"))


def _levelled(filled: list[int], total: int) -> np.ndarray:
    """Where, in the order of the small groups, each shard ends, if all are to reach one level.

    ``filled``: bytes every shard holds already; shards beyond the level get nothing more.
    """
    held = np.sort(np.array(filled, np.float64))
    rest = total - held.sum()
    for n in range(len(held), 0, -1):  # the n emptiest shards share the rest
        level = (held[:n].sum() + rest) / n
        if n == 1 or level >= held[n - 1]:
            break
    return np.cumsum(np.maximum(0.0, level - np.array(filled, np.float64)))


def _shard_at(bounds: np.ndarray):
    """The shard that holds a byte of the order."""
    last = int(np.flatnonzero(np.diff(np.concatenate(([0.0], bounds))) > 0).max(initial=0))

    @F.pandas_udf("int")
    def shard(middle: pd.Series) -> pd.Series:
        return pd.Series(np.minimum(np.searchsorted(bounds, middle.to_numpy(), "right"), last).astype(np.int32))
    return shard


def shard_by_bytes(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
                   splitters: int = SPLITTERS, group_share: float = GROUP_SHARE) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (gapless from 0) of every record.

    ``size`` is the UTF-8 length plus 1. Texts themselves do not move; join the result back, or
    use ``write_shards``, to have them in place.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"), (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"), F.xxhash64(content).alias("h"),
        F.monotonically_increasing_id().alias("at"))
    # Fixed once: everything below reads the same numbers.
    rows = saved(rows, folder, "records")
    # Inside a group records are ordered by a hash of id and place, so cuts are even.
    rows = rows.withColumn("tie", F.xxhash64("doc_id", "at"))
    total = rows.agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not total.n:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"))
    target = total.b / shards
    groups = rows.groupBy("h").agg(F.sum("size").alias("bytes"))
    # At most 1 / group_share of these exist per shard.
    large = sorted(((r.bytes, r.h) for r in groups.filter(F.col("bytes") > group_share * target).collect()),
                   reverse=True)
    cut_in = {int(h) for _, h in large}
    filled, dealt = [(0, s) for s in range(shards)], []
    for size, h in large:
        if size <= target:
            held_by, s = heapq.heappop(filled)
            dealt.append((h, s))
            heapq.heappush(filled, (held_by + size, s))
    bounds = _levelled([b for b, _ in sorted(filled, key=lambda f: f[1])], total.b)
    large = [h for size, h in large if size > target]
    dealt = F.broadcast(spark.createDataFrame(dealt, "h long, own int"))

    wanted = min(splitters, max(4 * shards, total.n // RANGE_ROWS + 1))
    cuts: set[tuple[int, int]] = set()
    open_, share = rows, total.b / wanted
    for turn in range(ROUNDS):
        weight = open_.agg(F.sum("size")).first()[0] or 0
        keys = _sample(open_, 4 * wanted / weight if weight else 0.0, turn).collect()
        keys = sorted((r.h, r.tie) for r in keys)[::4]
        lowest = -(1 << 63)
        cuts |= {(h, tie if h in cut_in else lowest) for h, tie in keys}
        ranged = _ranges(rows, list(cuts))
        sizes = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        over = [r.range for r in sizes.collect()
                if r.bytes > 4 * share and r.n > RANGE_ROWS]
        if not over:
            break
        open_ = ranged.filter(F.col("range").isin(over)).drop("range")

    placed = saved(_ranges(rows, list(cuts)).join(dealt, "h", "left"), folder, "ranged")
    free = F.when(F.col("own").isNull(), F.col("size")).otherwise(0)  # groups dealt out take up no room here
    sizes = sorted((r.range, r.b) for r in placed.groupBy("range").agg(F.sum(free).alias("b")).collect())
    starts = np.cumsum([0] + [b for _, b in sizes])[:-1]
    begin = spark.createDataFrame([(r, int(s)) for (r, _), s in zip(sizes, starts)],
                                  "range int, start long")
    inside = Window.partitionBy("range").orderBy("h", "tie", "at")
    before = F.sum(free).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    held = placed.join(F.broadcast(begin), "range").withColumn(
        "offset", F.col("start") + F.coalesce(before, F.lit(0)))
    own = Window.partitionBy("range", "h")
    whole = ~F.col("h").isin(large) if large else F.lit(True)
    # A whole group goes where its middle lies, a record of a cut group where its own lies.
    middle = F.when(whole, F.min("offset").over(own) + F.sum("size").over(own) / 2).otherwise(
        F.col("offset") + F.col("size") / 2)
    held = held.withColumn("shard", F.coalesce("own", _shard_at(bounds)(middle.cast("double"))))
    held = saved(held.select("doc_id", "size", "text_crc32", "h", "tie", "at", "range", "shard"),
                 folder, "sharded")
    counts = sorted((r.shard, r.range, r.n) for r in held.groupBy("shard", "range").agg(
        F.count(F.lit(1)).alias("n")).collect())
    first, run, last = [], 0, None
    for shard, range_, n in counts:
        run = run if shard == last else 0
        first.append((shard, range_, run))
        run, last = run + n, shard
    first = spark.createDataFrame(first, "shard int, range int, first long")
    number = F.row_number().over(Window.partitionBy("shard", "range").orderBy("h", "tie", "at"))
    return (held.join(F.broadcast(first), ["shard", "range"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("first") + number - 1).cast("long").alias("slot")))


def write_shards(docs: DataFrame, sharded: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write the records as Parquet, one folder per shard; ids must be unique.

    Every shard is written by as many tasks as the join has.
    """
    joined = docs.join(sharded.select(F.col("doc_id").alias(key), "shard", "slot"), key)
    joined.write.partitionBy("shard").mode("overwrite").parquet(path)
