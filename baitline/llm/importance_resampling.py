"""Resampling of documents towards a target distribution, by n-gram importance weights.

Every run of 1 to ``longest`` words is a feature and belongs to a bucket. How often a bucket occurs
in the target texts against all documents gives the bucket's gain; the gains of a document's
features, repeats counted, add up to its weight, and the highest weights plus Gumbel noise
are a draw without replacement.

Inside a task the n-grams of a block of text are interned in an open-addressed NumPy table:
the place is the n-gram's xxhash64, keys are held against the bytes themselves, neighbours
are probed until every occurrence has its slot. A slot stores the bucket (its CRC is taken
once per different n-gram) and the count; while weighing, each occurrence gathers its gain
through its slot number. Spark adds up the bucket counts of all tasks (at most ``buckets`` rows reach
the driver) and ranks the draw by a range-partitioned sort of ids and scores; texts are never shuffled.

Cases: a null text has no words; a document without features weighs 0; documents with fewer
than ``least_words`` words or without an id are never drawn; equal scores go by id, repeated rows of
one id by their place in the input and each counts for itself; texts of any length are taken
whole, in blocks of ``BLOCK`` bytes; empty tables give empty results; further columns of
the documents are ignored but for those named in ``keep``.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baitline.llm.common import saved, shared_folder, text_slices, word_blocks, worker_memo

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1 << 18
LONG_KEY = 256
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Words are digits, letters and everything beyond ASCII.
_GAP = np.zeros(256, bool)
_GAP[:128] = True
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(sums: np.ndarray | np.uint64, lane: np.ndarray) -> np.ndarray:
    return _turn(sums + lane * _P2, 31) * _P1


def _striped(lanes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """State of xxhash64 after all whole stripes of 32 bytes, for keys that have one."""
    with np.errstate(over="ignore"):
        sums = [np.full(len(start), v, np.uint64) for v in (_P1 + _P2, _P2, np.uint64(0), np.uint64(0) - _P1)]
    for k in range(int(length.max()) // 32):
        live = np.flatnonzero(length >= 32 * (k + 1))
        for i in range(4):
            sums[i][live] = _round(sums[i][live], lanes[start[live] + 32 * k + 8 * i])
    h = _turn(sums[0], 1) + _turn(sums[1], 7) + _turn(sums[2], 12) + _turn(sums[3], 18)
    for s in sums:
        h = (h ^ _round(np.uint64(0), s)) * _P1 + _P4
    return h


def xxhash64(data: bytes, lanes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of many slices of ``data``; ``lanes`` holds 8 bytes from every place."""
    rest = (length & 31).astype(np.uint8)
    order = np.argsort(rest, kind="stable")
    size = length[order]
    h = np.full(len(order), _P5, np.uint64)
    striped = np.flatnonzero((size >= 32) & (size <= LONG_KEY))
    if len(striped):
        h[striped] = _striped(lanes, start[order[striped]], size[striped])
    h += size.astype(np.uint64)
    at = start[order] + (size & ~31)
    edge = np.searchsorted(rest[order], np.arange(33))
    for r in range(32):
        one = slice(edge[r], edge[r + 1])
        if one.start == one.stop:
            continue
        x, p = h[one], at[one]
        for _ in range(r >> 3):
            x = _turn(x ^ _round(np.uint64(0), lanes[p]), 27) * _P1 + _P4
            p = p + 8
        if r & 4:
            x = _turn(x ^ ((lanes[p] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
            p = p + 4
        for k in range(r & 3):
            x = _turn(x ^ ((lanes[p + k] & np.uint64(255)) * _P5), 11) * _P1
        h[one] = x
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    out = np.empty_like(h)
    out[order] = h ^ (h >> np.uint64(32))
    for k in np.flatnonzero(length > LONG_KEY):
        out[k] = xxhash.xxh64_intdigest(data[start[k]:start[k] + length[k]])
    return out


def _same_bytes(data: bytes, lanes: np.ndarray, one: np.ndarray, other: np.ndarray,
                length: np.ndarray) -> np.ndarray:
    """Whether slices of the same length are equal."""
    same = np.ones(len(one), bool)
    for k in np.flatnonzero(length > LONG_KEY):
        same[k] = data[one[k]:one[k] + length[k]] == data[other[k]:other[k] + length[k]]
    live, k = np.flatnonzero(length <= LONG_KEY), 0
    while len(live):
        left = length[live] - k
        cut = (8 * np.maximum(8 - left, 0)).astype(np.uint64)
        differ = (lanes[one[live] + k] ^ lanes[other[live] + k]) << cut
        same[live[differ != 0]] = False
        k += 8
        live = live[left > 8]
    return same


def intern(data: bytes, lanes: np.ndarray, start: np.ndarray, length: np.ndarray,
           keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot of every slice in an open-addressed table, and the slice that owns each slot (or -1)."""
    size = 1 << max(4, (2 * len(start) - 1).bit_length())
    owner = np.full(size, -1, np.int32)
    place = (keys & np.uint64(size - 1)).astype(np.int64)
    slot, open_ = np.empty(len(start), np.int64), np.arange(len(start), dtype=np.int32)
    while len(open_):
        at = place[open_]
        free = owner[at] < 0
        owner[at[free]] = open_[free]
        held = owner[at]
        same = held == open_
        alike = np.flatnonzero(~same & (keys[held] == keys[open_]) & (length[held] == length[open_]))
        same[alike] = _same_bytes(data, lanes, start[held[alike]], start[open_[alike]], length[open_[alike]])
        slot[open_[same]] = at[same]
        open_ = open_[~same]
        place[open_] = (place[open_] + 1) & (size - 1)
    return slot, owner


def _shift_tables() -> np.ndarray:
    """Per number of bytes, what each byte of a CRC-32 becomes when so many zero bytes follow."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    out = np.empty((LONG_KEY + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(LONG_KEY):
        out[n + 1] = (out[n] >> 8) ^ step[out[n] & 255]
    return out


def _joined_crc(crc: np.ndarray, size: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """CRC-32 of two texts put together, from both CRCs and the size of the second."""
    shift = worker_memo("hash_tables_crc", _shift_tables)
    out = tail.copy()
    for k in range(4):
        out ^= shift[size, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _run_crcs(held: bytes, begin: np.ndarray, size: np.ndarray, crc: np.ndarray, longest: int) -> list[np.ndarray]:
    """CRC-32 of the runs of 1 to ``longest`` words that end at each word, from those of the words."""
    runs, short = [crc], np.minimum(size + 1, LONG_KEY)
    behind_blank = _joined_crc(np.full(len(crc), zlib.crc32(b" "), np.uint32), short - 1, crc)
    for n in range(1, longest):
        run = np.zeros(len(crc), np.uint32)
        run[n:] = _joined_crc(runs[-1][n - 1:-1], short[n:], behind_blank[n:])
        runs.append(run)
    for k in np.flatnonzero(size >= LONG_KEY):  # the tables end here
        for n in range(1, longest):
            for last in range(max(k, n), min(k + n + 1, len(crc))):
                runs[n][last] = zlib.crc32(held[begin[last - n]:begin[last] + size[last]])
    return runs


def _features(data: np.ndarray, at: np.ndarray, longest: int, buckets: int
              ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of features: (text of each word, text of each feature, its slot, the slots' buckets)."""
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    carried = np.zeros(0, np.int64)  # where the last words before the block begin
    for lo, hi in word_blocks(data, _GAP, BLOCK):
        begin = int(carried[0]) if len(carried) else lo
        raw = data[begin:hi]
        solid = ~_GAP[raw]
        before, after = np.empty(len(raw), bool), np.empty(len(raw), bool)
        before[0], before[1:] = True, ~solid[:-1]
        after[-1], after[:-1] = True, ~solid[1:]
        first = solid & (before | edge[begin:hi])
        start, end = np.flatnonzero(first), np.flatnonzero(solid & (after | edge[begin + 1:hi + 1])) + 1
        if not len(start):
            continue
        old = len(carried)
        text_of = np.searchsorted(at, start + begin, "right") - 1
        # The words again, lower-cased, with one blank behind each.
        taken = np.flatnonzero(solid)
        plain = np.full(len(taken) + len(start) + 8, 32, np.uint8)
        plain[np.arange(len(taken)) + np.cumsum(first)[taken] - 1] = _LOWER[raw[taken]]
        lanes = np.ndarray((len(plain) - 7,), "<u8", plain, strides=(1,)).copy()
        size = end - start
        new = np.cumsum(size + 1) - size - 1
        ends = [last[text_of[last] == text_of[last - n]] for n in range(longest)
                for last in [np.arange(max(old, n), len(start))]]
        begins = np.concatenate([new[last - n] for n, last in enumerate(ends)])
        length = np.concatenate([new[last] + size[last] for last in ends]) - begins
        held = plain.tobytes()
        slot, owner = intern(held, lanes, begins, length, xxhash64(held, lanes, begins, length))
        # The CRC of each different word, then those of the runs.
        words, where = np.unique(slot[:len(ends[0])], return_inverse=True)
        first, crc = owner[words], zlib.crc32
        known = [crc(held[b:e]) for b, e in zip(begins[first].tolist(), (begins + length)[first].tolist())]
        crcs = [crc(held[b:b + n]) for b, n in zip(new[:old].tolist(), size[:old].tolist())]
        crcs = np.concatenate((np.array(crcs, np.uint32), np.array(known, np.uint32)[where]))
        runs = _run_crcs(held, new, size, crcs, longest)
        bucket = np.zeros(len(owner), np.int64)
        bucket[slot] = np.concatenate([run[last] for run, last in zip(runs, ends)]) % np.uint32(buckets)
        texts = [text_of[last] for last in ends]
        yield text_of[old:], np.concatenate(texts), slot, bucket
        carried = (start + begin)[-(longest - 1):] if longest > 1 else carried


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = 3, buckets: int = 10000) -> np.ndarray:
    """How many features of all texts lie in each bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, data, at in text_slices(batches, text):
            for _, _, slot, bucket in _features(data, at, longest, buckets):
                counts = np.bincount(slot, minlength=len(bucket))
                total += np.bincount(bucket, counts, buckets).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    found = docs.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in found.collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln(target share / corpus share)) per bucket, one count added to each."""
    n = len(corpus)
    own, wanted = float(corpus.sum() + n), float(target.sum() + n)
    return np.array([math.floor(scale * math.log((float(t + 1) * own) / (float(s + 1) * wanted)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def with_weight(docs: DataFrame, gains: np.ndarray, keep: Sequence[str] = ("doc_id",),
                text: str = "text", longest: int = 3) -> DataFrame:
    """``keep`` columns and n_words, n_features, weight (long)."""
    known = docs.sparkSession.sparkContext.broadcast(gains)
    names = [c for c in keep if c != text]
    added = ["n_words", "n_features", "weight"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = known.value
        for rows, data, at in text_slices(batches, text):
            sums = np.zeros((3, rows.num_rows), np.int64)
            for words, texts, slot, bucket in _features(data, at, longest, len(gain)):
                sums[0] += np.bincount(words, minlength=rows.num_rows)
                sums[1] += np.bincount(texts, minlength=rows.num_rows)
                each = gain[bucket][slot]
                sums[2] += np.bincount(texts, each, rows.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column(rows.schema.get_field_index(c)) for c in names] + [pa.array(s) for s in sums],
                names=names + added)

    chosen = docs.select(*names, text)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields if f.name != text]
    return chosen.mapInArrow(weigh, ", ".join(fields + [f"{c} long" for c in added]))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, key: str = "doc_id", text: str = "text",
             longest: int = 3, buckets: int = 10000, seed: int = 42, least_words: int = 20) -> DataFrame:
    """key, n_features, weight, score, rank: rank numbers the documents drawn, null for the others."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    gains = bucket_gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, text, longest, buckets))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    weighed = with_weight(rows, gains, ["key"], "text", longest)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    weighed = saved(weighed.withColumn("score", F.col("weight") + noise.cast("long"))
                    .withColumn("row", F.monotonically_increasing_id()), folder, "weighed")
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    drawn = percent * weighed.filter(able).count() // 100
    # A sorted table whose row numbers name the range and the place inside it gives ranks
    # without a second shuffle: only one start per range is added.
    ordered = weighed.filter(able).orderBy(F.desc("score"), "key", "row")
    ordered = saved(ordered.withColumn("at", F.monotonically_increasing_id()), folder, "ordered")
    ranged = F.shiftright("at", 33).alias("range")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ordered.groupBy(ranged).agg(F.count(F.lit(1)).alias("n"))
              .select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    rank = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = (ordered.withColumn("range", ranged).join(F.broadcast(starts), "range")
              .withColumn("rank", F.when(rank <= drawn, rank)))
    out = ["key", "n_features", "weight", "score", "rank"]
    others = weighed.filter(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*out).unionByName(others.select(*out)).withColumnRenamed("key", key)
