"""Parts that several operators of this subpackage share."""

from __future__ import annotations

import gc
import hashlib
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Executors need no installed copy of this package: worker code travels with the job, and values of its
# classes as bytes (``shipped``).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 2 << 20
SLICE_ROWS = 1024
BLOCK_BYTES = 1 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the data folder, through Spark's reader."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shipped(spark: SparkSession, value: object) -> Callable[[], object]:
    """A broadcast value whose classes travel with it: call what is returned in a task.

    A plain broadcast names the classes of its value by module, which executors may not have.
    """
    known = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(known.value)


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the shared place the cluster names; below the warehouse if it names none.

    The file system removes it when the session's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/baitline-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def saved(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: survives lost executors."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.

    It does so when the driver's garbage is collected; a job of many steps would hold the
    files of all of them until the driver happens to need memory.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _memo() -> dict:
    name = "_baitline_worker_memo"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("values", {})


def worker_memo(key: str, build: Callable[[], object]) -> object:
    """A value that later tasks of the same Python worker and step find again."""
    held = _memo()
    if key not in held:
        held[key] = build()
    return held[key]


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES,
                memo: str = "hash_tables") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of rows with about ``most`` bytes of text.

    Yields (rows, bytes of all texts, start offset of each text plus the end). A null is
    an empty text. A single longer text comes alone. Values that the worker remembers of
    another step (``worker_memo``) are dropped; those whose name begins with ``memo`` stay.
    """
    held = _memo()
    for key in [k for k in held if not k.startswith(memo)]:
        del held[key]
    for whole in batches:
        for k in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(k, SLICE_ROWS)
            texts = batch.column(batch.schema.get_field_index(column)).fill_null("")
            texts = texts.cast(pa.large_utf8())
            at = np.frombuffer(texts.buffers()[1], np.int64)
            at = at[texts.offset:texts.offset + len(texts) + 1]
            data = texts.buffers()[2]
            data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
            first = 0
            while first < len(texts):
                last = int(np.searchsorted(at, at[first] + most, "right")) - 1
                last = min(max(last, first + 1), len(texts))
                yield (batch.slice(first, last - first), data[at[first]:at[last]],
                       at[first:last + 1] - at[first])
                first = last
        pa.default_memory_pool().release_unused()


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
# For words without punctuation: every ASCII sign that is no letter or digit is a blank too.
_MARKS = np.zeros(256, bool)
_MARKS[:128] = True
_MARKS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_LONG_WORD = 64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value per byte; powers of an odd base and of its inverse modulo 2**64."""
    size = BLOCK_BYTES + 1
    base = 0x9E3779B97F4A7C15
    byte_values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))

    def powers(b: int) -> np.ndarray:
        out = np.full(size, b, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    return byte_values, powers(base), powers(pow(base, -1, 1 << 64))


def word_blocks(data: np.ndarray, blank: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of at most ``most`` bytes that end between words; a longer word is a run of its own."""
    at, end = 0, len(data)
    while at < end:
        stop = min(at + most, end)
        if stop < end:
            blanks = np.flatnonzero(blank[data[at:stop]])
            if len(blanks):
                stop = at + int(blanks[-1]) + 1
            else:  # one word fills the block
                later = stop
                while later < end and not blank[data[later]]:
                    step = data[later:later + BLOCK_BYTES]
                    found = np.flatnonzero(blank[step])
                    later += int(found[0]) if len(found) else len(step)
                stop = later
        yield at, stop
        at = stop


def word_hashes(data: np.ndarray, at: np.ndarray, marks: bool = True) -> tuple[np.ndarray, ...]:
    """Words of many texts: 64-bit hash, number of the text, start and end byte.

    A word is a run of bytes other than blank, tab, line and page breaks; A-Z count as a-z.
    Without ``marks`` other ASCII signs end a word too.
    """
    values, powers, inverse = worker_memo("hash_tables", _hash_tables)
    blank = _BLANK if marks else _MARKS
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    hashes, starts, ends = [], [], []
    for lo, hi in word_blocks(data, blank):
        raw = data[lo:hi]
        solid = ~blank[raw]
        before = np.empty(len(raw), bool)
        before[0], before[1:] = True, ~solid[:-1]
        before |= edge[lo:hi]
        after = np.empty(len(raw), bool)
        after[-1], after[:-1] = True, ~solid[1:]
        after |= edge[lo + 1:hi + 1]
        start, end = np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1
        if not len(start):
            continue
        length = end - start
        if len(raw) <= BLOCK_BYTES:
            total = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(values[_LOWER[raw]] * powers[:len(raw)], out=total[1:])
            own = (total[end] - total[start]) * inverse[start]
        else:  # a stretch without a blank that texts may cut: the same sums word by word
            own = np.zeros(len(start), np.uint64)
            for k in np.flatnonzero(length <= _LONG_WORD):
                word = values[_LOWER[raw[start[k]:end[k]]]]
                own[k] = (word * powers[:len(word)]).sum()
        own = mix(own + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        for k in np.flatnonzero(length > _LONG_WORD):
            word = _LOWER[raw[start[k]:end[k]]].tobytes()
            own[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        hashes.append(own)
        starts.append(start + lo)
        ends.append(end + lo)
    if not hashes:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    start = np.concatenate(starts)
    return (np.concatenate(hashes), np.searchsorted(at, start, "right") - 1, start,
            np.concatenate(ends))


_PLACES = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64)) for k in range(64)]


def gram_hashes(words: np.ndarray, text_of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words inside one text, and the run's first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += words[k:k + n] * _PLACES[k]
    first = np.flatnonzero(text_of[:n] == text_of[size - 1:])
    return mix(total[first]), first


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its word runs; a short text is one run as a whole."""
    words, text_of, _, _ = word_hashes(data, at)
    grams, first = gram_hashes(words, text_of, size)
    texts = np.arange(len(at))
    of_gram = np.searchsorted(text_of[first], texts)
    of_word = np.searchsorted(text_of, texts)
    out = []
    for k in range(len(at) - 1):
        n = int(of_word[k + 1] - of_word[k])
        if n >= size:
            own = np.sort(grams[of_gram[k]:of_gram[k + 1]])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif n:
            with np.errstate(over="ignore"):
                total = np.uint64(n)
                for i, w in enumerate(words[of_word[k]:of_word[k + 1]]):
                    total = total + w * _PLACES[i]
            out.append(mix(np.array([total], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


