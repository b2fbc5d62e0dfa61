"""Header CSV whose fields may hold line breaks, read by many tasks at once.

Spark cuts a text file at line ends, but a line end inside quotes is none of the table's. Whether a
block of a file begins inside quotes depends on all blocks before it. So every block is read for both
cases first: what it leaves behind when entered outside and when entered inside quotes (two bits). A
prefix over the blocks of a file then tells where each really begins, and in a second
pass every task cuts its blocks into records. Only records that reach over the border of a
block are shuffled, as pieces. The records themselves are parsed by Spark's own CSV parser.

Same rows as ``multiLine``, which reads each file in one task: a quote opens a field
only at its beginning, a doubled quote stands for itself, what follows a closing quote belongs to the
field, empty lines between records are skipped, CRLF ends a record like LF, a first byte order mark is
dropped. Line breaks inside quotes stay as they are. A lone CR is no record end. Every file must begin with the same header. A compressed file is one block.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_QUOTE = 34
_MARK = b"\xef\xbb\xbf"


def ends_inside(line: bytes, inside: bool, sep: bytes = b",") -> bool:
    """Whether a line leaves a quoted field open, entered inside one or at a record's begin."""
    at = 0
    while True:
        if inside:
            at = line.find(b'"', at)
            if at < 0:
                return True
            if line[at + 1:at + 2] == b'"':
                at += 2
                continue
            inside = False
        elif line.startswith(b'"', at):
            inside, at = True, at + 1
            continue
        at = line.find(sep, at)
        if at < 0:
            return False
        at += 1


def _quoted(lines: pa.Array) -> np.ndarray:
    """Numbers of the lines that hold a quote; all others leave things as they are."""
    data = lines.buffers()[2]
    if data is None:
        return np.zeros(0, np.int64)
    ends = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + len(lines) + 1]
    found = np.flatnonzero(np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] == _QUOTE) + ends[0]
    return np.unique(np.searchsorted(ends, found, "right") - 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """A batch by the blocks its lines come from."""
    files, blocks = batch.column("file"), batch.column("block").to_numpy(zero_copy_only=False)
    lines = batch.column("value").cast(pa.large_binary())
    codes = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(codes) != 0)) + 1
    for lo, hi in zip([0, *edges], [*edges, len(blocks)]):
        if hi > lo:
            yield files[lo].as_py(), int(blocks[lo]), lines.slice(lo, hi - lo)


def _block_effects(sep: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for file, block, lines in _runs(batch):
                if not rows or (rows[-1]["file"], rows[-1]["block"]) != (file, block):
                    rows.append({"file": file, "block": block, "outside": False, "inside": True})
                now = rows[-1]
                for k in _quoted(lines):
                    line = lines[k].as_py()
                    same = now["outside"] == now["inside"]
                    now["outside"] = ends_inside(line, now["outside"], sep)
                    now["inside"] = now["outside"] if same else ends_inside(line, now["inside"], sep)
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("file", pa.string()), ("block", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_())]))
    return run


def _starting_inside(effects: DataFrame) -> DataFrame:
    """The blocks that begin inside quotes: a prefix over each file's blocks.

    Effects are to keep, to swap or to fix the state. The state is what was fixed last, swapped
    once for every swap since.
    """
    place = Window.partitionBy("file").orderBy("block")
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.sum(F.when(F.col("outside") & ~F.col("inside"), 1).otherwise(0))
    fixed = F.when(F.col("outside") == F.col("inside"),
                   F.struct(F.col("outside").cast("int").alias("state"), F.col("upto").alias("swaps")))
    held = (effects.withColumn("upto", swaps.over(place))
            .withColumn("earlier", F.coalesce(swaps.over(before), F.lit(0)))
            .withColumn("last", F.last(fixed, ignorenulls=True).over(before)))
    state = F.coalesce(F.col("last.state"), F.lit(0)) + F.col("earlier") - F.coalesce(F.col("last.swaps"), F.lit(0))
    return held.filter(state % 2 == 1)


_PIECES = pa.schema([("record", pa.binary()), ("file", pa.string()), ("block", pa.int64()),
                     ("begins", pa.bool_()), ("piece", pa.binary())])


def _same_header(record: bytes, names: list[str], sep: str) -> None:
    found = next(csv.reader(io.StringIO(record.decode("utf-8", "replace"), newline=""), delimiter=sep), [])
    if found != names:
        raise ValueError(f"a file of the folder has another header: {found}, not {names}")


def _records(known, names: list[str], sep: str):
    """Worker: whole records, and pieces of those that reach over a block's border."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside_at, at, state = known.value, None, False
        held: list[bytes] = []     # lines of the record that is open
        begun = header = False     # whether its first line was seen; whether it is the header

        def piece() -> list[dict]:
            return [{"file": at[0], "block": at[1], "begins": begun, "piece": b"\n".join(held)}] if held else []

        for batch in batches:
            keys, first = batch.column("key").to_numpy(zero_copy_only=False), 0
            rows: list[dict] = []
            for file, block, lines in _runs(batch):
                if at != (file, block):
                    rows += piece()
                    place = np.searchsorted(inside_at, keys[first])
                    state = bool(place < len(inside_at) and inside_at[place] == keys[first])
                    at, held, begun, header = (file, block), [], not state, block == 0
                first += len(lines)
                marked = set(_quoted(lines).tolist())
                for k, line in enumerate(lines.to_pylist()):
                    if k in marked:
                        state = ends_inside(line, state, sep.encode())
                    held.append(line)
                    if state:
                        continue
                    whole = held[0] if len(held) == 1 else b"\n".join(held)
                    if begun:
                        whole = whole.removesuffix(b"\r")
                        if header and whole.removeprefix(_MARK):
                            _same_header(whole.removeprefix(_MARK), names, sep)
                            header = False
                        elif whole and not header:
                            rows.append({"record": whole})
                    else:
                        rows += [{"file": file, "block": block, "begins": False, "piece": whole}]
                    held, begun = [], True
            yield pa.RecordBatch.from_pylist(rows, schema=_PIECES)
        if at is not None:
            yield pa.RecordBatch.from_pylist(piece(), schema=_PIECES)
    return run


def read_quoted_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns as text, in the header's order."""
    options = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "sep": sep}
    names = spark.read.options(**options).csv(path).columns
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"))
    key = F.xxhash64("file", "block").alias("key")
    effects = lines.mapInArrow(_block_effects(sep.encode()),
                               "file string, block long, outside boolean, inside boolean")
    # Eight bytes per block: a hundred terabytes in blocks of 128 MB are six megabytes.
    inside = np.sort(np.array([r.key for r in _starting_inside(effects).select(key).collect()], np.int64))
    known = spark.sparkContext.broadcast(inside)
    cut = lines.select("value", "file", "block", key).mapInArrow(
        _records(known, names, sep), "record binary, file string, block long, begins boolean, piece binary")
    # A piece that begins a record comes last in its block, one that goes on comes first.
    order = Window.partitionBy("file").orderBy("block", F.col("begins").cast("int"))
    parts = cut.filter("piece IS NOT NULL").withColumn("n", F.sum(F.col("begins").cast("int")).over(order))
    sorted_parts = F.array_sort(F.collect_list(F.struct("block", F.col("begins").cast("int").alias("b"), "piece")))
    joined = parts.groupBy("file", "n").agg(F.array_join(F.transform(
        sorted_parts, lambda p: p["piece"].cast("string")), "\n").alias("record"))
    whole = joined.select(F.regexp_replace("record", "\r$", "").alias("record")).filter("record <> ''")
    every = cut.filter("record IS NOT NULL").select(F.col("record").cast("string").alias("record")).union(whole)
    columns = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    parse = {k: v for k, v in options.items() if k != "header"}
    return every.select(F.from_csv("record", columns, parse).alias("r")).select("r.*")
