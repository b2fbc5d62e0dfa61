"""Mail archives as a Spark data source, for batch and streams.

An archive is a folder (or one file) of single mails (``*.eml``) and mailboxes (``*.mbox``: mails
one after the other, each begun by a line ``From ...`` after an empty line). A row is a mail: path,
place (byte at which it begins in a mailbox, 0 for single mails), content, error.

Splits are packed by bytes: thousands of small mails share a task, and a large mailbox is
cut into byte ranges, each read by the task in whose range a mail begins. A file that cannot be read is a
row with ``error``, never a gap. Filters on ``path`` prune the listing before a byte is read
(``spark.sql.python.filterPushdown.enabled``), ``limit`` takes the first files by path, and
with ``contents=false`` no single mail is opened. A stream's offset is the (time of change, path) of the
newest file taken, so files must arrive with a fresh time of change; a batch takes all there is,
packed into as many splits as its bytes need.

Files are opened through Arrow's file systems, so whatever they reach (local and shared
folders, s3, gs, hdfs) can be read where the executors see it too.
"""

from __future__ import annotations

import fnmatch
import re
import sys
import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "path string, place long, content binary, error string"
_ARROW = pa.schema([("path", pa.string()), ("place", pa.int64()), ("content", pa.binary()), ("error", pa.string())])
SPLIT_BYTES = 64 << 20
OPEN_COST = 256 << 10     # what opening a file costs, in bytes read
BATCH_BYTES = 2 << 20
CHUNK = 1 << 20
_BEGIN = re.compile(rb"(?:\A|(?<=\n\n)|(?<=\n\r\n))From ")
_QUOTED_FROM = re.compile(rb"(?m)^>(>*From )")


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a path, and the path on it."""
    if "://" not in path:
        return fs.LocalFileSystem(), re.sub(r"^file:", "", path)
    return fs.FileSystem.from_uri(path)


@dataclass(frozen=True)
class File:
    path: str
    size: int
    changed: int  # nanoseconds since the epoch

    @property
    def is_box(self) -> bool:
        return self.path.endswith(".mbox")


@dataclass(frozen=True)
class Piece:
    """Mails that begin in a byte range of a file."""

    path: str
    start: int
    end: int
    is_box: bool


class Split(InputPartition):
    """What one task reads."""

    def __init__(self, pieces: list[Piece]):
        self.pieces = pieces


def _prefix(path: str, own: str) -> str:
    """How listed paths begin in the result: as the caller wrote them."""
    return path[:len(path) - len(own)] if path.endswith(own) else ""


def list_files(path: str, patterns: list[str], recursive: bool) -> list[File]:
    """Files of the archive by path. Hidden files and those being written are left out."""
    system, own = file_system(path)
    scheme = _prefix(path, own)
    info = system.get_file_info(own)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [File(scheme + info.path, info.size, info.mtime_ns or 0)]
    found = [f for f in system.get_file_info(fs.FileSelector(own, recursive=recursive))
             if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))
             and any(fnmatch.fnmatch(f.base_name, p) for p in patterns)]
    return sorted((File(scheme + f.path, f.size, f.mtime_ns or 0) for f in found), key=lambda f: f.path)


def pack(files: Iterable[File], most: int) -> list[Split]:
    """Splits of about ``most`` bytes: mailboxes cut into ranges, single mails put together."""
    splits, held, cost = [], [], 0
    for f in files:
        cuts = range(0, max(f.size, 1), most) if f.is_box else [0]
        for start in cuts:
            end = min(start + most, f.size) if f.is_box else f.size
            own = max(end - start, OPEN_COST)
            if held and cost + own > most:
                splits.append(Split(held))
                held, cost = [], 0
            held.append(Piece(f.path, start, end, f.is_box))
            cost += own
    return splits + ([Split(held)] if held else [])


def _from_lines(source, start: int, end: int) -> Iterator[int]:
    """Where mails begin in [start, end), and behind ``end`` the next one (or the file's end)."""
    size, last = source.size(), -1
    base = at = max(0, start - 3)  # the empty line before may lie outside
    tail = b""
    while at < size:
        source.seek(at)  # the caller reads elsewhere in between
        chunk = source.read(min(CHUNK, size - at))
        held = tail + chunk
        for m in _BEGIN.finditer(held):
            place = base + m.start()
            # The pattern takes the begin of what is held for the file's begin.
            if place < start or place <= last or (m.start() == 0 and base > 0):
                continue
            last = place
            yield place
            if place >= end:
                return
        at += len(chunk)
        tail = held[-7:]  # a From line cut by the chunk's end, with the empty line before it
        base = at - len(tail)
    yield size


def read_box(source, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(place, mail) for each mail that begins in the range, without its ``From`` line."""
    before = None
    for place in _from_lines(source, start, end):
        if before is not None and place > before:
            source.seek(before)
            raw = source.read(place - before)
            body = raw.split(b"\n", 1)[1] if b"\n" in raw else b""
            yield before, _QUOTED_FROM.sub(rb"\1", re.sub(rb"\r?\n\Z", b"", body))
        if place >= end:
            return
        before = place


def _mails(piece: Piece, contents: bool) -> Iterator[tuple[str, int, bytes | None, str | None]]:
    if not piece.is_box and not contents:
        yield piece.path, 0, None, None
        return
    try:
        system, own = file_system(piece.path)
        with system.open_input_file(own) as source:
            if not piece.is_box:
                yield piece.path, 0, source.read(), None
                return
            if piece.start == 0 and piece.end > 0 and source.read(5) != b"From ":
                yield piece.path, 0, None, "not a mailbox: no From line at the beginning"
            for place, mail in read_box(source, piece.start, piece.end):
                yield piece.path, place, mail if contents else None, None
    except (OSError, pa.ArrowException) as e:
        yield piece.path, piece.start, None, f"{type(e).__name__}: {e}"


def read_split(split: Split, contents: bool = True) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for piece in split.pieces:
        for row in _mails(piece, contents):
            held.append(dict(zip(_ARROW.names, row)))
            size += len(row[2] or b"") + 256
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)


_TESTS = {
    EqualTo: lambda p, v: p == v, StringStartsWith: str.startswith, StringEndsWith: str.endswith,
    StringContains: lambda p, v: v in p, In: lambda p, v: p in v, GreaterThan: lambda p, v: p > v,
    GreaterThanOrEqual: lambda p, v: p >= v, LessThan: lambda p, v: p < v, LessThanOrEqual: lambda p, v: p <= v,
}


class _Settings:
    """Options both readers share."""

    def __init__(self, options: dict[str, str]):
        if not options.get("path"):
            raise ValueError("a mail archive needs a path")
        self.path = options["path"]
        self.patterns = [p.strip() for p in options.get("glob", "*.eml,*.mbox").split(",")]
        self.recursive = options.get("recursive", "false").lower() == "true"
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))
        self.contents = options.get("contents", "true").lower() == "true"
        self.limit = int(options["limit"]) if options.get("limit") else None
        self.settle = float(options.get("settleseconds", 2))
        if self.split_bytes < 1:
            raise ValueError("splitbytes must be at least 1")

    def files(self) -> list[File]:
        return list_files(self.path, self.patterns, self.recursive)


class _Reader(DataSourceReader):
    def __init__(self, settings: _Settings):
        self.settings, self.tests = settings, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if type(f) in _TESTS and f.attribute == ("path",):
                self.tests.append((type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[Split]:
        files = self.settings.files()[:self.settings.limit]
        kept = [f for f in files if all(_TESTS[kind](f.path, value) for kind, value in self.tests)]
        return pack(kept, self.settings.split_bytes) or [Split([])]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return read_split(partition, self.settings.contents)


class _StreamReader(DataSourceStreamReader):
    """Files in order of (time of change, path)."""

    def __init__(self, settings: _Settings):
        self.settings = settings

    def initialOffset(self) -> dict:
        return {"changed": -1, "path": ""}

    def latestOffset(self) -> dict:
        # A file still being written, or as new as others still to come, waits for the next batch.
        before = time.time_ns() - int(self.settings.settle * 1e9)
        done = [(f.changed, f.path) for f in self.settings.files() if f.changed <= before]
        changed, path = max(done, default=(-1, ""))
        return {"changed": changed, "path": path}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        low, high = ((o["changed"], o["path"]) for o in (start, end))
        files = [f for f in self.settings.files() if low < (f.changed, f.path) <= high]
        return pack(files, self.settings.split_bytes) or [Split([])]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return read_split(partition, self.settings.contents)


class MailArchive(DataSource):
    """``spark.read.format("mail_archive")`` and ``readStream``, once registered."""

    @classmethod
    def name(cls) -> str:
        return "mail_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(_Settings(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(_Settings(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MailArchive)


def _loaded(reader, path: str, options: dict[str, object]) -> DataFrame:
    named = {k.replace("_", ""): str(v).lower() if isinstance(v, bool) else str(v)
             for k, v in options.items() if v is not None}
    return reader.format(MailArchive.name()).options(**named).load(path)


def read_archive(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """The mails of an archive: path, place, content, error.

    Options: ``glob``, ``recursive``, ``limit``, ``split_bytes``, ``contents``.
    """
    register(spark)
    return _loaded(spark.read, path, options)


def read_archive_stream(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Mails as their files arrive; ``settle_seconds`` is how long a file must have been left alone."""
    register(spark)
    return _loaded(spark.readStream, path, options)


def write_boxes(mails: DataFrame, path: str) -> None:
    """(content) -> mailboxes, one per task; a task's file shows up once it is whole.

    A retried task replaces its own file, so nothing is written twice.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        system, own = file_system(path)
        system.create_dir(own, recursive=True)
        task = TaskContext.get()
        name = f"{own}/part-{task.partitionId():05d}.mbox"
        staged, n = f"{own}/_part-{task.partitionId():05d}-{task.taskAttemptId()}", 0
        with system.open_output_stream(staged) as out:
            for batch in batches:
                for content in batch.column(0):
                    body = re.sub(rb"(?m)^(>*From )", rb">\1", content.as_py() or b"")
                    out.write(b"From - Thu Jan  1 00:00:00 1970\n" + body + (b"\n" if body.endswith(b"\n") else b"\n\n"))
                    n += 1
                pa.default_memory_pool().release_unused()
        system.move(staged, name) if n else system.delete_file(staged)
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    mails.select("content").mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()
