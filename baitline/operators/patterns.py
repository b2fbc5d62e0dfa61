"""Literal patterns of a table of any size, found in texts in one pass per text.

The patterns become an automaton with failure links, so the time for a text does not depend
on how many there are. An automaton holds at most about ``PART_BYTES`` of patterns; a larger table is dealt
to several automata by a hash, and the texts pass each of them where they stand. Nothing
but hits leaves a task.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline.plans.scale import measure

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART_BYTES = 2 << 20
PART_ROWS = 200_000
HELD_HITS = 1 << 16  # hits a task gathers before it hands them on


def _automaton(words: list[str]) -> ahocorasick.Automaton:
    """Finds the numbers of the rows whose pattern a text holds; equal patterns share a state."""
    rows: dict[str, list[int]] = {}
    for k, word in enumerate(words):
        rows.setdefault(word, []).append(k)
    found = ahocorasick.Automaton()
    for word, own in rows.items():
        found.add_word(word, own)
    if rows:
        found.make_automaton()
    return found


def _hits(batches: Iterator[pa.RecordBatch], table: pa.Table, search: ahocorasick.Automaton,
          key: str) -> Iterator[pa.RecordBatch]:
    """The hits of (key, text) batches, handed on as they come: a text can hold nearly every pattern."""
    def rows(batch: pa.RecordBatch, who: array, what: array) -> pa.RecordBatch:
        columns = [batch.column(0).take(pa.array(np.frombuffer(who, np.int64)))]
        columns += table.take(pa.array(np.frombuffer(what, np.int64))).combine_chunks().columns
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.RecordBatch.from_arrays(columns, names=[key, *table.column_names])

    for batch in batches if table.num_rows else ():
        who, what = array("q"), array("q")
        for k, value in enumerate(batch.column(1)):
            value = value.as_py()
            hits = {row for _, own in search.iter(value) for row in own} if value else ()
            who.extend([k] * len(hits))
            what.extend(sorted(hits))
            if len(who) >= HELD_HITS:
                yield rows(batch, who, what)
                who, what = array("q"), array("q")
        if who:
            yield rows(batch, who, what)
        pa.default_memory_pool().release_unused()


def find_patterns(texts: DataFrame, patterns: DataFrame, key: str, text: str = "text", pattern: str = "pattern",
                  part_bytes: int = PART_BYTES, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per text and pattern row it contains: ``key`` and all columns of ``patterns``.

    A pattern counts once per text, however often it occurs. Null and empty patterns and null texts match
    nothing; a repeated pattern row is one; a pattern longer than a part is a part of its own.
    """
    clash = set(patterns.columns) & {key}
    if clash:
        raise ValueError(f"texts and patterns share the column {clash}")
    held = patterns.filter(F.col(pattern).isNotNull() & (F.col(pattern) != "")).distinct()
    size = measure(held, *[c for c, kind in held.dtypes if kind == "string"])
    parts = max(-(-size.text_bytes // part_bytes), -(-size.rows // part_rows), 1)
    fields = texts.select(key).schema.fields + held.schema.fields
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    found = None
    for p in range(parts):
        own = held.filter(F.pmod(F.xxhash64(pattern), F.lit(parts)) == p).toArrow()
        known = texts.sparkSession.sparkContext.broadcast(own)

        def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            table = known.value
            yield from _hits(batches, table, _automaton(table.column(pattern).to_pylist()), key)
        part = texts.select(key, text).mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    return found


def pattern_counts(texts: DataFrame, patterns: DataFrame, key: str, text: str = "text",
                   pattern: str = "pattern") -> DataFrame:
    """key, n_patterns: how many different patterns each text contains; texts without a hit have no row."""
    found = find_patterns(texts, patterns.select(pattern), key, text, pattern)
    return found.groupBy(key).agg(F.count(F.lit(1)).alias("n_patterns"))
