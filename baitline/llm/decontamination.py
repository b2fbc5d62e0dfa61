"""Benchmark decontamination by greedy string tiling.

Words of documents and of benchmark items meet in shared seeds: runs of ``least`` words,
found with a rolling (Karp-Rabin) hash. For every (document, item) pair with enough seeds the
longest run of words that both share and that is still unmarked is marked as a tile, again
and again, until no run of ``least`` words is left. Tiles may stand in any order, so a
passage whose parts were rearranged is found as well. An item is leaked if its tiles cover at
least ``coverage`` of its words.

Words are runs of letters, digits and their marks in any script, with their case folded; signs
of any script are gaps. Scripts written without blanks (ideographs, kana, Thai, Lao, Khmer,
Burmese) have one word per character. Items with fewer than ``least`` words have no seed: they
are leaked where all their words stand in a row, and that first place is their tile.

The benchmark is the query set: it is taken in blocks of bounded size, each broadcast and
held against all documents where they stand. Documents are never shuffled, nor joined with
each other.

Cases: a null, empty or wordless text leaks nothing; items that are null, have no id or no
word are never found; items with equal texts or equal ids are each
reported; repeated documents each get their own result; between tiles of equal length the one
earlier in the item, then in the document, is marked first; of one seed repeated over a long stretch
only places near its two ends are tried, as many as an item can use up; an empty benchmark or document
table gives documents without leaks; a column named like the output is replaced.
"""

from __future__ import annotations

import heapq
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baitline.llm.common import gram_hashes, mix, shipped, text_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST = 4
COVERAGE = 0.6
BLOCK_TEXT = 16 << 20
SIEVE = 1 << 22
PAIRS = 1 << 21
CHARACTERS = 1 << 18

GAP, IN_WORD, ALONE = 0, 1, 2
# Scripts written without blanks.
_NO_BLANKS = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x312F), (0x31A0, 0xA4CF),
              (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF)]

LEAK = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("n_words", T.IntegerType()),
    T.StructField("n_covered", T.IntegerType()),
    T.StructField("tiles", T.ArrayType(T.StructType([
        T.StructField("item_word", T.IntegerType()), T.StructField("n_words", T.IntegerType()),
        T.StructField("from_byte", T.LongType()), T.StructField("to_byte", T.LongType())])))]))
_LEAK = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("n_words", pa.int32()), ("n_covered", pa.int32()),
    ("tiles", pa.list_(pa.struct([("item_word", pa.int32()), ("n_words", pa.int32()),
                                  ("from_byte", pa.int64()), ("to_byte", pa.int64())])))]))


def characters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point the kind of character and its folded form."""
    kind, folded = np.zeros(sys.maxunicode + 1, np.uint8), np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for k in range(sys.maxunicode + 1):
        c = chr(k)
        if unicodedata.category(c)[0] in "LMN":
            kind[k] = IN_WORD
            fold = c.casefold()
            folded[k] = ord(fold if len(fold) == 1 else (c.lower() + c)[0])
    for lo, hi in _NO_BLANKS:
        kind[lo:hi + 1][kind[lo:hi + 1] == IN_WORD] = ALONE
    return kind, folded


def word_hashes(data: np.ndarray, at: np.ndarray, kinds: np.ndarray,
                folded: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words of many texts: 64-bit hash, number of the text, start and end byte."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    kind = kinds[points]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    solid, fresh = kind != GAP, np.ones(len(points), bool)
    fresh[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == ALONE)
    fresh |= edge[place[:-1]]
    start = np.flatnonzero(fresh & solid)
    if not len(start):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    bounds = np.append(np.flatnonzero(fresh), len(points))
    end = bounds[np.searchsorted(bounds, start, "right")]
    hashes = np.zeros(len(points), np.uint64)
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(points)), 0))
    for a in range(0, len(points), CHARACTERS):
        part = slice(a, a + CHARACTERS)
        away = (np.arange(a, min(a + CHARACTERS, len(points))) - begin[part] + 1).astype(np.uint64)
        own = mix(folded[points[part]].astype(np.uint64) + (away << np.uint64(21)))
        hashes[part] = np.where(solid[part], own, np.uint64(0))
    # From one word's start to the next; gaps between them add nothing.
    total = mix(np.add.reduceat(hashes, start))
    first = place[start]
    return total, np.searchsorted(at, first, "right") - 1, first, place[end]


def tiles(at_item: np.ndarray, at_doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (first word in the item, in the document, length) from the places of shared seeds."""
    one = np.zeros(len(at_item), np.int64)
    _, _, i, j, n = _joined_runs(one, one, at_item, at_doc, np.ones(len(at_item), np.int64))
    return marked(i, j, n + least - 1, least)


def _joined_runs(text: np.ndarray, item: np.ndarray, i: np.ndarray, j: np.ndarray,
                 n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of ``n`` seeds from place i of the item and word j on; where one goes on as the next they are one."""
    order = np.lexsort((j, j - i, item, text))
    text, item, i, j, n = (x[order] for x in (text, item, i, j, n))
    goes_on = ((text[1:] == text[:-1]) & (item[1:] == item[:-1]) & (i[1:] == i[:-1] + n[:-1])
               & (j[1:] == j[:-1] + n[:-1]))
    first = np.flatnonzero(np.concatenate(([True], ~goes_on))) if len(n) else np.zeros(0, np.int64)
    return text[first], item[first], i[first], j[first], np.add.reduceat(n, first) if len(n) else n


def marked(at_item: np.ndarray, at_doc: np.ndarray, length: np.ndarray, least: int,
           n_words: int | None = None) -> list[tuple[int, int, int]]:
    """Tiles out of maximal runs, longest first; done once no ``least`` words of the item are left in a row."""
    heap = [(-int(n), int(a), int(b)) for n, a, b in zip(length, at_item, at_doc)]
    heapq.heapify(heap)
    in_item, in_doc, out = set(), set(), []
    room = n_words
    while heap and (room is None or room >= least):
        n, a, b = heapq.heappop(heap)
        free, run = [], 0
        for k in range(-n + 1):
            if k < -n and a + k not in in_item and b + k not in in_doc:
                run += 1
                continue
            if run:
                free.append((run, k - run))
            run = 0
        if free == [(-n, 0)]:
            out.append((a, b, -n))
            in_item.update(range(a, a - n))
            in_doc.update(range(b, b - n))
            if n_words is not None:  # the longest free stretch of the item
                taken = [-1, *sorted(in_item), n_words]
                room = max(y - x for x, y in zip(taken, taken[1:])) - 1
        else:  # what is left of it waits for its turn among shorter ones
            for run, k in free:
                if run >= least:
                    heapq.heappush(heap, (-run, a + k, b + k))
    return sorted(out)


class Items:
    """Seeds of one block of the benchmark."""

    def __init__(self, ids: list[int], texts: list[str], least: int):
        raw = [t.encode() for t in texts]
        at = np.cumsum([0] + [len(r) for r in raw])
        self.characters = characters()
        words, item_of, _, _ = word_hashes(np.frombuffer(b"".join(raw), np.uint8), at, *self.characters)
        seeds, first = gram_hashes(words, item_of, least)
        begin = np.searchsorted(item_of, np.arange(len(raw)))
        self.ids = np.array(ids, np.int64)
        self.n_words = np.bincount(item_of, minlength=len(raw))
        order = np.argsort(seeds, kind="stable")
        self.seeds = seeds[order]
        self.item = item_of[first][order]
        self.place = (first - begin[item_of[first]])[order]
        self.sieve = np.zeros(SIEVE, bool)
        self.sieve[seeds & np.uint64(SIEVE - 1)] = True
        # Items without a seed, by their number of words: hash of the item, item.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, least):
            whole, first = gram_hashes(words, item_of, n)
            own = np.flatnonzero(self.n_words[item_of[first]] == n)
            order = own[np.argsort(whole[own], kind="stable")]
            if len(order):
                self.short[n] = whole[order], item_of[first[order]]

    def _add_short(self, out: list[list], words: np.ndarray, text_of: np.ndarray, start: np.ndarray,
                   end: np.ndarray, at: np.ndarray) -> None:
        for n, (known, item) in self.short.items():
            grams, first = gram_hashes(words, text_of, n)
            lo = np.searchsorted(known, grams)
            maybe = np.flatnonzero(known[np.minimum(lo, len(known) - 1)] == grams)
            # Of a text's equal runs the first one counts.
            pair = np.stack((text_of[first[maybe]].astype(np.int64), lo[maybe]), 1)
            _, once = np.unique(pair, axis=0, return_index=True)
            for k in maybe[once]:
                word, text = int(first[k]), int(text_of[first[k]])
                for who in item[lo[k]:np.searchsorted(known, grams[k], "right")]:
                    out[text].append({
                        "item_id": int(self.ids[who]), "n_words": n, "n_covered": n,
                        "tiles": [{"item_word": 0, "n_words": n, "from_byte": int(start[word] - at[text]),
                                   "to_byte": int(end[word + n - 1] - at[text])}]})

    def leaks(self, data: np.ndarray, at: np.ndarray, least: int, coverage: float) -> list[list]:
        """Per text its leaks."""
        out: list[list] = [[] for _ in at[1:]]
        words, text_of, start, end = word_hashes(data, at, *self.characters)
        self._add_short(out, words, text_of, start, end, at)
        grams, first = gram_hashes(words, text_of, least)
        maybe = np.flatnonzero(self.sieve[grams & np.uint64(SIEVE - 1)])
        lo = np.searchsorted(self.seeds, grams[maybe])
        n = np.searchsorted(self.seeds, grams[maybe], "right") - lo
        used = np.flatnonzero(n)
        maybe, lo, n = maybe[used], lo[used], n[used]
        if not len(n):
            return out
        # Of one seed over and over, as in a word repeated a million times, an item can use up no more
        # places than it has words, from either end of the stretch.
        most = 2 * int(self.n_words.max())
        fresh = np.concatenate(([True], (np.diff(first[maybe]) != 1) | (np.diff(text_of[first[maybe]]) != 0)
                                | (lo[1:] != lo[:-1])))
        begin = np.flatnonzero(fresh)
        size = np.diff(np.append(begin, len(n)))
        inside = np.arange(len(n)) - np.repeat(begin, size)
        size = np.repeat(size, size)
        kept = (inside < most) | (inside >= size - most)
        maybe, lo, n = maybe[kept], lo[kept], n[kept]
        # Pairs (seed in a text, seed in an item), so many at a time; what is kept are runs along a diagonal.
        parts, upto = [], np.cumsum(n)
        a = 0
        while a < len(n):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, "right")))
            own = n[a:b]
            word = np.repeat(first[maybe[a:b]], own)
            hit = np.repeat(lo[a:b] - np.cumsum(own) + own, own) + np.arange(own.sum())
            parts.append(_joined_runs(text_of[word], self.item[hit], self.place[hit], word,
                                      np.ones(len(word), np.int64)))
            a = b
        text, item, place, word, length = _joined_runs(*map(np.concatenate, zip(*parts)))
        length = length + least - 1
        cuts = np.flatnonzero((np.diff(item) != 0) | (np.diff(text) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(item)]):
            who, n_words = int(item[a]), int(self.n_words[item[a]])
            under = np.zeros(n_words + 1, np.int64)
            np.add.at(under, place[a:b], 1)
            np.add.at(under, place[a:b] + length[a:b], -1)
            if (np.cumsum(under) > 0).sum() < coverage * n_words:  # words under any seed
                continue
            found = marked(place[a:b], word[a:b], length[a:b], least, n_words)
            covered = sum(k for _, _, k in found)
            if covered >= coverage * n_words:
                own = int(at[text[a]])
                out[int(text[a])].append({
                    "item_id": int(self.ids[who]), "n_words": n_words, "n_covered": covered,
                    "tiles": [{"item_word": i, "n_words": k, "from_byte": int(start[w]) - own,
                               "to_byte": int(end[w + k - 1]) - own} for i, w, k in found]})
        return out


def with_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
               item_text: str = "text", least: int = LEAST, coverage: float = COVERAGE,
               out: str = "leaks", keep: list[str] | None = None) -> DataFrame:
    """Add the leaked items of every document, with their tiles (``from_byte``, ``to_byte``
    are places in the UTF-8 text). ``keep`` names the columns to return; all by default.
    """
    items = benchmark.select(F.col(item).cast("long").alias("id"), F.col(item_text).alias("t"))
    items = items.filter("id IS NOT NULL AND t IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = size // BLOCK_TEXT + 1
    keep = [c for c in keep or docs.columns if c != out]
    schema = T.StructType([f for f in docs.schema.fields if f.name in keep or f.name == text])
    names = [f.name for f in schema.fields]
    done = docs.select(*names)
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == block).collect()
        known = shipped(docs.sparkSession, Items([r.id for r in own], [r.t for r in own], least))

        def find(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            items = known()
            for rows, data, at in text_slices(batches, text):
                found = items.leaks(data, at, least, coverage)
                if out in rows.schema.names:
                    before = rows.column(rows.schema.get_field_index(out)).to_pylist()
                    found = [a + b for a, b in zip(before, found)]
                columns = [rows.column(rows.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(found, _LEAK)],
                                                 names=[*names, out])
        if block + 1 == blocks:
            names = [n for n in names if n in keep]
        fields = [f for f in schema.fields if f.name in names]
        done = done.mapInArrow(find, T.StructType(fields + [T.StructField(out, LEAK)]))
    return done
