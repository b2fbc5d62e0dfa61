"""Exact similarity join of documents on word shingles (Jaccard), by partitions of the universe.

Two sets with a Jaccard similarity of at least p/q differ in at most
(|x| + |y|) * (q - p) / (q + p) elements. If the universe of hashed shingles is cut into
segments, few segments can hold a difference, so a pair agrees in one of any sufficiently
large choice of segments. Sizes are cut into classes such that partners lie in the same or
in neighbouring classes; every class has its own number of segments (``Band``). A set is
entered under all its segments, in its own band and in that of the next larger class, and
asks (probes) only in its own band, where a partner is never larger.

A set needs as many asked segments as its largest possible difference plus one. Which ones
is decided by cost: the number of sets that share the segment (counted over the whole corpus
where it is large), so empty and frequent segments come last. Small bands also hold every segment with one element left out; asking
with these neighbours counts double and replaces costly segments.

Segments are hashed sums of their elements. They travel as packed arrays to buckets of a
bounded number of entries (the number of buckets follows the corpus), meet there, and leave
stars: one asking set against each of the others. Stars are verified exactly on the full
sets. Groups of three or more whose members are still in different components afterwards
are completed: sets of different components that met in a segment are held against each other
as bit maps, inside the task of their group or of a pair of its blocks. First each task returns
the likeliest pairs that would join its components (a forest), which are verified exactly; then
all others that pass in groups still open. So no link between components is ever missed, and
pairs inside a component are not enumerated. Copies (equal sets) are one set throughout.

Cases: a text that is null, empty or blank has the empty set and links with nothing; a text
with fewer words than a shingle is one shingle; a null id is returned with a null component
and links with nothing; a repeated id is returned once per row and its rows belong to one
component only if their sets do; ties cannot occur; extra columns do not matter; an empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline.llm.common import mix, release, saved, shared_folder, shingle_sets, text_slices
from baitline.llm.components import components
from baitline.plans.scale import measure

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
SIMILARITY = Fraction(3, 4)
FLUSH_DOCS = 20_000
FLUSH_ENTRIES = 250_000
BUCKET_ENTRIES = 600_000
SMALL_BAND = 64
CROWD = 6
MOST_CROWDED = 1_000_000
GROUP_MEMBERS = 2_000
GROUP_ELEMENTS = 1_000_000


@dataclass(frozen=True)
class Band:
    number: int
    low: int
    high: int
    segments: int

    @property
    def has_neighbours(self) -> bool:
        return self.high <= SMALL_BAND


def needed(size: int, similarity: Fraction) -> int:
    """Segments to ask for so that a partner of at most this size agrees in one."""
    p, q = similarity.numerator, similarity.denominator
    return 2 * size * (q - p) // (q + p) + 1


def bands_up_to(size: int, similarity: Fraction) -> list[Band]:
    """Size classes: a partner that is not larger lies in the same or in the next smaller one."""
    out, low = [], 1
    while low <= size:
        after = low * similarity.denominator // similarity.numerator + 1
        need = needed(after - 1, similarity)
        spare = max(need // 8, min(need // 2, 16))
        out.append(Band(len(out), low, after - 1, need + spare))
        low = after
    return out


def set_key(elements: np.ndarray) -> int:
    digest = hashlib.blake2b(elements.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def set_bits(elements: np.ndarray) -> bytes:
    """A bit map of a set, with 8 to 16 bits per element."""
    size = 1 << max(5, int(8 * len(elements)).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[elements & np.uint64(size - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def document_sets(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """doc_id, n, key (null for the empty set) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in text_slices(batches, text):
            sets = shingle_sets(data, at, words)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())],
                names=["doc_id", "n", "key"])
    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text))
    return rows.mapInArrow(run, "doc_id long, n long, key long")


def chosen_sets(docs: DataFrame, ids: DataFrame, key: str, text: str, words: int,
                what: str) -> DataFrame:
    """key, n and ``what`` (bits or elements) of the sets named by ``ids``: wanted key, document.

    A repeated id may have other texts too: only sets with the wanted key are returned.
    """
    few = measure(ids).fits_broadcast
    picked = docs.select(key, text).join(F.broadcast(ids) if few else ids, key)
    pack = set_bits if what == "bits" else np.ndarray.tobytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in text_slices(batches, text):
            wanted = rows.column(rows.schema.get_field_index("wanted")).to_pylist()
            sets = [(k, s) for k, s in zip(wanted, shingle_sets(data, at, words))
                    if len(s) and set_key(s) == k]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in sets], pa.int64()),
                 pa.array([len(s) for _, s in sets], pa.int64()),
                 pa.array([pack(s) for _, s in sets], pa.binary())], names=["key", "n", what])
    return picked.select(text, "wanted").mapInArrow(run, f"key long, n long, {what} binary")


def entries_of(elements: np.ndarray, sizes: np.ndarray, band: np.ndarray, segments: np.ndarray,
               near: np.ndarray) -> tuple[np.ndarray, ...]:
    """The segments of several sets, each in one band (number, segments, whether it has neighbours).

    ``elements`` holds the sets one after the other. Returns hash and number of elements of every
    segment, the number of the set of each, and per neighbour its hash, segment and set.
    """
    first = np.concatenate(([0], np.cumsum(segments)))
    wide = np.repeat(segments.astype(np.uint64), sizes)
    at = (((elements >> np.uint64(32)) * wide) >> np.uint64(32)).astype(np.int64)
    at += np.repeat(first[:-1], sizes)
    count = np.bincount(at, minlength=int(first[-1]))
    value = mix(elements ^ np.uint64(0xA0761D6478BD642F))
    total = np.zeros(len(elements) + 1, np.uint64)
    np.cumsum(value, out=total[1:])
    ends = np.cumsum(count)
    sums = total[ends] - total[ends - count]
    place = (np.arange(first[-1]) - np.repeat(first[:-1], segments)).astype(np.uint64)
    place += np.repeat((band + 1).astype(np.uint64) << np.uint64(32), segments)
    place = mix(place * np.uint64(0x9E3779B97F4A7C15))
    each = np.repeat(near, sizes)
    within = at[each]
    inner = mix((sums[within] - value[each]) ^ place[within])
    sets = np.arange(len(sizes))
    return (mix(sums ^ place), count, np.repeat(sets, segments), inner, within,
            np.repeat(sets, sizes)[each])


def band_entries(elements: np.ndarray, band: Band) -> tuple[np.ndarray, ...]:
    """Of one set: hash of every segment, its number of elements, the segment of each element,
    and the hash of that segment without the element."""
    full, count, _, inner, within, _ = entries_of(
        elements, np.array([len(elements)]), np.array([band.number]), np.array([band.segments]),
        np.array([band.has_neighbours]))
    return full, count, within, inner


def _asked(doc: np.ndarray, cost: np.ndarray, filled: np.ndarray, need: np.ndarray,
           neighbours: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which segments a set asks for, and which of them together with their neighbours.

    ``doc`` numbers the set of each segment in ascending order, ``need`` is 0 where the set
    only is entered. Filled segments come by rising cost. If they don't reach what is
    needed, the cheapest are asked with neighbours (where the band holds these) and count
    double; empty segments come last.
    """
    order = np.lexsort((cost, ~filled, doc))
    first = np.searchsorted(doc, doc[order])
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.arange(len(doc)) - first
    sets = int(doc[-1]) + 1 if len(doc) else 0
    n_filled = np.bincount(doc[filled], minlength=sets)[doc]
    short = np.maximum(need - n_filled, 0)
    double = np.where(neighbours, np.minimum(short, n_filled), 0)
    asked = np.where(rank < n_filled, rank < need, rank - n_filled < short - double)
    return asked, filled & (rank < double)


def _packed(sets: list[np.ndarray], keys: list[int], similarity: Fraction, buckets: int,
            crowded: tuple[np.ndarray, np.ndarray] | None) -> Iterator[tuple[int, bytes]]:
    """The entries of some sets, by bucket. ``crowded``: segments many sets share, and how many;
    None: only whole segments, to be counted, none is asked for."""
    sizes = np.array([len(s) for s in sets])
    bands = bands_up_to(int(sizes.max()) * similarity.denominator, similarity)
    own = np.searchsorted([b.low for b in bands], sizes, "right") - 1
    segments, near = (np.array([getattr(b, x) for b in bands]) for x in ("segments", "has_neighbours"))
    elements = np.concatenate(sets)
    full, count, owner, inner, within, inner_owner = entries_of(
        elements, sizes, own, segments[own], near[own])
    larger, _, larger_owner, *more = entries_of(elements, sizes, own + 1, segments[own + 1], near[own + 1])
    sigs, owners = [full, larger], [owner, larger_owner]
    asks = [np.zeros(len(full), bool), np.zeros(len(larger), bool)]
    if crowded is not None:
        _, same, often = np.unique(np.concatenate(sigs), return_inverse=True, return_counts=True)
        cost, sig = often[same][:len(full)], full >> np.uint64(16)
        if len(crowded[0]):
            at = np.minimum(np.searchsorted(crowded[0], sig), len(crowded[0]) - 1)
            cost = np.where(crowded[0][at] == sig, np.maximum(crowded[1][at], cost), cost)
        need = np.array([needed(int(n), similarity) for n in sizes])
        asks[0], doubled = _asked(owner, cost, count > 0, need[owner], near[own][owner])
        sigs += [inner, more[0]]
        owners += [inner_owner, more[2]]
        asks += [doubled[within], np.zeros(len(more[0]), bool)]
    sig, owner, asked = np.concatenate(sigs) >> np.uint64(16), np.concatenate(owners), np.concatenate(asks)
    order = np.argsort(sig)
    sig, owner, asked = sig[order], owner[order], asked[order]
    bucket = (sig >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    every = np.array(keys, np.int64)
    for lo, hi in zip([0, *cuts], [*cuts, len(sig)]):
        who, at = np.unique(owner[lo:hi], return_inverse=True)
        head = np.array([hi - lo, len(who)], np.uint32).tobytes()
        s = sig[lo:hi]
        yield int(bucket[lo]), b"".join((
            head, every[who].tobytes(), (s & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
            (s >> np.uint64(32)).astype(np.uint16).tobytes(),
            (at | (asked[lo:hi].astype(np.int64) << 15)).astype(np.uint16).tobytes()))


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, k = np.frombuffer(blob, np.uint32, 2)
    n, k, at = int(n), int(k), 8
    keys = np.frombuffer(blob, np.int64, k, at)
    at += 8 * k
    low = np.frombuffer(blob, np.uint32, n, at)
    at += 4 * n
    high = np.frombuffer(blob, np.uint16, n, at)
    who = np.frombuffer(blob, np.uint16, n, at + 2 * n)
    sig = low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
    return sig, keys[who & 0x7FFF], (who >> 15).astype(bool)


def _new_group(values: np.ndarray) -> np.ndarray:
    return np.concatenate(([True], values[1:] != values[:-1]))


def meet(sig: np.ndarray, key: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stars (asking set, other set) of one bucket, and the groups of three or more sets.

    A group is returned once for equal members: hash of the group, member, whether it asks.
    """
    none = np.zeros(0, np.int64)
    order = np.argsort(sig, kind="stable")
    s = sig[order]
    new = _new_group(s) if len(s) else np.zeros(0, bool)
    alone = new & np.concatenate((new[1:], [True])) if len(s) else new
    order = order[~alone]
    if not len(order):
        return none, none, none, none, none.astype(bool)
    sig, key, asks = sig[order], key[order], asks[order]
    order = np.lexsort((~asks, key, sig))  # of equal entries the asking one stays
    sig, key, asks = sig[order], key[order], asks[order]
    keep = _new_group(sig) | _new_group(key)
    sig, key, asks = sig[keep], key[keep], asks[keep]
    order = np.lexsort((key, ~asks, sig))
    sig, key, asks = sig[order], key[order], asks[order]
    first = np.flatnonzero(_new_group(sig))
    size = np.diff(np.append(first, len(sig)))
    group = np.repeat(np.arange(len(first)), size)
    useful = (size > 1) & asks[first]
    leader = key[first][group]
    star = useful[group] & (key != leader)
    a, b = leader[star], key[star]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    keep = _new_group(a) | _new_group(b) if len(a) else np.zeros(0, bool)
    a, b = a[keep], b[keep]
    member = mix(key.view(np.uint64) * np.uint64(2) + asks.astype(np.uint64))
    total = np.zeros(len(member) + 1, np.uint64)
    np.cumsum(member, out=total[1:])
    digest = mix(total[np.append(first[1:], len(sig))] - total[first])
    large = np.flatnonzero(useful & (size > 2))
    _, once = np.unique(digest[large], return_index=True)
    chosen = np.zeros(len(first), bool)
    chosen[large[once]] = True
    take = chosen[group]
    return a, b, digest[group][take].view(np.int64), key[take], asks[take]


def _entered(docs: DataFrame, key: str, text: str, words: int, similarity: Fraction,
             buckets: int, crowded: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """bucket, entries: the packed entries of all sets."""
    known = docs.sparkSession.sparkContext.broadcast(crowded)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sets: list[np.ndarray] = []
        keys: list[int] = []
        size = 0

        def out() -> pa.RecordBatch:
            rows = list(_packed(sets, keys, similarity, buckets, known.value))
            sets.clear()
            keys.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "entries"])
        for _, data, at in text_slices(batches, text):
            for elements in shingle_sets(data, at, words):
                own = set_key(elements)
                if not len(elements) or own in seen:
                    continue
                seen.add(own)
                sets.append(elements)
                keys.append(own)
                size += len(elements)
                if size > FLUSH_ENTRIES or len(sets) >= FLUSH_DOCS:
                    yield out()
                    size = 0
        if sets:
            yield out()
    return (docs.filter(F.col(key).isNotNull()).select(F.col(text).alias(text))
            .mapInArrow(enter, "bucket long, entries binary"))


def crowded_segments(entered: DataFrame, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Segments that at least CROWD sets of the whole corpus share, with the number of sets.

    They only steer which segments are asked for. At most MOST_CROWDED are returned (a fixed
    bound of what is broadcast): if there are more, only the most frequent.
    """
    def count(table: pa.Table) -> pa.Table:
        parts = [_unpacked(b.as_py()) for b in table.column("entries")]
        sig, own = (np.concatenate(x) for x in list(zip(*parts))[:2])
        order = np.lexsort((own, sig))
        sig, own = sig[order], own[order]
        sig = sig[_new_group(sig) | _new_group(own)]
        first = np.flatnonzero(_new_group(sig))
        n = np.diff(np.append(first, len(sig)))
        many = n >= CROWD
        return pa.table({"sig": sig[first][many].view(np.int64), "n": n[many]})
    found = saved(entered.groupBy("bucket").applyInArrow(count, "sig long, n long"), folder, "crowded")
    classes = found.groupBy(F.floor(F.log2("n")).alias("c")).agg(F.count(F.lit(1)).alias("k")).collect()
    least, held = CROWD, 0
    for c, k in sorted(((r.c, r.k) for r in classes), reverse=True):
        held += k
        if held > MOST_CROWDED:
            least = 2 << c
            break
    rows = found.filter(F.col("n") >= least).toArrow()
    sig = rows.column("sig").to_numpy().view(np.uint64)
    order = np.argsort(sig)
    return sig[order], rows.column("n").to_numpy()[order]


def candidates(entered: DataFrame) -> DataFrame:
    """Stars (a, b) and members of larger groups (g, a, asks), from all segments."""
    def find(table: pa.Table) -> pa.Table:
        parts = [_unpacked(b.as_py()) for b in table.column("entries")]
        a, b, g, member, asks = meet(*(np.concatenate(x) for x in zip(*parts)))
        k = len(a)
        return pa.table({
            "a": pa.array(np.concatenate((a, member))),
            "b": pa.array(np.concatenate((b, np.zeros(len(g), np.int64))),
                          mask=np.arange(k + len(g)) >= k),
            "g": pa.array(np.concatenate((np.zeros(k, np.int64), g)),
                          mask=np.arange(k + len(g)) < k),
            "asks": pa.array(np.concatenate((np.zeros(k, bool), asks)))})
    return entered.groupBy("bucket").applyInArrow(find, "a long, b long, g long, asks boolean")


def _enough(shared: int, x: int, y: int, similarity: Fraction) -> bool:
    return shared * similarity.denominator >= similarity.numerator * (x + y - shared)


def _may_link(x: bytes, y: bytes, n: int, m: int, similarity: Fraction) -> bool:
    """An upper bound of the overlap: every bit that only one has is an element only it has."""
    if not _enough(min(n, m), n, m, similarity):
        return False
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[:len(a) // 2] | a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] | b[len(b) // 2:]
    only_a = int(np.bitwise_count(a & ~b).sum())
    only_b = int(np.bitwise_count(b & ~a).sum())
    return _enough(min(n - only_a, m - only_b), n, m, similarity)


def _linked(x: bytes, y: bytes, similarity: Fraction) -> bool:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = np.sort(np.concatenate((a, b)))
    return _enough(int((both[1:] == both[:-1]).sum()), len(a), len(b), similarity)


def _tested(pairs: DataFrame, sets: DataFrame, test) -> DataFrame:
    """Pairs that pass a test on the columns of both sets (a's first, column by column)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k) for k in range(2, batch.num_columns)]
            yes = [test(*(c[i].as_py() for c in columns)) for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(yes, pa.bool_()))
    own = [c for c in sets.columns if c != "key"]
    left = pairs.join(sets.select(F.col("key").alias("b"), *[F.col(c).alias(f"{c}_b") for c in own]), "b")
    both = left.join(sets.select(F.col("key").alias("a"), *[F.col(c).alias(f"{c}_a") for c in own]), "a")
    columns = [f"{c}_{side}" for c in own for side in "ab"]
    return both.select("a", "b", *columns).mapInArrow(run, "a long, b long")


def exact(near: DataFrame, full_sets: Callable[[DataFrame], DataFrame], similarity: Fraction,
          folder: str, name: str) -> DataFrame:
    """The pairs (a, b) that link, by full sets, which ``full_sets`` makes from their keys.

    Sets of popular keys meet many others; their partitions are split by AQE.
    """
    keys = near.select(F.col("a").alias("key")).union(near.select("b")).distinct()
    full = saved(full_sets(keys), folder, f"{name}-sets").select("key", "elements")
    return saved(_tested(near, full, lambda x, y: _linked(x, y, similarity)), folder, name)


def verify(pairs: DataFrame, bits: DataFrame, full_sets: Callable[[DataFrame], DataFrame],
           similarity: Fraction, folder: str, name: str) -> DataFrame:
    """The pairs (a, b) that link: bit maps first, then the exact test on full sets."""
    near = _tested(pairs, bits, lambda n, m, x, y: _may_link(x, y, n, m, similarity))
    return exact(saved(near, folder, f"{name}-near"), full_sets, similarity, folder, name)


def _near_in_group(n: np.ndarray, label: np.ndarray, asks: np.ndarray, maps: list[bytes],
                   similarity: Fraction) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (i < j) of sets in different components that may link, by the bit map bound, and
    the bound of their similarity."""
    size = min(map(len, maps)) * 8
    bits = np.zeros((len(maps), size), np.float32)
    for k, own in enumerate(maps):
        bits[k] = np.unpackbits(np.frombuffer(own, np.uint8), bitorder="little").reshape(-1, size).max(0)
    filled = bits.sum(1)
    p, q = similarity.numerator, similarity.denominator
    left, right, most = [], [], []
    for at in range(0, len(maps), 512):
        rows = slice(at, at + 512)
        both = bits[rows] @ bits.T
        # Bits that only one has are elements only it has.
        shared = np.minimum(n[rows, None] - (filled[rows, None] - both), n[None] - (filled[None] - both))
        union = n[rows, None] + n[None] - shared
        good = shared * q >= p * union
        good &= (label[rows, None] != label[None]) & (asks[rows, None] | asks[None])
        i, j = np.nonzero(np.triu(good, at + 1))
        left.append(i + at)
        right.append(j)
        most.append(shared[i, j] / union[i, j])
    return np.concatenate(left), np.concatenate(right), np.concatenate(most)


def _forest(i: np.ndarray, j: np.ndarray, weight: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Of pairs of places, those that join components when taken by falling weight."""
    root = np.unique(label, return_inverse=True)[1]
    order = np.argsort(-weight, kind="stable")
    taken = []
    while len(order):
        order = order[root[i[order]] != root[j[order]]]
        head, order = order[:256], order[256:]
        for k in head:
            a, b = root[i[k]], root[j[k]]
            if a != b:
                root[root == b] = a
                taken.append(k)
    return np.array(taken, np.int64)


def across_components(members: DataFrame, bits: DataFrame, similarity: Fraction,
                      forest: bool) -> DataFrame:
    """Pairs g, a < b of sets that share a group but no component and may link.

    ``members``: g, node, asks, label. Members are held against each other as bit maps inside
    a task. Only what passes is returned; with ``forest`` only the likeliest pairs that would
    join all that the pairs of the task join, at least one if any passes. A group beyond
    GROUP_MEMBERS sets or GROUP_ELEMENTS elements is dealt to several tasks, one per pair of its
    blocks, so none holds more than two blocks.
    """
    held = members.join(bits.select(F.col("key").alias("node"), "n"), "node")
    most = F.greatest(F.count(F.lit(1)) / GROUP_MEMBERS, F.sum("n") / GROUP_ELEMENTS)
    held = held.join(held.groupBy("g").agg(F.ceil(most).cast("int").alias("blocks")), "g")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = held.withColumn("own", own).select("g", "node", "n", "asks", "label", "own", other)
    dealt = dealt.select("g", "node", "n", "asks", "label", F.least("own", "other").alias("i"),
                         F.greatest("own", "other").alias("j"))
    full = dealt.join(bits.select(F.col("key").alias("node"), "bits"), "node")

    def find(table: pa.Table) -> pa.Table:
        node, label = table.column("node").to_numpy(), table.column("label").to_numpy()
        i, j, weight = _near_in_group(
            table.column("n").to_numpy().astype(np.float64), label,
            table.column("asks").to_numpy(), [b.as_py() for b in table.column("bits")], similarity)
        if forest:
            chosen = _forest(i, j, weight, label)
            i, j = i[chosen], j[chosen]
        return pa.table({"g": np.full(len(i), table.column("g")[0].as_py(), np.int64),
                         "a": np.minimum(node[i], node[j]), "b": np.maximum(node[i], node[j])})
    return full.groupBy("g", "i", "j").applyInArrow(find, "g long, a long, b long")


def _open_groups(members: DataFrame, labels: DataFrame) -> DataFrame:
    """g, node, asks, label of the groups whose members lie in different components."""
    members = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = members.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    return members.join(several.filter("lo < hi").select("g"), "g", "left_semi")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                       similarity: Fraction = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links) of every row."""
    spark = docs.sparkSession
    folder = shared_folder(spark)
    rows = saved(document_sets(docs, key, text, words), folder, "rows")
    distinct = rows.filter("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key", "n").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    distinct = saved(distinct, folder, "distinct")
    entries = distinct.agg(F.sum("n")).first()[0] or 0
    buckets = entries // BUCKET_ENTRIES + 1

    crowded = crowded_segments(_entered(docs, key, text, words, similarity, buckets, None), folder)
    release(spark)
    entered = _entered(docs, key, text, words, similarity, buckets, crowded)
    found = saved(candidates(entered), folder, "found")
    del entered
    release(spark)
    pairs = saved(found.filter("b IS NOT NULL").select("a", "b").distinct(), folder, "pairs")
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    ids = distinct.join(wanted, "key").select(F.col("key").alias("wanted"), F.col("first").alias(key))
    ids = saved(ids, folder, "ids")
    bits = saved(chosen_sets(docs, ids, key, text, words, "bits"), folder, "bits")
    release(spark)

    def full_sets(keys: DataFrame) -> DataFrame:
        named = ids.join(keys.withColumnRenamed("key", "wanted"), "wanted")
        return chosen_sets(docs, named, key, text, words, "elements")

    links = verify(pairs, bits, full_sets, similarity, folder, "links")
    release(spark)
    labels = components(links, folder, "star")
    members = found.filter("g IS NOT NULL").select("g", F.col("a").alias("node"), "asks").distinct()
    rest = saved(_open_groups(members, labels), folder, "open")
    known = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # The likeliest pairs join most of what there is to join; then all others of the groups that had any.
    for name in ("likely", "across"):
        met = saved(across_components(rest, bits, similarity, name == "likely"), folder, f"{name}-met")
        near = saved(met.select("a", "b").distinct().join(known, ["a", "b"], "left_anti"), folder, name)
        release(spark)
        if not near.limit(1).count():
            if name == "likely" and met.limit(1).count():
                continue
            break
        links = links.union(exact(near, full_sets, similarity, folder, f"{name}-links"))
        labels = components(links, folder, f"{name}-all")
        if name == "likely":
            known = known.union(near)
            rest = rest.drop("label").join(met.select("g").distinct(), "g", "left_semi")
            rest = saved(_open_groups(rest, labels), folder, "still-open")

    placed = distinct.join(labels.withColumnRenamed("node", "key"), "key", "left")
    placed = placed.withColumn("label", F.coalesce("label", "key"))
    smallest = placed.groupBy("label").agg(F.min("first").alias("component_id"))
    # Sets without partners and copies need no look-up.
    shared = placed.join(smallest, "label").filter("copies > 1 OR component_id <> first")
    out = rows.join(shared.select("key", "component_id"), "key", "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
