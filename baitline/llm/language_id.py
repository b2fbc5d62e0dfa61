"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed letter trigrams: square roots of counts, times the inverse
document frequency over all learning rows, scaled to length 1. Per language a bounded sample
is clustered (spherical k-means), since one language is written in several ways (prose,
tables, lists). A text gets the language of the centroid with the largest cosine. It is
rejected if that cosine is below the floor of its class of length (powers of two trigrams). The
floor lies in the middle of a gap: above it is the value that all but the lowest ``tail`` of the
sample reach, below it what all but ``STRAY`` of a language's sample reach with the centroids of
the other languages, as if it had been left out of learning. A language that reaches the known
ones' value without its own centroids (a close relative, or one that other labels hold too)
has no gap and does not lower or raise the floor; if none has a gap, the floor is the value
itself. Beginnings of the sampled texts stand for short texts. Texts of fewer than
``LEAST_GRAMS`` trigrams are a word or two and are not judged. A cluster of less than ``SUPPORT``
of a sample is stray rows (of another language, say) and gives no centroid.

Cases: a null text, or one without any letter, is ``und`` with score 0 and rejected; rows
with a null language are not learned from; if nothing was learned every text is ``und`` and
only texts without letters are rejected; ties go to the language that sorts first; repeated
rows weigh as often as they occur; texts of any length are read whole; columns named like an
output are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baitline.llm.common import saved, shared_folder, shipped, text_slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURES = 8192
SAMPLE = 2_000  # expected number of rows per language to cluster
CLUSTERS = 4
ROUNDS = 12
TAIL = 0.005
STRAY = 0.05
SUPPORT = 0.01
BEGINNINGS = (12, 24, 48, 96, 192)
LEAST_GRAMS = 8  # shorter texts are too short to be called foreign
ROWS = 256

_LETTER = np.zeros(256, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def gram_counts(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Number of each text, and how often each hashed trigram of its letters occurs.

    Everything that is no letter is one gap; a trigram may hold a gap.
    """
    n = len(at) - 1
    letters = np.zeros(len(data) + n + 1, np.uint8)  # a gap stands before each text
    letters[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(at))] = _LETTER[data]
    first = at + np.arange(n + 1)
    keep = np.empty(len(letters), bool)
    keep[0], keep[1:] = True, (letters[1:] != 0) | (letters[:-1] != 0)
    keep[first] = True
    kept = letters[keep].astype(np.uint32)
    place = np.cumsum(keep)[first] - 1
    code = kept[:-2] | (kept[1:-1] << np.uint32(8)) | (kept[2:] << np.uint32(16))
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(19)
    for k in range(n):
        yield k, np.bincount(code[place[k]:place[k + 1] - 1], minlength=FEATURES)


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    centroids: np.ndarray = field(default_factory=lambda: np.zeros((0, FEATURES), np.float32))
    idf: np.ndarray = field(default_factory=lambda: np.ones(FEATURES, np.float32))
    floors: np.ndarray = field(default_factory=lambda: np.zeros(32))

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        out = np.sqrt(counts.astype(np.float32)) * self.idf
        length = np.sqrt(np.einsum("ij,ij->i", out, out))
        return out / np.maximum(length, 1e-9)[:, None]

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest centroid, its cosine, and whether that is too far away."""
        if not self.languages:
            none = np.zeros(len(counts))
            return none.astype(int), none, none.astype(bool)
        cosine = self.vectors(counts) @ self.centroids.T
        best = cosine.argmax(1)
        score = np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(float)
        return best, score, score < self.floors[_length_class(counts)]


def _length_class(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(counts.sum(1), 1)).astype(int)


def cluster(vectors: np.ndarray, clusters: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means; starts from the rows that are farthest from each other."""
    k = min(clusters, max(1, len(vectors) // 10))
    mean = vectors.mean(0)
    chosen = [int((vectors @ mean).argmax())]
    nearest = vectors @ vectors[chosen[0]]
    while len(chosen) < k:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(rounds):
        own = (vectors @ centroids.T).argmax(1)
        sums = np.stack([vectors[own == c].sum(0) if (own == c).any() else centroids[c]
                         for c in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1), 1e-9)[:, None]
    rows = np.bincount((vectors @ centroids.T).argmax(1), minlength=len(centroids))
    return centroids[rows >= min(SUPPORT * len(vectors), rows.max())]


def _counts_of(batches: Iterator[pa.RecordBatch], text: str):
    """Rows in small blocks with the matrix of their trigram counts."""
    for rows, data, at in text_slices(batches, text):
        block, first = [], 0
        for k, counts in gram_counts(data, at):
            block.append(counts)
            if len(block) == ROWS or k == len(at) - 2:
                yield rows.slice(first, len(block)), np.stack(block)
                block, first = [], k + 1


def _document_frequency(learn: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many learning rows each feature occurs; one row per feature and task is shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, np.int64), 0
        for _, counts in _counts_of(batches, text):
            total += (counts > 0).sum(0)
            n += len(counts)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(total[seen], n))], names=["f", "n"])
    rows = learn.select(text).mapInArrow(count, "f long, n long")
    found = {r.f: r.n for r in rows.groupBy("f").agg(F.sum("n").alias("n")).collect()}
    total = np.array([found.get(f, 0) for f in range(FEATURES)])
    return total, found.get(-1, 0)


def fit(learn: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE,
        clusters: int = CLUSTERS, tail: float = TAIL) -> Model:
    """Learn from rows with a language.

    Document frequencies cover all of them. About ``sample`` rows per language, chosen by a
    hash, are clustered in one task per language; that bounds the memory of the task.
    """
    learn = learn.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, lang)
    # Copies of one text are drawn or left together, so different texts are counted; with fewer than
    # ``sample`` of them all are taken, however often each occurs.
    sizes = {r[lang]: r["n"] for r in learn.groupBy(lang).agg(
        F.approx_count_distinct(F.xxhash64(text), 0.02).alias("n")).collect()}
    if not sizes:
        return Model()
    seen, n = _document_frequency(learn, text)
    model = Model(idf=(np.log((n + 1) / (seen + 1)) + 1).astype(np.float32))
    span = float(1 << 63)
    cuts = learn.sparkSession.createDataFrame(
        [(name, int(min(1.0, 1.1 * sample / max(size, 1)) * (span - 1024))) for name, size in sizes.items()],
        f"`{lang}` string, _cut long")
    picked = (learn.join(F.broadcast(cuts), lang)
              .filter(F.xxhash64(text).bitwiseAND(F.lit((1 << 63) - 1)) <= F.col("_cut")))
    # Copies of one text would all be picked or all be left: they count once.
    picked = saved(picked.select(lang, text).dropDuplicates([lang, text]),
                   shared_folder(learn.sparkSession), "language-sample")
    bare = shipped(learn.sparkSession, model)

    def centroids(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        batch = pa.RecordBatch.from_pandas(rows[["text"]], preserve_index=False)
        counts = np.concatenate([c for _, c in _counts_of(iter([batch]), "text")])
        found = cluster(bare().vectors(counts), clusters)
        return pd.DataFrame({"lang": key[0], "centroid": [c.tolist() for c in found]})
    rows = (picked.select(F.col(lang).alias("lang"), F.col(text).alias("text")).groupBy("lang")
            .applyInPandas(centroids, "lang string, centroid array<float>").collect())
    rows = sorted(rows, key=lambda r: (r.lang, r.centroid))
    model.languages = [r.lang for r in rows]
    model.centroids = np.array([r.centroid for r in rows], np.float32)
    model.floors = _floors(picked, model, text, lang, tail)
    return model


def _floors(picked: DataFrame, model: Model, text: str, lang: str, tail: float) -> np.ndarray:
    """Per class of length (powers of two) the cosine below which a text is too far away."""
    known = shipped(picked.sparkSession, model)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known()
        names = np.array(model.languages)
        for rows, counts in _counts_of(batches, text):
            own = rows.column(rows.schema.get_field_index(lang))
            cosine = model.vectors(counts) @ model.centroids.T
            same = names[None, :] == np.array(own.to_pylist())[:, None]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_length_class(counts)), own, pa.array(cosine.max(1).astype(float)),
                 pa.array(np.where(same, 0, cosine).max(1).astype(float))],
                names=["c", "lang", "cosine", "without"])
    parts = [F.col(text)] + [F.substring(text, 1, n) for n in BEGINNINGS]
    units = picked.select(F.explode(F.array_distinct(F.array(*parts))).alias(text), lang)
    cosines = saved(units.mapInArrow(near, "c long, lang string, cosine double, without double"),
                    shared_folder(picked.sparkSession), "language-cosines")
    low = {r.c: r.q for r in cosines.groupBy("c").agg(
        F.percentile_approx("cosine", tail, 10_000).alias("q")).collect()}
    high: dict[int, float] = {}
    for r in cosines.groupBy("c", "lang").agg(
            F.percentile_approx("without", 1 - STRAY, 10_000).alias("q")).collect():
        if r.q < low[r.c]:
            high[r.c] = max(high.get(r.c, 0.0), r.q)
    found = {c: (q + high.get(c, q)) / 2 for c, q in low.items() if 1 << c >= LEAST_GRAMS}
    # Longer texts come closer to a centroid: a class takes no higher floor than a longer one.
    floors = np.array([found.get(k, np.inf) for k in range(32)])
    floors = np.minimum.accumulate(floors[::-1])[::-1]
    floors[~np.isfinite(floors)] = found[max(found)] if found else 0.0  # longer than any learned
    floors[:int(np.log2(LEAST_GRAMS))] = 0
    return floors


def with_language(df: DataFrame, model: Model, text: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """Add lang_pred, score (cosine, 0 to 1) and rejected. ``keep`` names the columns to return."""
    added = ["lang_pred", "score", "rejected"]
    names = [c for c in keep or df.columns if c not in added]
    known = shipped(df.sparkSession, model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known()
        for rows, counts in _counts_of(batches, text):
            best, score, far = model.nearest(counts)
            texts = rows.column(rows.schema.get_field_index(text)).fill_null("")
            ascii_letter = pc.match_substring_regex(texts, "[A-Za-z]").to_numpy(zero_copy_only=False)
            bare = ~ascii_letter
            for k in np.flatnonzero(bare):  # letters of other scripts
                bare[k] = not any(c.isalpha() for c in texts[int(k)].as_py())
            name = [("und" if b or not model.languages else model.languages[i])
                    for i, b in zip(best, bare)]
            columns = [rows.column(rows.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(name), pa.array(np.where(bare, 0.0, score)), pa.array(bare | far)],
                names=names + added)
    schema = T.StructType([f for n in names for f in df.schema.fields if f.name == n] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType())])
    wanted = [c for c in df.columns if c in names or c == text]
    return df.select(*wanted).mapInArrow(predict, schema)


def learnable(key: Column, divisor: int, held_out: int) -> Column:
    """A fixed split by id: rows whose crc32 leaves another remainder than ``held_out``."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(divisor)) != held_out
