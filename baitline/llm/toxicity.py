"""Toxicity scores from a subsequence string kernel with Nyström landmarks and a linear SVM.

The kernel of two words counts the subsequences of three letters they share, each weighted
by ``DECAY`` to the length it spans in either word (up to ``SPAN`` letters), scaled to 1 for
equal words. An insult with letters or signs inserted, or letters left out, keeps most of
its subsequences. Words are lower-cased, digits and signs that stand for letters are read as
these, other signs inside a word are dropped, and a run of single letters is one word.

Landmarks are words of labelled texts: all distinct ones that surely mark toxic texts,
however many, and frequent ones of the others. A text is described by the best match of any of its words with every landmark,
mapped by the inverse root of the landmarks' own kernel matrix (Nyström); an SVM with squared
hinge loss separates these vectors and a sigmoid turns its margin into a score. So that
gapped insults are learned too, clean texts into which a landmark is put, as it is or with a
letter inserted or left out, count as further toxic examples.

Fitting reads at most about ``sample`` labelled rows of each class (a documented bound); words of
all of them are counted by Spark. Scoring reads whole texts where they stand.

Cases: a null, empty or wordless text gets the score of a text without any match; labels
other than 0 and 1, and null labels, are not learned from; without both classes in the
learning rows every score is 1 or 0; a document with
several label rows counts with each; repeated rows each get their score; words beyond
``WINDOW`` letters are read in overlapping windows; ties between landmarks go by the alphabet;
columns named like an output are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baitline.llm.common import saved, shared_folder, shipped, text_slices, worker_memo

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 6_000
CLEAN_LANDMARKS = 32
BLOCK = 600
ROWS = 2048
ALIKE = 0.85
DECAY = 0.6
SPAN = 5
WINDOW = 32
LETTERS = 61
START = "^"
SHARPNESS = 4  # a power of two: squared twice
KERNEL_ROWS = 1024
VARIANTS = 24
GARBLED_SHARE = 1.0  # all garbled examples together, as a share of the toxic ones
COST = 100.0
SLICE = 2 << 20
MEMO_WORDS = 200_000
STEPS = 65_535  # remembered kernel values are whole numbers of 1/STEPS: half the memory and traffic of floats

# Signs that stand for letters inside a word.
STANDS_FOR = str.maketrans("013457@$|", "oieastasi")

_EDGES = re.compile(r"^\W+|\W+$")
_SIGNS = re.compile(r"[\W\d_]+")


def plain_word(token: str) -> str:
    """A lower-case token as letters only; empty if it holds none."""
    if token.isalpha():
        return token
    bare = _EDGES.sub("", token)
    if bare.isalpha():
        return bare
    if not any(c.isalpha() for c in bare):
        return ""
    return _SIGNS.sub("", bare.translate(STANDS_FOR))


def plain_words(text: str, known: dict[str, str]) -> set[str]:
    """Distinct words of a text. ``known`` remembers tokens met before."""
    out, spelled = set(), []
    for token in text.lower().split():
        word = known.get(token)
        if word is None:
            word = known[token] = plain_word(token)
        if len(word) == 1:
            spelled.append(word)
            continue
        if len(spelled) > 2:
            out.add("".join(spelled))
        spelled = []
        if len(word) > 2:
            out.add(word)
    if len(spelled) > 2:
        out.add("".join(spelled))
    return out


def _windows(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Words of at most WINDOW letters, and which word each belongs to."""
    pieces, owner = [], []
    for k, w in enumerate(words):
        starts = range(0, max(1, len(w) - WINDOW // 2), WINDOW // 2) if len(w) > WINDOW else (0,)
        for a in starts:
            pieces.append(w[a:a + WINDOW])
            owner.append(k)
    return pieces, np.array(owner, np.int64)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted three-letter subsequences: word, code, weight; each code once per word.

    The beginning of a word counts as a letter of its own.
    """
    words = [START + w for w in words]
    if not words:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    width = max(map(len, words)) + SPAN
    padded = "".join(w.ljust(width, "\0") for w in words)
    letters = np.frombuffer(padded.encode("utf-32-le"), np.uint32).reshape(len(words), width)
    letters = np.where(letters > 0, letters.astype(np.int64) % (LETTERS - 1) + 1, 0)
    n = width - SPAN
    codes, weights = [], []
    for b in range(2, SPAN + 1):
        for a in range(1, b):
            end = letters[:, b:b + n]
            code = (letters[:, :n] * LETTERS + letters[:, a:a + n]) * LETTERS + end
            codes.append(np.where(end > 0, code, 0))
            weights.append(DECAY ** (b + 1))
    code = np.stack(codes, 2).reshape(len(words), -1)
    weight = np.broadcast_to(np.array(weights), (len(words), n, len(weights))).reshape(len(words), -1)
    row, at = np.nonzero(code)
    key = row * LETTERS ** 3 + code[row, at]
    order = np.argsort(key)
    key, weight = key[order], weight[row, at][order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else key
    total = np.add.reduceat(weight, first) if len(key) else weight
    key = key[first]
    return key // LETTERS ** 3, key % LETTERS ** 3, total


@dataclass
class Landmarks:
    words: list[str]
    place: np.ndarray = field(init=False)   # code -> its number, 0 for none
    starts: np.ndarray = field(init=False)  # where the entries of each code end; those of the one before, where they begin
    owner: np.ndarray = field(init=False)   # per entry the landmark
    weight: np.ndarray = field(init=False)  # and the code's weight in it

    def __post_init__(self):
        row, code, weight = subsequences(self.words)
        norm = np.sqrt(np.bincount(row, weight ** 2, len(self.words)))
        seen, at = np.unique(code, return_inverse=True)
        self.place = np.zeros(LETTERS ** 3, np.int32)
        self.place[seen] = np.arange(1, len(seen) + 1)
        order = np.argsort(at, kind="stable")
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(at, minlength=len(seen)))))
        self.owner = row[order]
        self.weight = (weight / np.maximum(norm, 1e-9)[row])[order]

    def kernel(self, words: list[str]) -> np.ndarray:
        """Kernel of every word with every landmark; 0 for words without three letters."""
        out = np.zeros((len(words), len(self.words)), np.float32)
        for a in range(0, len(words), 4096):
            part, owner = _windows(words[a:a + 4096])
            row, code, weight = subsequences(part)
            norm = np.sqrt(np.bincount(row, weight ** 2, len(part)))
            place = self.place[code]
            hit = np.flatnonzero(place)
            row, place, weight = row[hit], place[hit], weight[hit]
            if not len(row):
                continue
            first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            own = row[first]
            width = len(self.words)
            value = np.empty((len(own), width), np.float32)
            # A code occurs in few landmarks: only these are added up, some hundred words at a time.
            for lo in range(0, len(first), KERNEL_ROWS):
                hi = min(lo + KERNEL_ROWS, len(first))
                part_of = slice(first[lo], first[hi] if hi < len(first) else len(row))
                times = self.starts[place[part_of]] - self.starts[place[part_of] - 1]
                at = np.repeat(self.starts[place[part_of]] - np.cumsum(times), times) + np.arange(times.sum())
                line = np.repeat(np.repeat(np.arange(hi - lo), np.diff(np.append(first[lo:hi], part_of.stop))), times)
                value[lo:hi] = np.bincount(line * width + self.owner[at], self.weight[at] * np.repeat(weight[part_of], times),
                                           (hi - lo) * width).reshape(hi - lo, width)
            value /= np.maximum(norm[own], 1e-9)[:, None]
            value *= value
            value *= value  # SHARPNESS
            own = owner[own]
            if len(part) == len(words[a:a + 4096]):
                out[a + own] = value
            else:
                np.maximum.at(out, a + own, value)
        return out


@dataclass
class Model:
    landmarks: Landmarks
    root: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, matches: np.ndarray) -> np.ndarray:
        margin = matches @ (self.root @ self.weights) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


class Matcher:
    """Best matches of texts; remembers words and tokens met before, up to a fixed number."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks = landmarks
        self.known: dict[str, str] = {}
        self.number: dict[str, int] = {}
        self.rows = np.zeros((0, len(landmarks.words)), np.uint16)

    def matches(self, texts: list[str]) -> np.ndarray:
        """Best match of any word of each text with each landmark."""
        if len(self.known) > MEMO_WORDS:
            self.known = {}
        own = [plain_words(t, self.known) for t in texts]
        new = sorted(set().union(*own) - self.number.keys())
        if len(self.number) + len(new) > MEMO_WORDS:
            self.number, self.rows = {}, self.rows[:0]
            new = sorted(set().union(*own))
        start, number = len(self.number), self.number
        number.update(zip(new, range(start, start + len(new))))
        if start + len(new) > len(self.rows):
            room = max(start + len(new), min(2 * start, MEMO_WORDS))
            more = np.zeros((room, self.rows.shape[1]), np.uint16)
            more[:start] = self.rows[:start]
            self.rows = more
        for a in range(0, len(new), KERNEL_ROWS):
            part = new[a:a + KERNEL_ROWS]
            self.rows[start + a:start + a + len(part)] = np.rint(self.landmarks.kernel(part) * STEPS)
        out = np.zeros((len(texts), self.rows.shape[1]), np.uint16)
        for k, words in enumerate(own):
            at = [number[w] for w in words]
            for a in range(0, len(at), 8192):
                np.maximum(out[k], self.rows[at[a:a + 8192]].max(0), out=out[k])
        return out.astype(np.float32) / STEPS


def matches_of(texts: list[str], landmarks: Landmarks) -> np.ndarray:
    return Matcher(landmarks).matches(texts)


def _matcher(landmarks: Landmarks) -> Matcher:
    return worker_memo(_memo_key(landmarks), lambda: Matcher(landmarks))


def _memo_key(landmarks: Landmarks) -> str:
    return f"matcher {landmarks.words}"


def _svm(x: np.ndarray, y: np.ndarray, share: np.ndarray, cost: float = COST,
         rounds: int = 100) -> np.ndarray:
    """Weights (the last one is the bias) of the squared-hinge SVM, by Newton steps."""
    width = x.shape[1] + 1
    ridge = np.eye(width) / cost
    ridge[-1, -1] = 1e-6
    def margins(w: np.ndarray) -> np.ndarray:
        return np.concatenate([x[a:a + ROWS] @ w[:-1] for a in range(0, len(x), ROWS)]) + w[-1]

    def loss(w: np.ndarray) -> float:
        short = np.maximum(0, 1 - y * margins(w))
        return float(w @ ridge @ w + share @ short ** 2)

    w = np.zeros(width)
    best = loss(w)
    for _ in range(rounds):
        active = np.flatnonzero(y * margins(w) < 1)
        square, side = ridge.copy(), np.zeros(width)
        for a in range(0, len(active), ROWS):  # a block of rows at a time is widened to doubles
            own = active[a:a + ROWS]
            xa = np.hstack((x[own].astype(float), np.ones((len(own), 1))))
            square += (xa * share[own, None]).T @ xa
            side += xa.T @ (share[own] * y[own])
        step = np.linalg.solve(square, side) - w
        size = 1.0
        while size > 1e-4 and loss(w + size * step) >= best:
            size /= 2
        if size <= 1e-4 or best - loss(w + size * step) < 1e-9 * best:
            break
        w = w + size * step
        best = loss(w)
    return w


def _sigmoid(margin: np.ndarray, y: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the score."""
    x = np.stack((margin, np.ones(len(margin))), 1)
    w = np.array([2.0, 0.0])
    target = np.where(y > 0, 0.98, 0.02)
    share = share / share.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (p - target)) + 1e-4 * w
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _garbled(word: str, rng: np.random.Generator) -> str:
    at, chance = int(rng.integers(1, len(word))), rng.random()
    if chance > 0.7:
        return word
    if chance < 0.25 and len(word) > 4:
        return word[:at] + word[at + 1:]
    return word[:at] + chr(97 + int(rng.integers(26))) + word[at:]


def _word_counts(rows: DataFrame, text: str, label: str) -> DataFrame:
    """word, toxic, clean: in how many texts of either class a word occurs."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _ in text_slices(batches, text, SLICE):
            known: dict[str, str] = {}
            labels = part.column(part.schema.get_field_index(label)).to_pylist()
            found = [(w, y) for t, y in zip(
                part.column(part.schema.get_field_index(text)).to_pylist(), labels)
                for w in {*_windows(sorted(plain_words(t or "", known)))[0]}]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.string()),
                 pa.array([y for _, y in found], pa.int32())], names=["word", "y"])
    return rows.select(text, label).mapInArrow(words, "word string, y int").groupBy("word").agg(
        F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))


def _choose(counts: DataFrame, n_toxic: int, n_clean: int) -> tuple[list[str], list[str]]:
    """Landmarks: every word that passes the test, unless one before it is much alike.

    Words that pass number less than the bounded sample has words; they reach the driver.
    """
    words = counts.count()
    rate = F.col("toxic") / n_toxic
    other = (F.col("clean") + 0.5) / (n_clean + 1)
    # So many words are tried that only a likelihood ratio beyond their number is no accident.
    share, base = F.col("toxic") / (F.col("toxic") + F.col("clean")), n_toxic / (n_toxic + n_clean)
    clean = F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base))).otherwise(0.0)
    sure = F.col("toxic") * F.log(share / base) + clean > math.log(words + 1)
    marks = (counts.filter((F.col("toxic") > 0) & (rate > other)).filter(sure)
             .withColumn("worth", rate * F.log(rate / other))
             .orderBy(F.desc("worth"), "word").collect())
    often = counts.orderBy(F.desc("clean"), "word").limit(CLEAN_LANDMARKS).collect()
    words = [r.word for r in marks]
    chosen: list[int] = []
    for a in range(0, len(words), BLOCK):  # blocks keep the kernel matrices small
        block = words[a:a + BLOCK]
        near = Landmarks([words[k] for k in chosen]).kernel(block).max(1) if chosen else np.zeros(len(block))
        gram, own = Landmarks(block).kernel(block), []
        for k in np.flatnonzero(near < ALIKE):
            if not own or gram[k, own].max() < ALIKE:
                own.append(k)
        chosen += [a + int(k) for k in own]
    toxic = [words[k] for k in chosen]
    return toxic, [r.word for r in often if r.word not in toxic]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "toxic", sample: int = SAMPLE) -> Model | float:
    """Learn from texts with a label; a number if only one class (or none) is there.

    The sample is drawn from the labels by a hash of the id, about ``sample`` rows per class,
    so it may be broadcast whatever the size of the tables; texts do not move for it.
    """
    folder = shared_folder(docs.sparkSession)
    marked = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        key, F.col(label).cast("int").alias("y"))
    size = {r.y: r["count"] for r in marked.groupBy("y").count().collect()}
    if len(size) < 2:
        return float(1 in size)
    bits = F.xxhash64(key).bitwiseAND(F.lit((1 << 40) - 1))
    cut = {y: int(min(1.0, sample / n) * (1 << 40)) for y, n in size.items()}
    drawn = marked.filter(bits < F.when(F.col("y") == 1, cut[1]).otherwise(cut[0]))
    texts = docs.filter(F.col(text).isNotNull()).select(key, F.col(text).alias("text"))
    # Each text counts once per label, however many copies of it were drawn.
    picked = texts.join(F.broadcast(drawn), key).select("text", "y").dropDuplicates(["text", "y"])
    picked = saved(picked, folder, "sample")
    size = {r.y: r["count"] for r in picked.groupBy("y").count().collect()}
    if len(size) < 2:
        return float(1 in size)
    toxic, clean = _choose(saved(_word_counts(picked, "text", "y"), folder, "words"), size[1], size[0])
    if not toxic:
        return size[1] / sum(size.values())
    landmarks = Landmarks(toxic + clean)
    known = shipped(docs.sparkSession, landmarks)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known()
        for part, _, _ in text_slices(batches, "text", SLICE, _memo_key(own)):
            found = _matcher(own).matches(part.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(1), pa.array([m.tobytes() for m in found], pa.binary())],
                names=["y", "matches"])
    found = picked.select("text", "y").mapInArrow(describe, "y int, matches binary").collect()
    found.sort(key=lambda r: (r.y, bytes(r.matches)))
    n = len(found)
    x = np.empty((n + VARIANTS * len(toxic), len(landmarks.words)), np.float32)
    for k, r in enumerate(found):
        x[k] = np.frombuffer(r.matches, np.float32)
    y = np.array([1.0 if r.y else -1.0 for r in found])
    del found
    rng = np.random.default_rng(7)
    garbled = [_garbled(w, rng) for w in toxic for _ in range(VARIANTS)]
    hosts = np.flatnonzero(y < 0)[rng.integers(0, size[0], len(garbled))]
    for a in range(0, len(garbled), ROWS):
        np.maximum(x[hosts[a:a + ROWS]], landmarks.kernel(garbled[a:a + ROWS]), out=x[n + a:][:ROWS])
    y = np.append(y, np.ones(len(garbled)))

    own = landmarks.kernel(landmarks.words).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-2))) @ vectors.T
    share = np.ones(len(y))
    share[-len(garbled):] = GARBLED_SHARE * size[1] / len(garbled)
    for a in range(0, len(x), ROWS):
        x[a:a + ROWS] = x[a:a + ROWS] @ root
    weights = _svm(x, y, share)
    slope, shift = _sigmoid(x @ weights[:-1].astype(np.float32) + weights[-1], y, share)
    return Model(landmarks, root, weights[:-1], float(weights[-1]), slope, shift)


def with_toxicity(df: DataFrame, model: Model | float, text: str = "text", out: str = "score",
                  keep: list[str] | None = None) -> DataFrame:
    """Add the score (0 to 1) of every whole text. ``keep`` names the columns to return."""
    names = [c for c in keep or df.columns if c != out]
    if not isinstance(model, Model):
        return df.select(*names, F.lit(float(model)).alias(out))
    known = shipped(df.sparkSession, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known()
        for rows, _, _ in text_slices(batches, text, SLICE, _memo_key(own.landmarks)):
            texts = rows.column(rows.schema.get_field_index(text)).fill_null("").to_pylist()
            found = own.scores(_matcher(own.landmarks).matches(texts))
            columns = [rows.column(rows.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(found.astype(float))],
                                             names=[*names, out])
    schema = T.StructType([f for n in names for f in df.schema.fields if f.name == n]
                          + [T.StructField(out, T.DoubleType())])
    return df.select(*[c for c in df.columns if c in names or c == text]).mapInArrow(score, schema)
