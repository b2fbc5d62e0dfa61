"""Importance resampling against a plain version."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import xxhash

from baitline.llm.importance_resampling import intern, resample, xxhash64

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = WORD.findall(raw)
    runs = [b" ".join(words[k:k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r) % 10000 for r in runs]


def plain(docs, target, percent=5):
    own = [(key, *features(text)) for key, text in docs]
    corpus = collections.Counter(b for _, _, f in own for b in f)
    wanted = collections.Counter(b for text in target for b in features(text)[1])
    s, t = sum(corpus.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s + 10000) / ((corpus[b] + 1) * (t + 10000))))
            for b in corpus}
    out, able = [], []
    for k, (key, n_words, found) in enumerate(own):
        weight, score = sum(gain[b] for b in found), None
        if key is not None:
            h = int(hashlib.sha256(f"42:{key}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n_words >= 20:
                able.append((-score, key, k))
        out.append([key, len(found), weight, score, None])
    for rank, (_, _, k) in enumerate(sorted(able)[:percent * len(able) // 100], 1):
        out[k][4] = rank
    return out


def test_vectorised_keys_equal_the_library():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(3000)) + b"\0" * 8
    lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)).copy()
    length = np.array([*range(300)] + [rng.randrange(600) for _ in range(500)])
    start = np.array([rng.randrange(2400) for _ in length])
    keys = xxhash64(data, lanes, start, length)
    assert keys.tolist() == [xxhash.xxh64_intdigest(data[s:s + n]) for s, n in zip(start, length)]


def test_equal_keys_of_different_bytes_stay_apart():
    data = b"aaaabbbbaaaaccccbbbb" + b"\0" * 8
    lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)).copy()
    start, length = np.arange(0, 20, 4), np.full(5, 4)
    slot, owner = intern(data, lanes, start, length, np.zeros(5, np.uint64))
    assert slot[0] == slot[2] and slot[1] == slot[4] and len(set(slot.tolist())) == 3
    assert (owner >= 0).sum() == 3


def test_equals_the_plain_version(spark):
    rng = random.Random(7)
    def prose(n):
        return " ".join(f"w{rng.randrange(40)}" for _ in range(n))
    texts = [prose(rng.choice([0, 5, 19, 20, 21, 200])) for _ in range(120)]
    texts += [None, "", "  ", "été ÉTÉ Ünder 日本 " * 10, "a" * 700 + " b " + "c" * 300 + " d " * 30, prose(60000),
              "q" * 300000 + " end of it " * 10, "a\x00b\x7fC,x-y_z 1.2 " * 5]
    texts += [prose(30)] * 60
    docs = list(enumerate(texts)) + [(None, prose(40)), (3, texts[3]), (3, texts[3])]
    target = [prose(30), None, "", "w1 w2 w3 w4 " * 9]
    table = spark.createDataFrame([(k, t, "x", 5) for k, t in docs], "doc_id long, text string, score string, key int")
    found = resample(table.repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), percent=20)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = collections.Counter(tuple(r) for r in found.collect())
    want = collections.Counter(tuple(r) for r in plain(docs, target, 20))
    assert got == want
    drawn = [r[4] for r in got if r[4]]
    assert sorted(drawn) == list(range(1, len(drawn) + 1)) and drawn


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample(none, none).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [tuple(r)[:3] for r in resample(one, none).collect()] == [(1, 3, 3 * math.floor(1000 * math.log(10003 / 20000)))]
