"""Operators on small tables against brute force, and on odd rows."""

import hashlib
import itertools
import random
import re
import textwrap
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from baitline.llm import jaccard_join, language_id, topk_search, toxicity
from baitline.llm.decontamination import tiles, with_leaks
from baitline.llm.jaccard_join import jaccard_components
from baitline.llm.license_scan import known_digests, scan_licenses
from baitline.llm.license_texts import ISC, KNOWN, MIT
from baitline.llm.line_dedup import drop_repeated_lines
from baitline.llm.pieces import Coder, load_vocabulary
from baitline.llm.sentencepiece_codec import with_decoded, with_ids, with_ids_and_decoded
from baitline.llm.sharding import shard_by_bytes
from baitline.llm.token_counts import with_prefix_answers, with_token_count

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "a", "\n", "▁ ▁", "日本 😀 x", "x" * 5000, "  two  blanks ", "<s> </s> <0x0A>",
       "same", "same", "été ß\t\x00", " " * 40, "a b " * 3000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def table(spark, texts, schema="doc_id long, text string, ids string, n_tokens int"):
    return spark.createDataFrame([(i, t, "old", -1) for i, t in enumerate(texts)], schema)


def by_id(df, key="doc_id"):
    rows = df.collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out


# SentencePiece and token counts

def test_coder_equals_library_on_random_texts(library):
    coder, rng = Coder(load_vocabulary(MODEL)), random.Random(3)
    signs = list("  ▁abcdefghinorstu ,.!ñéß\n\t012") + ["  ", "   ", "日", "😀", "\x00", "the", "ing", "<0x0A>"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [" " * n + "word" for n in range(40)] + ["x" * n for n in range(40)]
    for text, ids in zip(texts, coder.encode(texts)):
        own = np.frombuffer(ids, np.int32).tolist()
        assert own == library.encode(text), repr(text)
        assert coder.decode(own) == library.decode(own), repr(text)
    for text in texts[:150]:
        assert coder.prefix_counts(text) == [len(library.encode(text[:i])) for i in range(len(text) + 1)]


def test_memo_limits_change_nothing(library, monkeypatch):
    import baitline.llm.pieces as pieces
    monkeypatch.setattr(pieces, "MEMO_RUNS", 3)
    monkeypatch.setattr(pieces, "MEMO_PAIRS", 5)
    coder = Coder(load_vocabulary(MODEL))
    for _ in range(2):
        for text in ["one two three four", "three four five", "", "one six"]:
            assert np.frombuffer(coder.encode([text])[0], np.int32).tolist() == library.encode(text)


def test_ids_and_decoded_of_odd_texts(spark, library):
    df = with_ids_and_decoded(table(spark, ODD), MODEL)
    got = by_id(df)
    for i, text in enumerate(ODD):
        want = library.encode(text or "")
        assert got[i].ids == want and got[i].decoded == library.decode(want)
    assert df.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    again = by_id(with_decoded(with_ids(table(spark, ODD), MODEL), MODEL))
    assert {i: r.decoded for i, r in again.items()} == {i: r.decoded for i, r in got.items()}
    assert with_ids(table(spark, []), MODEL).count() == 0
    lists = spark.createDataFrame([(0, None), (1, [1, None, 264])], "doc_id long, ids array<int>")
    assert {i: r.decoded for i, r in by_id(with_decoded(lists, MODEL)).items()} == {0: "", 1: "a"}


def test_counts_and_budgets(spark, library):
    got = by_id(with_token_count(table(spark, ODD), MODEL))
    assert {i: r.n_tokens for i, r in got.items()} == {
        i: len(library.encode(t or "")) for i, t in enumerate(ODD)}
    texts = ["hello wide world", None, "a  b"]
    rows = by_id(with_prefix_answers(table(spark, texts), MODEL, lengths=[-1, 4, 99, None], budgets=[-1, 0, 2, None]))
    for i, text in enumerate(t or "" for t in texts):
        count = [len(library.encode(text[:n])) for n in range(len(text) + 1)]
        assert rows[i].tokens_at == [0, count[min(4, len(text))], count[-1], None]
        assert rows[i].chars_within == [0, max(n for n, c in enumerate(count) if c <= 0),
                                        max(n for n, c in enumerate(count) if c <= 2), None]


# line dedup

def dedup_by_hand(rows, least=10):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    owner = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            if len(k) >= least:
                owner[k] = min(owner.get(k, doc), doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if owner.get(key(x), doc) >= doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_line_dedup_equals_brute_force(spark, batches):
    rng = random.Random(batches)
    pool = ["A shared line of text", "  a SHARED line of text\t", "É shared line of text", "short", "",
            "another line, repeated", "x" * 400] + [f"line number {n} of some text" for n in range(60)]
    rows = [(i * 3, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "hot line of many rows\n" * 300), (1003, "hot line of many rows")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n_lines int")
    got = drop_repeated_lines(df, batches=batches)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()) == dedup_by_hand(rows)


def test_line_dedup_of_odd_rows(spark):
    line = "a line that is long enough"
    df = spark.createDataFrame([(2, line), (2, line), (2, "x\n" + line), (1, line), (None, line), (None, None)],
                               "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, r.n_dropped) for r in drop_repeated_lines(df).collect())
    assert got == [(False, 1, 1, 0), (False, 2, 1, 1), (False, 2, 1, 1), (False, 2, 2, 1),
                   (True, 0, 1, 0), (True, 0, 1, 1)]
    assert drop_repeated_lines(df.limit(0)).count() == 0


# Jaccard join

def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components_by_hand(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("seed", range(3))
def test_jaccard_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(400)]
    rows = []
    for base in range(30):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 6, 7, 9, 12, 20, 45, 200, 700]))]
        for _ in range(rng.randint(1, 7)):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, len(text) // 40])):
                at = rng.randrange(len(copy) + 1)
                copy[at:at + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 1)
            rows.append(" ".join(copy).upper() if rng.random() < .2 else "\t ".join(copy))
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(n)) for n in (0, 1, 4, 9, 13, 17, 40)]
    rows = list(enumerate(rows + ["", None, " \n", "one", "ONE", "two words"]))
    got = by_id(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == components_by_hand(rows)


def test_jaccard_asks_for_enough_segments():
    for size in [*range(1, 80), 300, 5000]:
        band = next(b for b in jaccard_join.bands_up_to(size * 2, jaccard_join.SIMILARITY) if b.low <= size <= b.high)
        rng = np.random.default_rng(size)
        elements = np.sort(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        full, count, segment, inner = jaccard_join.band_entries(elements, band)
        need = jaccard_join.needed(size, jaccard_join.SIMILARITY)
        m = len(full)
        asked, double = jaccard_join._asked(np.zeros(m, np.int64), np.ones(m), count > 0,
                                            np.full(m, need), np.full(m, band.has_neighbours))
        assert count.sum() == size and len(inner) in (0, size)
        assert asked.sum() + double.sum() >= need


def test_jaccard_of_odd_rows(spark):
    df = spark.createDataFrame([(3, "a b c d e f"), (1, "a b c d e f"), (3, "a b c d e f"), (3, "x y"),
                                (None, "a b c d e f"), (None, None)], "doc_id long, text string")
    got = jaccard_components(df).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [
        (0, 0, 0), (0, 2, 0), (1, 2, 1), (3, 1, 3), (3, 2, 1), (3, 2, 1)]
    assert jaccard_components(df.limit(0)).count() == 0


# decontamination

def test_tiles_are_greedy_and_do_not_overlap():
    # item 0..9; the text holds words 5..9, then 0..4: two tiles.
    i = np.array([5, 6, 0, 1])
    j = np.array([0, 1, 5, 6])
    assert tiles(i, j, 4) == [(0, 5, 5), (5, 0, 5)]
    # The longer run takes the words they share.
    assert tiles(np.array([0, 1, 2, 2]), np.array([0, 1, 2, 30]), 4) == [(0, 0, 6)]


def test_leaks_of_moved_passages(spark):
    rng = random.Random(5)

    def text(n):
        return " ".join(f"word{rng.randrange(10 ** 6)}" for _ in range(n))
    item, other = text(40), text(30)
    a, b = item.split()[:20], item.split()[20:]
    rows = [(1, text(50) + " " + item.upper() + "! " + text(10)), (2, text(5) + " " + " ".join(b + a) + " " + text(9)),
            (3, " ".join(a[:15]) + " " + text(80)), (4, text(500)), (5, None), (6, ""), (7, "... !"),
            (8, ", ".join(item.split()) + "\n" + other), (8, item), (9, text(20_000) + " " + item)]
    docs = spark.createDataFrame([(i, t, "old") for i, t in rows], "doc_id long, text string, leaks string")
    bench = spark.createDataFrame([(7, item), (9, other), (10, None), (None, item), (11, "too short"), (12, "")],
                                  "item_id long, text string")
    got = with_leaks(docs, bench)
    assert got.columns == ["doc_id", "text", "leaks"] and got.count() == len(rows)
    found = sorted((r.doc_id, leak.item_id) for r in got.collect() for leak in r.leaks)
    assert found == [(1, 7), (2, 7), (8, 7), (8, 7), (8, 9), (9, 7)]
    for r in got.filter("doc_id IN (1, 2)").collect():
        raw = r.text.encode()
        spans = [raw[t.from_byte:t.to_byte].decode().lower() for t in r.leaks[0].tiles]
        assert sum(len(s.split()) for s in spans) == r.leaks[0].n_covered == 40
    assert with_leaks(docs, bench.limit(0)).filter("size(leaks) > 0").count() == 0
    assert with_leaks(docs.limit(0), bench, keep=["doc_id"]).columns == ["doc_id", "leaks"]


def test_leaks_over_several_blocks(spark, monkeypatch):
    import baitline.llm.decontamination as module
    rng = random.Random(6)
    items = [(n, " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(12))) for n in range(20)]
    docs = spark.createDataFrame([(n, "before " + t + " after") for n, t in items], "doc_id long, text string")
    monkeypatch.setattr(module, "BLOCK_TEXT", 500)
    got = with_leaks(docs, spark.createDataFrame(items, "item_id long, text string"), keep=["doc_id"])
    assert {r.doc_id: [leak.item_id for leak in r.leaks] for r in got.collect()} == {n: [n] for n, _ in items}


def test_leaks_of_short_items_and_other_scripts(spark):
    items = [(1, "Blue Moon"), (2, "今日は天気がいいですね"), (3, "l’été dernier à l’école normale"), (4, "!!"), (5, "ÉTÉ")]
    docs = [(1, "once in a blue  moon, a blue moon"), (2, "前文。今日は天気がいいですね、と言った"),
            (3, "L'ÉTÉ DERNIER “À L'ÉCOLE NORMALE”"), (4, "blue and moon!!"), (5, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = with_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: sorted(k.item_id for k in r.leaks) for r in rows} == {1: [1], 2: [2], 3: [3, 5], 4: [], 5: []}
    for r in rows:
        for k in r.leaks:
            if k.item_id in (1, 2):
                tile = k.tiles[0]
                found = r.text.encode()[tile.from_byte:tile.to_byte].decode()
                assert found == {1: "blue  moon", 2: "今日は天気がいいですね"}[k.item_id]


# language identification

def test_language_of_held_out_rows(spark, data):
    docs = spark.read.parquet(data.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "text", "lang")
    learn = language_id.learnable(F.col("doc_id"), 4, 2)
    model = language_id.fit(docs.filter(learn))
    got = language_id.with_language(docs, model).filter(~learn)
    assert got.filter("lang = lang_pred").count() / got.count() > 0.98
    assert got.filter("rejected").count() == 0
    assert got.filter("score < 0 OR score > 1").count() == 0
    remainder = {r.doc_id: r.r for r in docs.select("doc_id", learn.alias("r")).collect()}
    assert all(kept == (zlib.crc32(str(i).encode()) % 4 != 2) for i, kept in remainder.items())
    odd = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, " 12 - 34 !", 0), (4, "A.", 0), (5, "да", 0),
                                 (6, "ﬀ字" * 200, 0), (6, "the and " * 50_000, 0)], "doc_id long, text string, score int")
    rows = language_id.with_language(odd, model).collect()
    assert [r.lang_pred == "und" for r in rows] == [True, True, True, False, False, False, False]
    assert [r.rejected for r in rows] == [True, True, True, False, False, True, False]
    assert [r.score for r in rows][:3] == [0.0] * 3


@pytest.mark.parametrize("out", ["de", "es", "fr", "en"])
def test_unknown_language_of_the_same_script_is_rejected(spark, data, out):
    docs = spark.read.parquet(data.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "text", "lang")
    learn = language_id.learnable(F.col("doc_id"), 4, 2)
    model = language_id.fit(docs.filter(learn & (F.col("lang") != out)))
    rows = language_id.with_language(docs.filter(~learn), model).collect()
    unknown = [r.rejected for r in rows if r.lang == out]
    known = [r.rejected for r in rows if r.lang != out]
    assert np.mean(unknown) > 0.9 and np.mean(known) < 0.02
    assert all(f > 0 for f in model.floors[3:])  # texts from 8 trigrams on are judged


def test_language_without_anything_learned(spark):
    empty = spark.createDataFrame([("x", None)], "text string, lang string")
    rows = language_id.with_language(spark.createDataFrame([("word",), ("1",)], "text string"),
                                     language_id.fit(empty)).collect()
    assert [(r.lang_pred, r.rejected) for r in rows] == [("und", False), ("und", True)]
    assert language_id.with_language(empty.limit(0), language_id.fit(empty.limit(0))).count() == 0


# top-k search

def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    for n, width, spread in [(300, 8, 3), (2000, 24, 100), (7, 3, 2)]:
        vectors = rng.integers(-spread, spread + 1, (n, width))
        df = spark.createDataFrame([(i, [int(x) for x in v]) for i, v in enumerate(vectors)],
                                   "vec_id long, vector array<long>").repartition(3)
        got = topk_search.top_k(df, df.filter("vec_id % 50 = 0"), 5)
        want = set()
        for q in range(0, n, 50):
            order = sorted((-int(vectors[q] @ v), i) for i, v in enumerate(vectors) if i != q)[:5]
            want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(order)}
        assert {tuple(r) for r in got.collect()} == want


def test_top_k_of_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [float("nan"), 1.0]), (2, None), (3, [1.0, None]), (4, [1.0]), (5, [0.5, 1.0, 9.0]),
            (5, [0.5, 1.0, 9.0]), (6, []), (None, [1.0, 1.0]), (7, [float("inf"), 0.0]), (8, [-0.001, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").filter(topk_search.usable(F.col("embedding")))
    df = df.select("vec_id", topk_search.quantised(F.col("embedding")).alias("vector"))
    got = topk_search.top_k(df, df.filter("vec_id = 0"), 3).collect()
    assert [tuple(r) for r in sorted(got, key=lambda r: r["rank"])] == [
        (0, 1, 5, 256 * 128 + 512 * 256), (0, 2, 5, 256 * 128 + 512 * 256), (0, 3, 4, 256 * 256)]
    assert topk_search.top_k(df.limit(0), df.limit(0), 3).count() == 0
    blocks = topk_search.top_k(df, df, 2, block=1)
    assert {tuple(r) for r in blocks.collect()} == {tuple(r) for r in topk_search.top_k(df, df, 2).collect()}


# sharding

def check_shards(rows, texts, shards, slack):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    bytes_ = [sum(r.size for r in by_shard.get(s, [])) for s in range(shards)]
    assert max(bytes_) - min(bytes_) <= slack
    return by_shard


def test_shards_are_even_and_gapless(spark, monkeypatch):
    import baitline.llm.sharding as module
    monkeypatch.setattr(module, "RANGE_ROWS", 50)
    rng = random.Random(8)
    texts = [(i, "é" * rng.randint(0, 50)) for i in range(3000)] + [(9000 + i, "hot copy of a text") for i in range(1500)]
    texts += [(8000, None), (8001, ""), (8001, "twice"), (8001, "twice"), (8002, "y" * 300)]
    df = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, shard string")
    got = shard_by_bytes(df, 16)
    assert got.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    check_shards(got.collect(), texts, 16, slack=700)


def test_shards_of_few_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert shard_by_bytes(df, 16).count() == 2
    assert shard_by_bytes(df.limit(0), 16).count() == 0


# toxicity

def test_toxicity_of_gapped_insults(spark):
    rng = random.Random(9)
    plain = [f"{a}{b}{c}" for a in ("ta", "lo", "ri", "men") for b in ("ka", "so", "du") for c in ("", "ne", "lim")]

    def text(n):
        return " ".join(rng.choice(plain) for _ in range(n))
    rows = [(text(rng.randint(3, 30)), 0) for _ in range(240)]
    rows += [(f"{text(5)} {rng.choice(['blockhead', 'numbskull'])} {text(rng.randint(1, 20))}", 1) for _ in range(60)]
    rows += [(None, 1), ("", 0), ("blockhead", None), ("blockhead", 7)]
    numbered = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, toxic int")
    model = toxicity.fit(numbered.drop("toxic"), numbered.drop("text"))
    probes = ["blockhead", "you BLOCKHEAD!", "b l o c k h e a d", "bl0ckhead", "block-head", "blockxhead", "numb.skull",
              text(40), "", None, "x" * 500, text(3000)]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(probes)], "doc_id long, text string, score string")
    got = by_id(toxicity.with_toxicity(df, model))
    assert [got[i].score >= 0.5 for i in range(len(probes))] == [True] * 7 + [False] * 5
    assert all(0 <= r.score <= 1 for r in got.values())
    assert toxicity.with_toxicity(df.limit(0), model).count() == 0
    one = numbered.filter("toxic = 1").limit(1)
    assert toxicity.fit(one.drop("toxic"), one.drop("text")) == 1.0
    assert toxicity.fit(one.drop("toxic"), one.drop("text").limit(0)) == 0.0
    assert toxicity.with_toxicity(df, 0.0, keep=["doc_id"]).agg(F.max("score")).first()[0] == 0.0


def test_every_sure_marker_is_a_landmark(spark, monkeypatch):
    rng = random.Random(3)
    markers = sorted({"".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(9)) for _ in range(100)})
    rows = [(w, 40, 0) for w in markers] + [("and", 2000, 8000), ("the", 1500, 6000)]
    counts = spark.createDataFrame(rows, "word string, toxic long, clean long")
    for block in [toxicity.BLOCK, 7]:
        monkeypatch.setattr(toxicity, "BLOCK", block)
        toxic, clean = toxicity._choose(counts, 4000, 16000)
        assert toxic == markers and clean[:2] == ["and", "the"]


def test_kernel_equals_plain_definition():
    def plain(a, b):
        def weights(w):
            out = {}
            w = toxicity.START + w
            for i, j, k in itertools.combinations(range(len(w)), 3):
                if k - i <= toxicity.SPAN:
                    key = w[i] + w[j] + w[k]
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
            return out
        x, y = weights(a), weights(b)
        dot = sum(v * y.get(k, 0) for k, v in x.items())
        return (dot / (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** .5) ** toxicity.SHARPNESS
    landmarks = toxicity.Landmarks(["moron", "lololo"])
    words_ = ["moron", "moxron", "lolo", "abc", "éàü"]
    got = landmarks.kernel(words_)
    assert np.allclose(got, [[plain(w, m) for m in landmarks.words] for w in words_], atol=1e-5)


def test_remembered_matches_equal_the_kernel(monkeypatch):
    rng = random.Random(4)
    words_ = ["".join(rng.choice("abcdeo") for _ in range(rng.randint(3, 40))) for _ in range(300)]
    landmarks = toxicity.Landmarks(sorted({w for w in words_[:40] if len(w) <= toxicity.WINDOW}))
    texts = [" ".join(rng.sample(words_, k)) for k in (1, 5, 80, 300)] + ["", "ab"]
    want = [landmarks.kernel(sorted(toxicity.plain_words(t, {}))).max(0, initial=0) for t in texts]
    for memo in (toxicity.MEMO_WORDS, 50):
        monkeypatch.setattr(toxicity, "MEMO_WORDS", memo)
        matcher = toxicity.Matcher(landmarks)
        for _ in range(2):
            got = np.concatenate([matcher.matches([t]) for t in texts])
            assert np.allclose(got, want, atol=1 / toxicity.STEPS)


# licences

def test_license_spellings_and_copyright_lines(spark):
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + MIT.upper().replace(",", " ;")), (2, ISC.replace("\n", "   ")),
            (3, "Some text\n  Licenced under the MIT Licence \nmore text"), (4, "a permission slip"), (5, None), (6, ""),
            (7, MIT + " and more"), (8, "SPDX-License-Identifier: MIT"), (8, "SPDX-License-Identifier: MIT")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, license string")
    got = {(r.doc_id, r.unit, r.license, r.n) for r in scan_licenses(df, known_digests(spark)).collect()}
    assert got == {(1, "document", "MIT", 1), (2, "document", "ISC", 1), (2, "line", "ISC", 1), (3, "line", "MIT", 1),
                   (8, "document", "MIT", 1), (8, "line", "MIT", 1)}
    with pytest.raises(ValueError):
        known_digests(spark, [("none", "free for all")])


def test_license_files_and_texts_inside_documents(spark):
    apache, gpl = (next(t for n, t in KNOWN if n == name) for name in ("Apache-2.0", "GPL-3.0"))
    bsd = next(t for n, t in KNOWN if n == "BSD-3-Clause")
    wrapped = "\n".join(textwrap.wrap(MIT, 70)).replace(" copyright notice", "\ncopyright notice")
    rows = [(1, f"MIT License\n\nCopyright (c) 2020 Someone\nAll rights reserved.\n\n{MIT}"), (2, apache), (3, gpl),
            (4, "BSD 3-Clause License\n\nCopyright 2021 A\n\n" + bsd.replace("\n", "\n\n")), (5, wrapped),
            (6, "Some prose.\n\n" + MIT.replace("\n", "\n\n") + "\n\nMore prose."),
            (7, "Prose.\n\nLicensed under the\nMIT License.\n\nProse.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.unit, r.license) for r in scan_licenses(df, known_digests(spark)).collect()}
    assert {(1, "document", "MIT"), (2, "document", "Apache-2.0"), (3, "document", "GPL-3.0"),
            (4, "document", "BSD-3-Clause"), (5, "document", "MIT"), (6, "paragraphs", "MIT"),
            (7, "paragraphs", "MIT")} <= got


def test_digest_columns(spark, data):
    import __spark_entry__ as entry
    got = by_id(entry.queries()["op5_sentencepiece"](spark, data))
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in spark.read.parquet(f"{data}/documents.parquet").collect():
        ids = own.encode(r.text or "")
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(own.decode(ids).encode()).hexdigest()
        assert got[r.doc_id].n_tokens == len(ids)
