"""Cases that once cost links, groups, languages, memory or time."""

import collections
import random
import subprocess
import sys
import time

import numpy as np
import pytest

import corpus_pipeline
from baitline.llm import jaccard_join, language_id, topk_search
from baitline.llm.common import shingle_sets
from baitline.llm.decontamination import Items, tiles, with_leaks
from baitline.llm.license_scan import known_digests, scan_licenses
from baitline.llm.license_texts import ISC
from baitline.llm.pieces import Coder, load_vocabulary
from baitline.llm.sharding import shard_by_bytes
from test_operators import MODEL


def test_words_beside_a_blankless_stretch_keep_their_hash():
    def sets(*texts):
        raw = [t.encode() for t in texts]
        return shingle_sets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]), 5)
    alone = sets("alpha beta gamma delta epsilon zeta eta")[0]
    near = sets("alpha beta gamma delta epsilon zeta eta", "q" * 1500000, "Eta")
    assert near[0].tolist() == alone.tolist() and near[2].tolist() == sets("eta")[0].tolist()


def test_groups_of_equal_texts_stay_whole(spark):
    rng = random.Random(5)
    texts = ["x" * rng.randint(1, 300) + str(i) for i in range(3000)]
    for n, size in [(40, 900), (25, 1000), (300, 60), (2, 9000)]:
        texts += [f"group {n} " + "y" * size] * n
    giant = "z" * 200
    texts += [giant] * 1500
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    rows = shard_by_bytes(docs, 16).collect()
    assert len(rows) == len(texts)
    where = collections.defaultdict(set)
    for r in rows:
        where[texts[r.doc_id]].add(r.shard)
    assert [t for t, s in where.items() if len(s) > 1] == [giant]
    sizes, target = collections.Counter(), sum(len(t) + 1 for t in texts) / 16
    slots = collections.defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.05 * target


def plain_tiling(item, doc, least):
    """Longest unmarked common run first, by comparing every place with every place."""
    in_item, in_doc, out = [False] * len(item), [False] * len(doc), []
    while True:
        best = None
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while (a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n]
                       and not in_item[a + n] and not in_doc[b + n]):
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return sorted(out)
        out.append(best)
        for k in range(best[2]):
            in_item[best[0] + k] = in_doc[best[1] + k] = True


def test_tiles_equal_plain_tiling_on_random_texts():
    rng = random.Random(9)
    for turn in range(150):
        letters = "ab" if turn % 3 else "abcdef"
        item = [rng.choice(letters) for _ in range(rng.randint(4, 24))]
        doc = [rng.choice(letters) for _ in range(rng.randint(4, 40))]
        seeds = [(a, b) for a in range(len(item) - 3) for b in range(len(doc) - 3) if item[a:a + 4] == doc[b:b + 4]]
        want = plain_tiling(item, doc, 4)
        got = tiles(*(np.array(x, np.int64) for x in zip(*seeds)), 4) if seeds else []
        assert got == want, (item, doc)
        items = Items([1], [" ".join(item)], 4)
        raw = " ".join(doc).encode()
        found = items.leaks(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 4, 0.01)[0]
        assert sorted((t["item_word"], t["n_words"]) for f in found for t in f["tiles"]) == sorted((a, n) for a, _, n in want)


def test_repeated_words_need_little_time_and_memory():
    items = Items([1, 2, 3, 4], ["la " * 500] * 4, 4)
    raw = ("la " * 700_000).encode()
    start = time.time()
    found = items.leaks(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 4, 0.6)[0]
    assert sorted(f["item_id"] for f in found) == [1, 2, 3, 4] and all(f["n_covered"] == 500 for f in found)
    assert time.time() - start < 20


def test_a_text_of_many_paragraphs_is_scanned_in_time(spark):
    parts = [f"Paragraph {i} on the license\nof this work." for i in range(1600)]
    docs = spark.createDataFrame([(1, "\n\n".join(parts)), (2, "\n\n".join(parts[:800] + [ISC.strip()] + parts[800:]))],
                                 "doc_id long, text string")
    start = time.time()
    found = scan_licenses(docs, known_digests(spark)).collect()
    assert [(r.doc_id, r.unit) for r in found] == [(2, "paragraphs")]
    assert time.time() - start < 60


def test_a_language_of_copies_is_learned(spark):
    rng = random.Random(3)
    def prose(letters):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(60))
    rows = [(prose("abcde"), "aa") for _ in range(60)]
    for k in range(6):
        rows += [(prose("uvwxyz"), f"copy{k}")] * 400
    learn = spark.createDataFrame(rows, "text string, lang string")
    model = language_id.fit(learn, sample=50)
    assert {f"copy{k}" for k in range(6)} < set(model.languages)


def test_counts_come_from_prefix_tables():
    coder, texts = Coder(load_vocabulary(MODEL)), ["", "a b", "the cat  sat\n" * 50, "日本 😀", " " * 9]
    coder._recover = None  # no ids are recovered
    assert coder.counts(texts) == [coder.prefix_counts(t)[-1] for t in texts] == coder.counts(texts)


def test_near_duplicates_tell_rows_by_id_and_text(spark):
    rng = random.Random(1)
    def text():
        return " ".join(rng.choice("abcdefghij") + str(rng.randrange(50)) for _ in range(40))
    one, two, three, four = (text() for _ in range(4))
    rows = [(1, one), (5, one + " more"), (5, two), (2, three), (2, three), (None, four), (None, four), (None, one),
            (7, None), (8, ""), (7, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == corpus_pipeline.COLUMNS
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(1, one), (5, two), (2, three), (None, four), (7, None), (8, "")], key=str)


@pytest.mark.parametrize("spread", [2, 1 << 29])
def test_top_k_equals_all_pairs(spark, spread):
    rng = random.Random(spread)
    rows = [(i, [rng.randint(-spread, spread) for _ in range(5)]) for i in range(900)] + [(4, [1, 2]), (950, [0] * 5)]
    table = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(2)
    got = sorted(tuple(r) for r in topk_search.top_k(table, table.filter("vec_id % 30 = 0 OR vec_id = 950"), 4).collect())
    want = []
    for q, v in rows:
        if q % 30 == 0 or q == 950:
            ranked = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, w in rows if i != q)[:4]
            want += [(q, k, i, -s) for k, (s, i) in enumerate(ranked, 1)]
    assert got == sorted(want)


FOREIGN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {folder!r}).getOrCreate())
import __spark_entry__
for name, run in sorted(__spark_entry__.queries().items()):
    if name in {names!r}:
        print(name, run(spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Started from another folder; only the driver's path leads to the package."""
    import os
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    names = ["op2_topk_search", "op3_decontamination", "op4_language_id", "op8_toxicity", "op11_negative_mining",
             "op12_lm_scoring", "op13_importance_resampling"]
    script = FOREIGN.format(root=root, folder=str(tmp_path / "shared"), names=names)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" or root not in v}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert len(done.stdout.splitlines()) == len(names)


def test_items_held_against_documents_as_a_table(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "before " + item + " after"), (2, "la " * 40000), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, "la " * 50)], "item_id long, text string")
    got = {r.doc_id: [x.item_id for x in r.leaks] for r in with_leaks(docs, items).collect()}
    assert got == {1: [1], 2: [2], 3: []}


def test_near_copies_that_meet_in_one_group_link_as_by_brute_force(spark):
    """Many different near copies of one text, some on either side of the threshold."""
    rng = random.Random(11)
    base = [f"w{n}" for n in range(60)]
    texts = []
    for k in range(700):
        words = list(base)
        for _ in range(rng.choice([1, 1, 2])):
            words[rng.randrange(25, 60)] = f"other{rng.randrange(10 ** 6)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    sets = [frozenset(zip(*(t.split()[k:] for k in range(5)))) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i] = root[root[i]]
        return i
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 4 * both >= 3 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == {i: find(i) for i in range(len(sets))}


@pytest.mark.parametrize("seed", range(3))
def test_pairs_of_a_group_hold_all_links_and_a_forest_joins_the_same(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 80, dtype=np.uint64)
    sets = []
    for _ in range(700):
        own = base.copy()
        own[rng.integers(0, 80, rng.integers(0, 14))] = rng.integers(0, 1 << 63, dtype=np.uint64)
        sets.append(np.unique(own))
    label = rng.integers(0, 600, len(sets))
    asks = rng.random(len(sets)) < 0.5
    i, j, weight = jaccard_join._near_in_group(
        np.array([len(s) for s in sets], np.float64), label, asks,
        [jaccard_join.set_bits(s) for s in sets], jaccard_join.SIMILARITY)
    plain = [frozenset(s.tolist()) for s in sets]
    alike = [[len(x & y) / len(x | y) for y in plain[:k]] for k, x in enumerate(plain)]
    links = {(b, a) for a in range(len(sets)) for b in range(a)
             if label[a] != label[b] and (asks[a] or asks[b]) and alike[a][b] >= 0.75}
    pairs = list(zip(i.tolist(), j.tolist()))
    assert links <= set(pairs) and all(w >= alike[b][a] - 1e-9 for (a, b), w in zip(pairs, weight))

    def joined(pairs):
        root = {int(k): int(k) for k in label}

        def find(k):
            while root[k] != k:
                k = root[k]
            return k
        for a, b in pairs:
            root[find(int(label[a]))] = find(int(label[b]))
        groups = collections.defaultdict(set)
        for k in root:
            groups[find(k)].add(k)
        return sorted(map(sorted, groups.values()))
    tree = jaccard_join._forest(i, j, weight, label)
    assert len(tree) < len(set(label.tolist())) and joined(zip(i[tree], j[tree])) == joined(pairs)
