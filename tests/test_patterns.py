"""Pattern tables, long feeds and tables published together."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from baitline.operators import patterns as pt
from baitline.operators.patterns import find_patterns, pattern_counts
from baitline.operators.urls import Feeds, match_reputation, occurring_entries, score_urls
from baitline.plans.bloom import Bloom
from baitline.sources import writers
from helpers import email


@pytest.mark.parametrize("part_rows", [200_000, 7])
def test_patterns_equal_containment(spark, part_rows):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(40))) for _ in range(300)] + [None, "", "abc" * 5000]
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(60)] + [None, "", "a", "a"]
    held = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string")
    table = spark.createDataFrame([(w, i % 3) for i, w in enumerate(words)], "pattern string, rank int")
    got = sorted(tuple(r) for r in find_patterns(held, table, "k", part_rows=part_rows).collect())
    rows = {(w, i % 3) for i, w in enumerate(words) if w}
    want = sorted((i, w, r) for i, t in enumerate(texts) for w, r in rows if t and w in t)
    assert got == want
    counts = {r.k: r.n_patterns for r in pattern_counts(held, table, "k").collect()}
    assert counts == {i: n for i, t in enumerate(texts) if (n := len({w for w, _ in rows if t and w in t}))}
    assert find_patterns(held, table.limit(0), "k").count() == 0
    with pytest.raises(ValueError, match="share the column"):
        find_patterns(held, table.withColumn("k", F.lit(1)), "k")


def test_bloom_holds_all_its_values_and_few_others(spark):
    table = spark.range(60_000).select(F.concat(F.lit("v"), "id").alias("v")).union(
        spark.createDataFrame([(None,)], "v string"))
    seen = Bloom(table, "v", 60_000)
    assert seen.blocks == 2
    others = spark.range(100_000).select(F.when(F.col("id") > 0, F.concat(F.lit("w"), "id")).alias("v"))
    assert table.filter(seen.may_hold(F.col("v"))).count() == 60_000
    assert others.filter(seen.may_hold(F.col("v"))).count() < 3_000


def test_long_feed_equals_short_one(spark):
    """One URL in a third of the mails, null lists and null URLs, a feed of which little occurs."""
    rows = [{"urls": [f"http://a{i}.bad{i % 40}.org/x", None] if i % 3 else ["http://www.hot.example/login"]}
            for i in range(900)] + [{"urls": None}, {"urls": []}, {"urls": [None]}]
    mails = email(spark, *rows)
    bad = [f"bad{i}.org" for i in range(0, 40, 3)] + ["hot.example"]
    long = spark.range(5_000).select(F.concat(F.lit("n"), "id", F.lit(".example")).alias("domain")).union(
        spark.createDataFrame([(b,) for b in bad] + [(None,)], "domain string"))
    columns = ["email_id", "url_score", "url_reasons"]
    want = sorted(map(str, score_urls(mails, Feeds(domains=bad)).select(columns).collect()))
    assert sorted(map(str, score_urls(mails, Feeds(domains=long)).select(columns).collect())) == want
    urls = mails.select(F.explode("urls").alias("url")).filter("url IS NOT NULL")
    short = spark.createDataFrame([(b,) for b in bad], "domain string")
    assert sorted(map(str, match_reputation(urls, Feeds(domains=long)).collect())) == sorted(
        map(str, match_reputation(urls, Feeds(domains=short)).collect()))


def test_only_occurring_entries_are_shuffled(spark):
    listed = spark.range(20_000).select(F.concat(F.lit("domain:"), "id").alias("entry"))
    candidates = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, F.lit("domain:7")).otherwise(
        F.concat(F.lit("domain:x"), "id")).alias("entry"))
    found = occurring_entries(candidates, listed)
    assert [r.entry for r in found.collect()] == ["domain:7"]


def test_many_occurring_entries_take_the_join(spark):
    rows = [{"urls": [f"http://b{i}.org/x"]} for i in range(1500)]
    bad = [f"b{i}.org" for i in range(1200)]
    long = spark.createDataFrame([(b,) for b in bad], "domain string")
    got = score_urls(email(spark, *rows), Feeds(domains=long))
    assert got.filter("url_score >= 35").count() == 1200 and got.count() == 1500


def test_tables_are_published_together_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "out")
    one = spark.createDataFrame([(1,)], "a int")
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("int").alias("a"))
    with pytest.raises(FileNotFoundError):
        writers.read_published(spark, path, "verdicts")
    with pytest.raises(Exception, match="lost"):
        writers.publish_verdicts(one, broken, path)
    with pytest.raises(FileNotFoundError):
        writers.read_published(spark, path, "verdicts")
    assert writers.publish_verdicts(one, one.limit(0), path) == 1
    with pytest.raises(Exception, match="lost"):
        writers.publish_verdicts(one.union(one), broken, path)
    assert writers.read_published(spark, path, "verdicts").count() == 1
    assert writers.publish_verdicts(one.union(one), one, path) == 2
    assert [writers.read_published(spark, path, t).count() for t in ("verdicts", "rejected")] == [2, 1]
    assert writers.read_published(spark, path, "verdicts", 1).count() == 1
    assert len(list((tmp_path / "out" / "versions").iterdir())) == 2


def test_hits_of_many_texts_are_handed_on_as_they_come():
    words = [f"w{i:03d}" for i in range(1000)]
    table = pa.table({"pattern": words})
    batch = pa.RecordBatch.from_pydict({"k": list(range(500)), "text": [" ".join(words)] * 499 + [None]})
    found = list(pt._hits(iter([batch]), table, pt._automaton(words), "k"))
    assert sum(b.num_rows for b in found) == 499 * 1000
    assert max(b.num_rows for b in found) < pt.HELD_HITS + 1000
    assert sorted({(r["k"], r["pattern"]) for b in found for r in b.to_pylist()}) == [(k, w) for k in range(499) for w in words]
