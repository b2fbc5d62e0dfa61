import csv
import glob
import json
import math
from email.message import EmailMessage

import pytest
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.operators.datasets import (
    benign_emails, benign_urls, build_training_set, build_url_testset, url_lines,
)
from baitline.operators.features import (
    class_weights, hand_features, ngram_vocabulary, training_text, with_class_weight,
)
from baitline.operators.metrics import binary_metrics
from baitline.operators.sampling import balanced_head, seeded_sample, shuffle_rows, stratified_split
from baitline.operators.urls import score_url_table
from baitline.plans.scoring import score_emails, url_benchmark
from baitline.sources import readers, writers
from helpers import email


def write(path, text, encoding="utf-8"):
    data = text if isinstance(text, bytes) else text.encode(encoding)
    path.write_bytes(data)
    return str(path)


TRAINING = '''sender_email,sender_name,subject,body_text,urls,attachments,label
desk@parcels.work,Parcel Desk,Invoice overdue,"Urgent: your parcel is held, reset the password of the locker.","http://10.9.8.7/pay;https://parcels.work/a","label.docx.js",1
prizes@lucky.click,Lucky Draw,You have won,"Verify who you are to collect the prize.","https://lucky.click/go","rules.zip",1
choir@village.example,Village Choir,Rehearsal on Monday,"Bring the blue folder, please.","https://village.example/plan","",0
garden@plants.example,Garden Club,Seeds to swap,"Tomatoes and beans this time.","https://plants.example/list","",0
'''


def test_hand_features_of_training_csv(spark, tmp_path):
    df = readers.read_training_csv(spark, write(tmp_path / "t.csv", TRAINING))
    got = {r["sender_email"].split("@")[0]: [r["keyword_hits"], r["has_ip_url"], r["url_count"],
                                             r["has_free_sender"]]
           for r in hand_features(df).collect()}
    assert got == {"desk": [4, 1, 2, 0], "prizes": [1, 0, 1, 0], "choir": [0, 0, 1, 0],
                   "garden": [0, 0, 1, 0]}


def test_training_csv_columns(spark, tmp_path):
    with pytest.raises(ValueError, match=r"Missing required columns: \['label', 'subject'\]"):
        readers.read_training_csv(spark, write(tmp_path / "a.csv", "body_text\nx\n"))
    path = write(tmp_path / "b.csv", 'subject,body_text,label\n" a, ""b""","line\nbreak",1\n,x,0\n')
    rows = readers.read_training_csv(spark, path).orderBy("label").collect()
    assert [r["text"] for r in rows] == ["x", 'a, "b" line\nbreak']
    assert (rows[1]["urls"], rows[1]["sender_email"], rows[1]["label"]) == ("", "", 1)
    tagged = readers.read_training_csv(spark, path, "tagged").orderBy("label").first()
    assert tagged["text"] == "[SENDER]  [SUBJECT]  [BODY] x [URLS]  [ATTACHMENTS] "


def message(plain=None, html=None, files=(), sender="Ann <Ann@X.org>", subject="Hi  there"):
    m = EmailMessage()
    m["From"], m["Subject"] = sender, subject
    if plain is not None:
        m.set_content(plain)
    if html is not None:
        m.add_alternative(html, subtype="html") if plain is not None else m.set_content(
            html, subtype="html")
    for name, data in files:
        m.add_attachment(data, maintype="application", subtype="octet-stream", filename=name)
    return m.as_bytes()


def test_mail_archive(spark, tmp_path):
    many = " ".join(f"http://u{i:02d}.org" for i in range(30))
    mails = {
        "a.eml": message("Go  to https://b.org/x now", '<p>or <a href="HTTP://A.org">this</a></p>',
                         [("z.exe", b"1"), ("a.zip", b"2"), ("z.exe", b"3")]),
        "b.eml": message(html="<p>only</p>\n<b>html</b> https://c.org<br>"),
        "c.eml": message("  \n"),
        "d.eml": message(many),
        "e.eml": b"From: BIG@EXAMPLE.COM\r\nSubject: x\r\nContent-Type: text/plain;"
                 b" charset=no-such\r\n\r\ncaf\xe9 https://d.org\r\n",
        "f.eml": b"From: a@b.org\r\nContent-Type: application/octet-stream\r\n\r\nraw https://e.org",
        "g.txt": b"not a mail",
    }
    for name, data in mails.items():
        write(tmp_path / name, data)
    rows = {r["path"].rsplit("/", 1)[-1]: r for r in
            readers.read_mail_archive(spark, str(tmp_path), None).collect()}
    assert sorted(rows) == ["a.eml", "b.eml", "c.eml", "d.eml", "e.eml", "f.eml"]
    a = rows["a.eml"]
    assert (a["sender_email"], a["subject"], a["label"]) == ("ann@x.org", "Hi there", 1)
    assert a["body_text"] == "Go to https://b.org/x now"
    assert a["urls"] == "HTTP://A.org;https://b.org/x" and a["attachments"] == "a.zip;z.exe"
    assert rows["b.eml"]["body_text"] == "only html https://c.org"
    assert rows["b.eml"]["urls"] == "https://c.org"
    assert rows["c.eml"]["body_text"] == "(empty body)"
    assert rows["d.eml"]["urls"].count(";") == 29
    assert rows["e.eml"]["sender_email"] == "big@example.com"
    assert rows["f.eml"]["urls"] == "https://e.org"
    first = readers.read_mail_archive(spark, str(tmp_path), 2)
    assert sorted(r["path"].rsplit("/", 1)[-1] for r in first.collect()) == ["a.eml", "b.eml"]


def test_url_lines_and_feeds(spark, tmp_path):
    path = write(tmp_path / "u.txt", b" http://a.org \n\n\thttp://b.org\nhttp://a.org\nx\xffy\n")
    assert sorted(r[0] for r in readers.read_url_lines(spark, path).collect()) == [
        "http://a.org", "http://b.org", "xy"]
    feed = write(tmp_path / "f.txt", " A.com, b.net\n\nc.org,,a.com ")
    got = readers.read_reputation_feed(spark, feed)
    assert sorted(r[0] for r in got.collect()) == ["a.com", "b.net", "c.org"]
    empty = readers.read_reputation_feed(spark, write(tmp_path / "e.txt", " , \n"), "ip")
    assert sorted(r[0] for r in empty.collect()) == sorted(fv.DEFAULT_BAD_IPS)
    policy = readers.read_domain_policy(spark, write(tmp_path / "l.txt", " A.org ,, b.org"), feed)
    assert sorted(map(tuple, policy.collect())) == [
        ("a.com", "block"), ("a.org", "allow"), ("b.net", "block"), ("b.org", "allow"),
        ("c.org", "block")]


def test_benign_urls(spark):
    got = {r["id"]: r["url"] for r in benign_urls(spark.range(401)).collect()}
    for i in got:
        protocol = "https" if i % 5 else "http"
        assert got[i] == (f"{protocol}://www.{fv.SAFE_DOMAINS[i % 20]}"
                          f"{fv.SAFE_PATHS[i // 20 % 10]}")
    assert len(set(got.values())) == 200


def test_benign_emails_are_stable_and_varied(spark):
    once = sorted(map(str, benign_emails(spark.range(500)).collect()))
    again = sorted(map(str, benign_emails(spark.range(500).repartition(7)).collect()))
    assert once == again
    df = benign_emails(spark.range(500))
    assert df.select("subject", "body_text").distinct().count() == 25
    assert df.select("sender_email", "sender_name").distinct().count() == 5
    assert {r["label"] for r in df.collect()} == {0}


def test_training_set_ratio(spark):
    mail = benign_emails(spark.range(7)).withColumn("label", F.lit(1))
    assert build_training_set(spark, mail, 1.5).count() == 17
    assert build_training_set(spark, mail, -1.0).count() == 7


def test_url_testset_and_benchmark(spark):
    lines = url_lines(spark.createDataFrame(
        [(f"http://10.0.0.{i % 50}/login/{i % 60}",) for i in range(300)], "value string"))
    testset = build_url_testset(lines, 100, 40)
    assert {r["y_true"]: r["count"] for r in testset.groupBy("y_true").count().collect()} == {
        1: 100, 0: 40}
    row = url_benchmark(lines, 100, 40, threshold=20.0).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (1.0, 1.0, 1.0, 1.0)


def test_predictions_round_trip(spark, tmp_path):
    urls = spark.createDataFrame([("http://10.0.0.1/login?a=\"x\",y", 1), ("https://a.org", 0),
                                  ("http://45.10.120.7/", 0)], "url string, y_true int")
    writers.write_url_testset(urls, str(tmp_path / "set"))
    back = readers.read_labelled_urls(spark, str(tmp_path / "set"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, urls.collect()))
    scored = score_url_table(back)
    writers.write_url_predictions(scored, str(tmp_path / "pred"))
    pairs = readers.read_predictions(spark, str(tmp_path / "pred"))
    assert sorted(map(tuple, pairs.collect())) == [(0, 0), (0, 1), (1, 0)]
    writers.write_eval_template(urls, str(tmp_path / "template"))
    lines = [line for f in glob.glob(f"{tmp_path}/template/*.csv")
             for line in csv.reader(open(f))]
    assert ["url", "y_true", "y_pred"] in lines and ["https://a.org", "0", ""] in lines


def test_training_round_trip(spark, tmp_path):
    df = readers.read_training_csv(spark, write(tmp_path / "t.csv", TRAINING))
    writers.write_training_csv(df, str(tmp_path / "out"))
    back = readers.read_training_csv(spark, str(tmp_path / "out"))
    assert sorted(map(str, back.select(sorted(df.columns)).collect())) == sorted(
        map(str, df.select(sorted(df.columns)).collect()))


def test_verdict_and_metric_sinks(spark, tmp_path):
    verdicts = score_emails(email(spark, {"body_text": "login"}, {"sender_email": "x"}))
    writers.write_verdicts(verdicts, str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v")).count() == 2
    writers.write_metrics_json(binary_metrics(spark.createDataFrame(
        [(1, 1), (0, 1)], "y_true int, y_pred int")), str(tmp_path / "m"))
    text = open(glob.glob(f"{tmp_path}/m/*.json")[0]).read()
    assert json.loads(text) == {"accuracy": 0.5, "precision": 0.5, "recall": 1.0, "f1": 0.6667}


def test_no_positives_give_zero(spark):
    row = binary_metrics(spark.createDataFrame([(0, 0), (1, 0)], "y_true int, y_pred int")).first()
    assert row.asDict() == {"accuracy": 0.5, "precision": 0.0, "recall": 0.0, "f1": 0.0}
    empty = binary_metrics(spark.createDataFrame([], "y_true int, y_pred int")).first()
    assert set(empty.asDict().values()) == {0.0}


def test_sample_is_exact_and_seeded(spark, monkeypatch):
    from baitline.operators import sampling
    df = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("url"))
    small = sorted(r[0] for r in seeded_sample(df, 700).collect())
    monkeypatch.setattr(sampling, "TOP_N_ROWS", 10)
    large = sorted(r[0] for r in seeded_sample(df.repartition(5), 700).collect())
    assert small == large and len(set(small)) == 700
    assert sorted(r[0] for r in seeded_sample(df, 700, seed=7).collect()) != small
    assert seeded_sample(df, 10 ** 6).count() == 3000
    assert [r[0] for r in shuffle_rows(df, "url").limit(5).collect()] != [f"u{i}" for i in range(5)]


def test_split_keeps_class_shares(spark):
    df = spark.range(1003).withColumn("label", (F.col("id") % 5 == 0).cast("int"))
    parts = {(r["label"], r["part"]): r["count"]
             for r in stratified_split(df).groupBy("label", "part").count().collect()}
    assert parts == {(1, "validation"): math.ceil(201 * 0.2), (1, "train"): 201 - 41,
                     (0, "validation"): math.ceil(802 * 0.2), (0, "train"): 802 - 161}
    again = stratified_split(df.repartition(3))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, stratified_split(df).collect()))


def test_copies_of_a_key_stay_together(spark):
    df = spark.range(400).select(F.when(F.col("id") < 150, 7).otherwise(F.col("id")).alias("id"),
                                 F.lit(1).alias("label"))
    parts = stratified_split(df).groupBy("part").count().collect()
    assert sum(r["count"] for r in parts) == 400
    of_copies = stratified_split(df).filter("id = 7").select("part").distinct().collect()
    assert len(of_copies) == 1


def test_wide_rows_are_not_shuffled_by_a_split(spark):
    df = spark.range(100).withColumn("label", (F.col("id") % 2).cast("int")).withColumn(
        "body", F.concat(F.lit("wide"), "id"))
    plan = stratified_split(df)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange" in line and "body" in line]
    assert wide == [] and "SortMergeJoin" not in plan


def test_balanced_head(spark):
    df = spark.range(100).withColumn("label", (F.col("id") >= 90).cast("int"))
    got = sorted(r["id"] for r in balanced_head(df.repartition(4), 20).collect())
    assert got == list(range(20)) + list(range(90, 100))


def test_class_weights(spark):
    df = spark.range(10).withColumn("label", (F.col("id") < 2).cast("int"))
    got = {r["label"]: r["weight"] for r in class_weights(df).collect()}
    assert got == {1: 10 / 4, 0: 10 / 16}
    assert with_class_weight(df).agg(F.sum("weight")).first()[0] == pytest.approx(10)


def test_vocabulary_against_brute_force(spark):
    from collections import Counter
    texts = ["The cat_1 sat the cat", "a b", "", "Ünï cat the", "the", "x yz"]
    uses, docs = Counter(), Counter()
    for t in texts:
        import re
        words = re.findall(r"\b\w\w+\b", t.lower())
        terms = words + [" ".join(p) for p in zip(words, words[1:])]
        uses.update(terms)
        docs.update(set(terms))
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [(r["term"], r["n_uses"], r["n_docs"]) for r in ngram_vocabulary(df, 8).collect()]
    assert got == [(t, n, docs[t]) for t, n in sorted(uses.items(), key=lambda x: (-x[1], x[0]))[:8]]


def test_tagged_text(spark):
    df = spark.createDataFrame([(" a ", None, "b", "u", "")],
                               "sender_email string, subject string, body_text string, urls string,"
                               " attachments string")
    assert training_text(df, "tagged").first()["text"] == (
        "[SENDER] a [SUBJECT]  [BODY] b [URLS] u [ATTACHMENTS] ")
    assert training_text(df).first()["text"] == "b"


@pytest.mark.parametrize("size", [4, 30, 1 << 18])
def test_vocabulary_by_summaries_equals_a_full_count(spark, size):
    """Small summaries lose counts and are made again until they can tell."""
    import collections
    import random
    from baitline.operators.heavy_hitters import candidates, summarise

    rng = random.Random(8)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += [None, "", "Zz zz ZZ", "w1 " * 500]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(6)
    words = [t.lower().split() if t else [] for t in texts]
    grams = [w + [" ".join(p) for p in zip(w, w[1:])] for w in words]
    uses = collections.Counter(g for gs in grams for g in gs)
    docs = collections.Counter(g for gs in grams for g in set(gs))
    want = sorted(((-n, t) for t, n in uses.items()))[:25]
    got = ngram_vocabulary(df, 25, summary=size).collect()
    assert [(-r.n_uses, r.term) for r in got] == want
    assert all(r.n_docs == docs[r.term] for r in got)
    ids = df.select(F.transform(F.split(F.coalesce("text", F.lit("")), " "), lambda w: F.xxhash64(w)).alias("ids"))
    lost = summarise(ids, "ids", 4).filter("value IS NULL").agg(F.sum("n")).first()[0]
    assert lost > 0
    even = spark.range(3000).select(F.array("id").alias("ids"))
    assert candidates(even, "ids", 10) is None
    assert len(candidates(even, "ids", 3000)) == 3000
