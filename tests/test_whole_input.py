"""Nothing is cut by default, and a result does not depend on the size of a side table."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from baitline.operators.models import load_model, score_text_with_fn
from baitline.operators.pages import pages_to_emails
from baitline.operators.urls import Feeds, score_url_table, score_urls
from baitline.plans.scoring import score_emails
from baitline.plans.scale import shared_folder
from baitline.sources import readers
from helpers import email


def test_text_behind_a_long_harmless_part_counts(spark):
    harmless = "nothing to see " * 3000
    plain = score_emails(email(spark, {"body_text": harmless}), aggregation="max").first()
    hidden = score_emails(email(spark, {"body_text": harmless + "urgent verify login reset suspended"}),
                          aggregation="max").first()
    assert hidden["indicators"]["text"] > plain["indicators"]["text"] + 40
    cut = score_emails(email(spark, {"body_text": harmless + "urgent verify login"}), aggregation="max",
                       body_chars=20_000).first()
    assert cut["indicators"] == plain["indicators"]


def test_page_text_and_links_are_whole(spark):
    html = "<body>" + "word " * 6000 + "".join(f'<a href="/p{n}">x</a>' for n in range(200)) + "</body>"
    page = spark.createDataFrame([(1, "https://a.example/", html)], "page_id long, url string, html string")
    row = pages_to_emails(page).first()
    assert len(row["body_text"]) > 30_000 - 1 and len(row["urls"]) == 201
    row = pages_to_emails(page, max_chars=100, max_links=7).first()
    assert len(row["body_text"]) == 100 and len(row["urls"]) == 7


@pytest.mark.parametrize("part", ["<!--", "<script>", "<a ", "<", "<head ", "<title>", "<b ", "<a href='"])
def test_pages_of_unclosed_parts_take_linear_time(spark, part):
    html = part * ((1 << 20) // len(part))
    page = spark.createDataFrame([(1, "https://a.example/", html)], "page_id long, url string, html string")
    start = time.time()
    pages_to_emails(page).collect()
    assert time.time() - start < 5


def test_long_feed_equals_short_feed(spark):
    rows = [{"email_id": None if n % 3 else str(n), "urls": ["http://bad.example.org/x", f"http://h{n % 7}.example/"]}
            for n in range(60)] + [{"email_id": None, "urls": ["http://fine.example/"]}, {"email_id": "z", "urls": []}]
    mails = email(spark, *rows)
    short = Feeds(domains=["example.org"], ips=[])
    long = Feeds(domains=spark.range(1500).select(F.concat(F.lit("no"), "id", F.lit(".example")).alias("domain")).union(
        spark.createDataFrame([("example.org",)], "domain string")), ips=[])

    def scores(feeds):
        return sorted((r["email_id"] or "", r["url_score"], r["url_reasons"]) for r in score_urls(mails, feeds).collect())
    assert scores(long) == scores(short) and len(scores(long)) == 62
    urls = spark.createDataFrame([("http://bad.example.org/x", 1)] * 40 + [("http://fine.example/", 0)], "url string, y_true int")
    assert sorted(map(tuple, score_url_table(urls, 20.0, long).collect())) == sorted(
        map(tuple, score_url_table(urls, 20.0, short).collect()))


def test_every_copy_of_a_mail_is_scored_once(spark):
    body = "some text of a mail " * 150
    mails = email(spark, {"email_id": "a", "body_text": body}, {"email_id": "a", "body_text": body},
                  {"email_id": "a", "body_text": "short"}, {"email_id": None, "body_text": ""})

    def make():
        return lambda texts: np.array([[len(t) / 1000.0] for t in texts])
    got = sorted((r["email_id"] or "", r["chunk_count"]) for r in score_text_with_fn(mails, make).collect())
    assert got == [("", 0), ("a", 1), ("a", 4), ("a", 4)]


def test_columns_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("y_true,url\n1,http://a.example/\n")
    assert [tuple(r) for r in readers.read_labelled_urls(spark, str(tmp_path)).collect()] == [("http://a.example/", 1)]
    (tmp_path / "b.csv").write_text("url,y_true\nhttp://b.example/,0\n")
    with pytest.raises(Exception):
        readers.read_labelled_urls(spark, str(tmp_path)).collect()


def test_a_broken_model_is_an_error(spark, tmp_path):
    assert load_model(None) is None and load_model(str(tmp_path / "none")) is None
    (tmp_path / "model").mkdir()
    with pytest.raises(Exception):
        load_model(str(tmp_path / "model"))


def test_shared_folder_is_where_the_cluster_says(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_rows_without_a_label_are_refused(spark):
    from baitline.operators.features import with_class_weight
    from baitline.operators.sampling import stratified_split
    rows = spark.createDataFrame([(n, 1 if n % 2 else None) for n in range(50)], "id long, label int")
    for job in (with_class_weight, stratified_split):
        with pytest.raises(ValueError, match="without a label"):
            job(rows).collect()


def test_capture_filter_reaches_the_scan(spark, tmp_path):
    from baitline.operators.captures import capture_filter
    email(spark, {"subject": "a", "body_text": "b"}).write.parquet(str(tmp_path / "captures"))
    plan = capture_filter(spark.read.parquet(str(tmp_path / "captures")))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Filter" in plan
