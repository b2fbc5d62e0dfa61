import json

from baitline.operators.intake import check_emails, normalize_emails, validate_emails
from baitline.operators.text import clean_emails
from baitline.operators.urls import dedupe_urls
from baitline.functions.strings import clean_text
from helpers import email
from pyspark.sql import functions as F

GOOD = {"sender_email": " a@b.org ", "sender_name": " A ", "subject": "s", "body_text": "b",
        "urls": ["https://x.org"],
        "attachments": [{"filename": "a.EXE", "extension": ".EXE", "size_kb": 3, "mime_type": "m"}],
        "page_source": 5}
OBJECT = "Payload must be a JSON object"
CASES = [
    ("not json", [OBJECT]), ("", [OBJECT]), (None, [OBJECT]), ("[1]", [OBJECT]), ("null", [OBJECT]),
    ("{}", [f"Missing required field: {f}" for f in
            ("sender_email", "subject", "body_text", "urls", "attachments")]),
    ({"urls": None, "sender_email": 4}, ["Missing required field: subject",
                                         "Missing required field: body_text",
                                         "Missing required field: attachments"]),
    ({**GOOD}, []),
    ({**GOOD, "sender_email": "\t "}, ["sender_email must be a non-empty string"]),
    ({**GOOD, "sender_email": None}, ["sender_email must be a non-empty string"]),
    ({**GOOD, "sender_name": None}, []),
    ({**GOOD, "sender_name": 1}, ["sender_name must be a string when provided"]),
    ({**GOOD, "subject": None, "body_text": ["x"]},
     ["subject must be a string", "body_text must be a string"]),
    ({**GOOD, "urls": ["a", None]}, ["urls must be a list of strings"]),
    ({**GOOD, "urls": "a"}, ["urls must be a list of strings"]),
    ({**GOOD, "urls": []}, []),
    ({**GOOD, "attachments": {}}, ["attachments must be a list"]),
    ({**GOOD, "attachments": []}, []),
    ({**GOOD, "attachments": [3, {"filename": 1, "extension": "x", "size_kb": "9"}]},
     ["attachments[0] must be an object", "attachments[1].filename must be a string",
      "attachments[1].size_kb must be numeric", "attachments[1].mime_type must be a string"]),
    ({**GOOD, "attachments": [{**GOOD["attachments"][0], "size_kb": True}]}, []),
    ({**GOOD, "attachments": [{**GOOD["attachments"][0], "size_kb": None}]},
     ["attachments[0].size_kb must be numeric"]),
]


def raw(spark, *texts):
    rows = [(str(i), t if t is None or isinstance(t, str) else json.dumps(t))
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "email_id string, raw string")


def test_every_complaint(spark):
    got = {r["email_id"]: r["errors"] for r in check_emails(raw(spark, *[c for c, _ in CASES])).collect()}
    for i, (case, want) in enumerate(CASES):
        assert got[str(i)] == want, case


def test_split_and_normalise(spark):
    good, bad = validate_emails(raw(spark, GOOD, "x"))
    assert [r["email_id"] for r in bad.collect()] == ["1"]
    row = normalize_emails(good).first()
    assert (row["sender_email"], row["sender_name"], row["page_source"]) == ("a@b.org", "A", None)
    assert row["urls"] == ["https://x.org"]
    assert row["attachments"][0].asDict() == {
        "filename": "a.EXE", "extension": "exe", "size_kb": 3.0, "mime_type": "m"}


def test_an_id_is_made_from_the_text(spark):
    texts = raw(spark, GOOD, GOOD, "x").drop("email_id")
    ids = [r["email_id"] for r in check_emails(texts).collect()]
    assert len(set(ids)) == 2 and all(len(i) == 64 for i in ids)


def test_clean_text_matches_unicode_rules(spark):
    import re
    samples = [None, "", "  a \t\n b  ", "x  y\x1cz\x85w　", "﻿a​b ",
               "a" * 500, "a " * 200, "é  ü\v\f", "\x00a\x1b b"]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = {r["i"]: r["c"] for r in rows.select("i", clean_text(F.col("s"), 300).alias("c")).collect()}
    for i, s in enumerate(samples):
        assert got[i] == re.sub(r"\s+", " ", s or "").strip()[:300]


def test_clean_limits_and_whole(spark):
    df = email(spark, {"subject": "s" * 400, "body_text": "b" * 30000})
    row = clean_emails(df, 300, 20000).first()
    assert (len(row["subject"]), len(row["body_text"])) == (300, 20000)
    whole = clean_emails(df).first()
    assert (len(whole["subject"]), len(whole["body_text"])) == (400, 30000)


def test_urls_keep_first_seen_order(spark):
    df = email(spark, {"urls": [" b ", "a", "", "b", None, "  ", "a", "c"]})
    assert dedupe_urls(df).first()["urls"] == ["b", "a", "c"]
