import pytest
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.operators.attachments import score_attachments
from baitline.operators.risk import combine_scores
from baitline.operators.senders import score_senders
from baitline.operators.text import score_text, text_chunks
from baitline.operators.urls import Feeds, score_urls, url_findings, url_parts
from baitline.plans.scoring import score_emails
from helpers import by_id, email, file

REQUEST = {
    "sender_email": "helpdesk@parcel-desk.work", "sender_name": "Amazon Deliveries",
    "subject": "Urgent invoice", "body_text": "Please confirm the invoice before noon",
    "urls": ["http://10.9.8.7/reset", "https://track.parcels.example.click/password"],
    "attachments": [file("label.docx.js")], "page_source": "gmail",
}


def url_score(spark, *urls, feeds=Feeds()):
    row = score_urls(email(spark, {"urls": list(urls)}), feeds).first()
    return row["url_score"], row["url_reasons"]


def test_whole_request(spark):
    row = score_emails(email(spark, REQUEST)).first()
    # Text: urgent, confirm and two of invoice's sentences make 3 * 0.12 and a few capitals.
    got = row["indicators"].asDict()
    assert (got["url"], got["sender"], got["attachment"]) == (46.0, 25.0, 55.0)
    assert 36.0 < got["text"] < 50.0
    weighted = sum(got[i] * fv.WEIGHTS[i] for i in got)
    assert row["risk_score"] == pytest.approx(weighted, abs=0.006) and row["risk_level"] == "medium"
    assert [r.split(":")[0] for r in row["reasons"]][-3:] == [
        "Sender name references Amazon but email domain is parcel-desk.work",
        "Executable-like attachment detected", "Double extension pattern detected"]
    # All reasons are kept unless a limit is given.
    assert score_emails(email(spark, REQUEST), max_reasons=2).first()["reasons"] == row["reasons"][:2]


def test_nothing_found(spark):
    row = score_emails(email(spark, {"subject": "hello", "body_text": "see you"})).first()
    assert row["risk_score"] == 0.0
    assert row["reasons"] == ["No high-confidence phishing indicators were triggered"]
    assert row["recommended_action"].startswith("No major phishing signals")


def test_scoring_needs_no_shuffle(spark):
    plan = score_emails(email(spark, REQUEST))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("url,points", [
    ("http://10.1.2.3/urgent/invoice", 28),
    ("https://docs.example.net/guide/", 0),
    ("https://account-verify-now.top/x", 53),
    ("http://172.16.4.4/urgent/password?reset=9", 28),
    ("https://tinyurl.com/verify-me", 22),
    ("http://185.234.218.12/bank", 55),
    ("shop.example/invoice", 5),
    ("", 5),
    ("https://a.b.c.d.example.org/", 12),
    ("https://xn--pypal-4ve.com/", 18),
    ("https://example.org/" + "a" * 120, 7),
    ("http://[2001:db8::1]/x", 20),
    ("http://[::ffff:1.2.3.4]:80/", 20),
    ("http://[not-an-ip]/x", 5),
    ("http://[v1.a:b]/x", 0),
    ("http://010.0.0.1/", 0),
    ("http://user:login@example.org/", 0),
    ("https://example.org/a;login", 0),
    ("https://example.org/a;b/login;x", 8),
    ("https://example.org/#login", 0),
    ("HTTPS://EXAMPLE.ORG/LOGIN", 8),
    ("https://sub.EXAMPLE-phish.com/", 35),
    ("//example.top/x", 10),
    ("mailto:someone@example.top", 5),
    ("https://xample.org:8080/?q=reset", 8),
    ("news:a;login", 5),
])
def test_url_points(spark, url, points):
    assert url_score(spark, url)[0] == points


def test_url_reason_order_and_total(spark):
    score, reasons = url_score(spark, "http://45.10.120.7/pay", "http://x.y.z.account-verify-now.top/")
    assert score == 100.0
    assert [r.split(":")[0] for r in reasons] == [
        "IP reputation feed flagged URL host", "URL uses an IP address instead of a domain",
        "Domain reputation feed flagged URL host", "URL has excessive subdomains",
        "Suspicious keyword found in URL", "Uncommon TLD found in URL"]


def test_longest_parent_wins(spark):
    feeds = Feeds(domains=["b.example.com", "example.com"], ips=[])
    assert url_score(spark, "https://a.b.example.com/", feeds=feeds)[1] == [
        "Domain reputation feed flagged URL host: b.example.com"]


def test_long_feeds_give_the_same_findings(spark, monkeypatch):
    from baitline.operators import urls as op
    from baitline.plans import scale
    mails = email(spark, {"urls": ["https://a.b.example.com/", "http://9.9.9.9/", "x"]},
                  {"urls": []}, {"urls": ["https://b.example.com/q", "https://ok.org"]})
    domains = spark.createDataFrame([("b.example.com",), ("example.com",)], "domain string")
    ips = spark.createDataFrame([("9.9.9.9",)], "ip string")
    feeds = Feeds(domains, ips)
    short = sorted(map(str, url_findings(mails, feeds).collect()))
    monkeypatch.setattr(op, "LITERAL_ROWS", 0)
    assert sorted(map(str, url_findings(mails, feeds).collect())) == short
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 0)
    assert sorted(map(str, url_findings(mails, feeds).collect())) == short
    assert len(short) == 5


def test_url_parts(spark):
    rows = spark.createDataFrame([
        ("https://U:p@Example.org:81/a/b;c?x=1#f",), (" http://a_b.org\t/x",), ("ftp://h",),
        ("javascript:alert(1)",), ("http://exa mple.com/p",)], "url string")
    got = {r["url"]: (r["host"], r["path"], r["query"]) for r in url_parts(rows).collect()}
    assert got["https://U:p@Example.org:81/a/b;c?x=1#f"] == ("example.org", "/a/b", "x=1")
    assert got[" http://a_b.org\t/x"] == ("a_b.org", "/x", "")
    assert got["ftp://h"] == ("h", "", "")
    assert got["javascript:alert(1)"] == ("", "alert(1)", "")
    assert got["http://exa mple.com/p"] == ("exa mple.com", "/p", "")


def test_urls_agree_with_the_standard_library(spark):
    import ipaddress
    import itertools
    from urllib.parse import urlparse
    pieces = [["http:", "HTTPS:", "", "ftp:", "a1+:", "1a:"], ["//", "/", ""],
              ["host.org", "u@h@1.2.3.4", "h:80", "[::1]", "[fe80::1%25]:9", "", "a..b", "256.1.1.1"],
              ["", "/p;x/q;y", ";z", "/é?"], ["", "?a=b?c", "#f?g", "?q#r"]]
    urls = ["".join(p) for p in itertools.product(*pieces)]
    rows = {r["url"]: r for r in url_parts(spark.createDataFrame(
        [(u,) for u in urls], "url string")).collect()}
    for u in urls:
        p = urlparse(u)
        host = (p.hostname or "").lower()
        try:
            ipaddress.ip_address(host)
            is_ip = True
        except ValueError:
            is_ip = False
        assert (rows[u]["host"], rows[u]["is_ip"]) == (host, is_ip), u
        assert (rows[u]["path"], rows[u]["query"]) == (p.path, p.query), u


@pytest.mark.parametrize("files,points", [
    ([file("bill.xls.exe")], 55), ([], 0), ([file("a.docm")], 18), ([file("a.zip")], 12),
    ([file("x.tar.js"), file("a.zip")], 67), ([file("README", "")], 0),
    ([file("A.PDF.EXE", ".EXE.")], 55), ([file("a.b.exe", "txt")], 25),
    ([file("a.exe"), file("b.exe"), file("c.exe"), file("d.exe")], 100),
])
def test_attachment_points(spark, files, points):
    row = score_attachments(email(spark, {"attachments": files})).first()
    assert row["attachment_score"] == points
    assert row["attachment_count"] == len(files)


@pytest.mark.parametrize("address,name,points", [
    ("a@gmail.com", "Microsoft", 31), ("not-an-address", "PayPal", 100), ("a@", "x", 100),
    ("a@b1234.org", None, 8), ("a@paypal.com", "PayPal", 0), ("a@x.org", "Your Bank", 0),
    ("a@b@Hotmail.com ", "", 6), ("a@x.org", "google apple amazon paypal microsoft", 100),
])
def test_sender_points(spark, address, name, points):
    row = score_senders(email(spark, {"sender_email": address, "sender_name": name})).first()
    assert row["sender_score"] == points


def brute_force_text(text, aggregation="mean"):
    """Brute force, character by character."""
    words = ["urgent", "verify", "login", "reset", "suspended", "click below", "confirm",
             "invoice", "password", "account"]
    values = []
    for start in range(0, len(text), 900):
        c = text[start:start + 1200]
        caps = len([x for x in c if x.isupper()])
        values.append(min(1.0, 0.12 * len([w for w in words if w in c.lower()])
                          + 1.5 * caps / len(c) + min(0.2, 0.01 * c.count("!"))))
    if not values:
        return 0.0, 0
    total = max(values) if aggregation == "max" else sum(values) / len(values)
    return round(total * 100, 2), len(values)


@pytest.mark.parametrize("aggregation", ["mean", "max"])
def test_text_against_brute_force(spark, data, aggregation):
    docs = spark.read.parquet(f"{data}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("email_id"), F.lit("Reset  it!").alias("subject"),
        F.concat(F.lit("VERIFY Password ÄÖ "), "text").alias("body_text"))
    got = {r["email_id"]: (r["text_score"], r["chunk_count"])
           for r in score_text(docs, aggregation).collect()}
    for r in docs.collect():
        want = brute_force_text(f"{r['subject']}\n{r['body_text']}".strip(), aggregation)
        assert got[r["email_id"]][1] == want[1]
        assert got[r["email_id"]][0] == pytest.approx(want[0], abs=0.011)


def test_empty_text_and_tail_chunk(spark):
    df = email(spark, {"subject": " ", "body_text": "\n"}, {"body_text": "x" * 901},
               {"body_text": "x" * 900})
    scored = score_text(df)
    assert by_id(scored, "chunk_count") == {"0": 0, "1": 2, "2": 1}
    assert by_id(scored, "text_reasons")["0"] == ["No text content found"]
    assert by_id(scored, "text_mode") == {"0": None, "1": "heuristic", "2": "heuristic"}
    assert sorted(len(r["chunk"]) for r in text_chunks(df).collect()) == [1, 900, 901]


def indicator(spark, score, *reasons):
    return spark.createDataFrame([("m", float(score), list(reasons))],
                                 "email_id string, score double, reasons array<string>")


def test_weighted_levels(spark):
    given = [(88, "words"), (96, "links"), (64, "who"), (72, "files")]
    weights = [fv.WEIGHTS[i] for i in ("text", "url", "sender", "attachment")]
    high = combine_scores(*[indicator(spark, n, said) for n, said in given]).first()
    assert high["risk_score"] == round(sum(n * w for (n, _), w in zip(given, weights)), 2)
    assert high["risk_level"] == "high" and high["reasons"] == [said for _, said in given]
    low = combine_scores(*[indicator(spark, n) for n in (8, 4, 0, 12)]).first()
    assert low["risk_score"] == round(sum(n * w for n, w in zip((8, 4, 0, 12), weights)), 2)
    assert low["risk_level"] == "low"


def test_equal_keys_are_refused(spark):
    twice = indicator(spark, 8, "a").union(indicator(spark, 9, "b"))
    none = indicator(spark, 0).filter("false")
    with pytest.raises(Exception, match="not unique"):
        combine_scores(twice, none, none, none).collect()


def test_missing_indicator_counts_zero_and_all_reasons_stay(spark):
    none = indicator(spark, 0).filter("false")
    row = combine_scores(indicator(spark, 100, *"abcde"), indicator(spark, 100, *"fghij"),
                         none, none).first()
    assert row["risk_score"] == 65.0 and row["reasons"] == list("abcdefghij")


def test_result_does_not_depend_on_partitions(spark, data):
    from baitline.workload import views
    mails = views.emails(spark, data)
    one = sorted(map(str, score_emails(mails.repartition(1)).collect()))
    assert sorted(map(str, score_emails(mails.repartition(13)).collect())) == one


def test_expected_indicators_of_the_mail_view(spark, data):
    from baitline.workload import views
    rows = {r["email_id"]: r["indicators"] for r in
            score_emails(views.emails(spark, data).filter("email_id < 9")).collect()}
    want = [(46, 25, 55), (14, 31, 18), (100, 0, 67), (28, 50, 0), (18, 8, 0), (79, 100, 0),
            (60, 25, 55), (25, 0, 18), (0, 50, 67)]
    assert [(rows[i]["url"], rows[i]["sender"], rows[i]["attachment"]) for i in range(9)] == want
