import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from baitline.operators.alerts import (
    alert_rows, badge, latest_analysis, suppress_repeat_alerts,
)
from baitline.operators.captures import (
    capture_filter, debounce, drop_consecutive_duplicates, fingerprint,
)
from baitline.operators.pages import mail_view_to_emails, pages_to_emails
from baitline.operators.policy import manual_verdict, with_policy
from baitline.operators.senders import brand_mismatch, claimed_brands, extract_sender
from baitline.plans import scale
from baitline.plans.scoring import score_emails
from helpers import by_id, email, file


@pytest.fixture(scope="module")
def policy(spark):
    return spark.createDataFrame([("x.org", "allow"), ("x.org", "block"), ("y.org", "allow"),
                                  ("", "block")], "domain string, action string")


MAILS = [{"sender_email": "a@X.org", "subject": "Login"}, {"sender_email": "a@y.org",
          "subject": "Login", "attachments": [file("a.exe")]},
         {"sender_email": "a@sub.y.org", "attachments": [file("a.exe")]}, {"sender_email": "none"}]


def test_policy_verdicts(spark, policy):
    rows = {r["email_id"]: r for r in score_emails(email(spark, *MAILS), policy=policy).collect()}
    assert (rows["0"]["risk_score"], rows["0"]["risk_level"]) == (100.0, "high")
    assert rows["0"]["reasons"] == ["x.org is blocklisted. Treat this as highly suspicious."]
    assert rows["0"]["indicators"].asDict() == {"text": 0, "url": 0, "sender": 100, "attachment": 0}
    assert rows["1"]["reasons"] == ["y.org is allow-listed. Analysis skipped."]
    assert rows["1"]["recommended_action"] == "Sender is trusted by your local allow-list."
    assert rows["2"]["indicators"]["attachment"] == 30.0
    assert rows["3"]["indicators"]["sender"] == 100.0


def test_long_policy_joins_the_same(spark, policy, monkeypatch):
    small = sorted(map(str, score_emails(email(spark, *MAILS), policy=policy).collect()))
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 0)
    salted = score_emails(email(spark, *MAILS), policy=policy)
    assert sorted(map(str, salted.collect())) == small


def test_manual_answer_has_no_indicators_for_listed_mail(spark, policy):
    scored = score_emails(email(spark, *MAILS), keep=("sender_email",))
    rows = by_id(manual_verdict(with_policy(scored, policy)), "indicators")
    assert rows["0"] is None and rows["1"] is None and rows["2"] is not None


def test_brand_table_agrees_with_brand_list(spark, monkeypatch):
    from baitline import fixed_values as fv
    names = ["PayPal Google", "apple", "Bank", None, "amazon.com Amazon", "microsoft"]
    domains = ["paypal.com", "x.org", "google.com.evil.net", "apple.com"]
    df = email(spark, *[{"sender_name": n, "sender_email": f"a@{d}"}
                        for n, d in itertools.product(names, domains)])
    table = spark.createDataFrame([(i, b, b.title(), d) for i, (b, d) in enumerate(fv.BRANDS)],
                                  "ord int, brand string, title string, expected_domain string")
    want = sorted((r["email_id"], r["title"]) for r in brand_mismatch(df).collect())
    got = sorted((r["email_id"], r["title"]) for r in claimed_brands(df, table).collect())
    assert got == want and len(got) > 10


@pytest.mark.parametrize("header,address,name", [
    ('"PayPal" <Alerts@PayPal.com>', "alerts@paypal.com", "PayPal\" <Alerts@PayPal.com"),
    ("Team <a@b.org>", "a@b.org", "Team"), ("a@b.org", "a@b.org", ""), ("nobody", "", "nobody"),
    ("", "", ""), (None, "", ""),
])
def test_extract_sender(spark, header, address, name):
    row = extract_sender(spark.createDataFrame([(header,)], "from_header string")).first()
    assert (row["sender_email"], row["sender_name"]) == (address, name)


def verdict(spark, **more):
    base = {"email_id": "1", "risk_score": 68.0, "risk_level": "medium", "reasons": ["why"],
            "subject": "", "sender_name": None, "sender_email": None, "page_source": "webpage"}
    row = {**base, **more}
    return spark.createDataFrame([tuple(row.values())], (
        "email_id string, risk_score double, risk_level string, reasons array<string>,"
        " subject string, sender_name string, sender_email string, page_source string"))


def test_alert_text(spark):
    row = alert_rows(verdict(spark)).first()
    assert row["title"] == "MEDIUM phishing risk detected"
    assert row["message"] == "Current page\nScore: 68\nwhy"
    assert (row["priority"], row["sticky"]) == (1, False)
    high = alert_rows(verdict(spark, risk_level="high", risk_score=64.75, reasons=[],
                              sender_name="S")).first()
    assert high["message"] == "S\nScore: 64.75\nPotential phishing indicators detected."
    assert (high["priority"], high["sticky"]) == (2, True)
    assert len(alert_rows(verdict(spark, subject="x" * 900)).first()["message"]) == 500
    assert alert_rows(verdict(spark, risk_level="low")).count() == 0
    assert alert_rows(verdict(spark, page_source="gmail")).count() == 0


def test_badges(spark):
    got = [badge(verdict(spark, risk_level=x)).first()["badge_text"] for x in
           ("high", "medium", "low")]
    assert got == ["HIGH", "MED", "LOW"]


def test_fingerprint(spark):
    import base64
    df = email(spark, {"sender_email": "ä@b.org", "subject": "s" * 80, "body_text": "b" * 500,
                       "urls": ["u", "v"]}, {"sender_email": "a", "subject": "s", "urls": ["u", "v"]})
    got = by_id(fingerprint(df), "fingerprint")
    whole = "||".join(["ä@b.org", "s" * 80, "b" * 400, "u|v"])
    assert got["0"] == base64.b64encode(whole.encode()).decode()[:120]
    assert got["1"] == base64.b64encode(b"a||s||||u|v").decode()


def test_capture_filter(spark):
    full = {"sender_email": "a", "subject": "s", "body_text": "b" * 80, "page_source": "webpage"}
    df = email(spark, full, {**full, "body_text": "b" * 79}, {**full, "subject": ""},
               {**full, "page_source": "gmail", "body_text": "b"}, {**full, "body_text": ""})
    assert {r["email_id"] for r in capture_filter(df).collect()} == {"0", "3"}


def visits(spark, n=400, hot=0.5, nulls=True, seed=3):
    """Random visits in which one tab holds half of the rows."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 3, 30, 22)
    rows = []
    for i in range(n):
        tab = 1 if rng.random() < hot else rng.randrange(2, 6)
        tab = None if nulls and rng.random() < 0.1 else tab
        at = start + dt.timedelta(seconds=rng.choice([0, 30, 60]) + 120 * rng.randrange(600))
        rows.append((tab, at, i, rng.choice("ab"), rng.choice(["medium", "high"])))
    return rows, spark.createDataFrame(
        rows, "tab int, ts timestamp, seq int, fingerprint string, risk_level string")


def by_tab(rows):
    tabs = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        tabs.setdefault(r[0], []).append(r)
    return tabs


@pytest.mark.parametrize("slice_seconds", [60, 3600, 10 ** 9])
def test_changes_against_brute_force(spark, slice_seconds):
    rows, df = visits(spark, nulls=False)
    want = set()
    for held in by_tab(rows).values():
        last = None
        for r in held:
            if r[3] != last:
                want.add(r[2])
            last = r[3]
    got = drop_consecutive_duplicates(df, slice_seconds=slice_seconds)
    assert sorted(r["seq"] for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("slice_seconds", [60, 3600])
def test_alert_repeats_against_brute_force(spark, slice_seconds):
    rows, df = visits(spark)
    want, shown = set(), {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        key = f"{r[3]}:{r[4]}"
        if r[0] is None or shown.get(r[0]) != key:
            want.add(r[2])
            shown[r[0]] = key
    got = suppress_repeat_alerts(df.withColumn("subject", F.lit("s")), slice_seconds=slice_seconds)
    assert sorted(r["seq"] for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("slice_seconds", [60, 3600])
def test_debounce_against_brute_force(spark, slice_seconds):
    rows, df = visits(spark, nulls=False)
    want = set()
    for held in by_tab(rows).values():
        for r, after in zip(held, held[1:] + [None]):
            if after is None or after[1] - r[1] >= dt.timedelta(seconds=60):
                want.add(r[2])
    got = debounce(df, gap="60 seconds", slice_seconds=slice_seconds)
    assert sorted(r["seq"] for r in got.collect()) == sorted(want)


def test_latest_analysis(spark):
    rows, df = visits(spark, nulls=False)
    want = {tab: held[-1][2] for tab, held in by_tab(rows).items()}
    assert {r["tab"]: r["seq"] for r in latest_analysis(df).collect()} == want


PAGE = """<!doctype html><html><head><title> URGENT &amp; &quot;Login&quot;
 now</title><script>var x = "<p>no</p>";</script></head><body><!-- <p>hidden</p> -->
<h1>Verify</h1><p>Write to <b>Box</b>@Example.org or&nbsp;call&#33; &#x1F600;&amp;lt;</p><style>p{}</style>
<a class='x' href='/in?a=1&amp;b=2'>one</a><a href="http://1.2.3.4/x">two</a><a href=rel>3</a>
<a href="#top">t</a><a href="mailto:a@b.org">m</a><a href="//cdn.org/z">c</a><a href="/in?a=1&amp;b=2">again</a>
</body></html>"""


def test_page_to_email(spark):
    df = spark.createDataFrame([(1, "https://Shop.example.com:8443/dir/page?q=1", PAGE),
                                (2, "about:blank", "<p>x</p>")], "page_id int, url string, html string")
    rows = {r["email_id"]: r for r in pages_to_emails(df).collect()}
    assert rows[1]["subject"] == 'URGENT & "Login" now'
    assert rows[1]["sender_email"] == "Box@Example.org"
    assert rows[1]["sender_name"] == "shop.example.com"
    assert rows[1]["body_text"].startswith("Verify Write to Box@Example.org or call! \U0001F600&lt;")
    assert "hidden" not in rows[1]["body_text"] and "p{}" not in rows[1]["body_text"]
    base = "https://Shop.example.com:8443"
    assert rows[1]["urls"] == [
        f"{base}/dir/page?q=1", f"{base}/in?a=1&b=2", "http://1.2.3.4/x", f"{base}/dir/rel",
        f"{base}/dir/page?q=1#top", "https://cdn.org/z"]
    assert rows[2]["sender_email"] == "no-reply@unknown.local"
    assert rows[2]["subject"] == rows[2]["sender_name"] == "unknown.local"


def test_page_url_cap(spark):
    html = "".join(f'<a href="/{i}">x</a>' for i in range(100))
    df = spark.createDataFrame([(1, "https://a.org/", html)], "page_id int, url string, html string")
    urls = pages_to_emails(df, max_links=80).first()["urls"]
    assert len(urls) == 80 and urls[:2] == ["https://a.org/", "https://a.org/0"]


def test_mail_view(spark):
    df = spark.createDataFrame([(
        "1", " Hi ", "Ann <ann@X.org>", None,
        'see <a href="https://a.org/1">x</a><a href="/rel">y</a><a href="https://a.org/1">z</a>',
        [" A.PDF.Exe ", "", "README"])],
        "email_id string, subject string, from_name string, from_addr string, body_html string,"
        " files array<string>")
    row = mail_view_to_emails(df).first()
    assert (row["sender_email"], row["sender_name"], row["subject"]) == (
        "ann@X.org", "Ann <ann@X.org>", "Hi")
    assert row["urls"] == ["https://a.org/1"]
    assert [(a["filename"], a["extension"]) for a in row["attachments"]] == [
        ("A.PDF.Exe", "exe"), ("README", "")]
