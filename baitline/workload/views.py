"""Inputs of the registered queries, derived by Spark from the shared tables.

``MAIL_SQL`` is plain SQL that both engines read the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baitline.operators.captures import fingerprint
from baitline.operators.pages import pages_to_emails
from baitline.plans.scale import micros_of, shared_folder, spread_small_input
from baitline.sources.mail_archive import write_boxes

MAIL_SQL = """
SELECT doc_id AS email_id,
  CASE doc_id % 8 WHEN 0 THEN 'desk@parcels-pay.work'
    WHEN 1 THEN concat('user', CAST(doc_id AS STRING), '@gmail.com')
    WHEN 2 THEN concat('no-reply@mail', CAST(doc_id % 1500 AS STRING), '.example.com')
    WHEN 3 THEN 'security@microsoft.com' WHEN 4 THEN 'billing@amaz0n-4421.net'
    WHEN 5 THEN 'not-an-address' WHEN 6 THEN 'News@GitHub.com '
    ELSE 'ops@mail.google.com' END AS sender_email,
  CASE doc_id % 5 WHEN 0 THEN 'PayPal Helpdesk' WHEN 1 THEN 'Microsoft Account'
    WHEN 2 THEN NULL WHEN 3 THEN 'Google and Amazon Billing' ELSE 'Bank Team' END AS sender_name,
  CASE doc_id % 6 WHEN 0 THEN 'Urgent notice: confirm your parcel' WHEN 1 THEN 'Weekly newsletter'
    WHEN 2 THEN '' WHEN 3 THEN 'Invoice  attached!' WHEN 4 THEN 'Password reset'
    ELSE 'Meeting reminder' END AS subject,
  concat(CASE doc_id % 7
      WHEN 0 THEN 'We suspended the parcel locker: login and reset its password today!! '
      WHEN 1 THEN 'PLEASE CONFIRM THE INVOICE ' ELSE '' END, text) AS body_text,
  concat_ws(' ',
    CASE WHEN doc_id % 9 IN (0, 3) THEN 'http://10.20.30.40/urgent/invoice' END,
    CASE WHEN doc_id % 9 IN (0, 4) THEN concat('https://parcel.secure-', CAST(doc_id % 50 AS STRING), '.top/reset') END,
    CASE WHEN doc_id % 9 IN (1, 4) THEN 'https://reader:pw@docs.example.net:8443/guide/' END,
    CASE WHEN doc_id % 9 IN (1, 5) THEN concat('https://bit.ly/x', CAST(doc_id % 20 AS STRING)) END,
    CASE WHEN doc_id % 9 IN (2, 5) THEN 'https://a.b.c.account-verify-now.top/x?id=1' END,
    CASE WHEN doc_id % 9 IN (2, 6) THEN 'http://45.10.120.7/pay' END,
    CASE WHEN doc_id % 9 = 6 THEN 'parcels.example/login' END,
    CASE WHEN doc_id % 9 = 7 THEN concat('https://xn--pypal-4ve.com/', repeat('a', 120)) END,
    CASE WHEN doc_id % 9 = 0 THEN 'http://10.20.30.40/urgent/invoice' END) AS urls_joined,
  CASE doc_id % 6 WHEN 0 THEN 'label.docx.js' WHEN 1 THEN 'report.docm notes.txt'
    WHEN 2 THEN 'backup.zip setup.tar.js' WHEN 3 THEN '' WHEN 4 THEN 'photo.jpg'
    ELSE 'README' END AS files_joined,
  CASE doc_id % 2 WHEN 0 THEN 'gmail' ELSE 'webpage' END AS page_source
FROM {documents}
"""
LABEL_SQL = "CASE WHEN email_id % 9 IN (0, 2, 5) THEN 1 ELSE 0 END"

# JSON texts with every kind of fault. A part that is null is absent from the object.
RAW_SQL = """
SELECT email_id, CASE
    WHEN email_id % 23 = 0 THEN 'not json {{'
    WHEN email_id % 23 = 1 THEN '[1, 2]'
    ELSE concat('{{', concat_ws(', ',
      CASE WHEN email_id % 23 NOT IN (2, 3) THEN concat('"sender_email": ',
        CASE email_id % 23 WHEN 4 THEN '"  "' WHEN 5 THEN '7' ELSE {quoted_sender} END) END,
      concat('"sender_name": ', CASE email_id % 23 WHEN 6 THEN '[]' WHEN 7 THEN 'null'
        ELSE '"Some One "' END),
      CASE WHEN email_id % 23 <> 8 THEN concat('"subject": ',
        CASE email_id % 23 WHEN 9 THEN 'null' ELSE '"Hello"' END) END,
      CASE WHEN email_id % 23 <> 3 THEN concat('"body_text": ',
        CASE email_id % 23 WHEN 10 THEN '{{}}' ELSE {quoted_body} END) END,
      concat('"urls": ', CASE email_id % 23 WHEN 11 THEN '["https://a.org", 3]'
        WHEN 12 THEN '"https://a.org"' WHEN 13 THEN '[]' ELSE '["https://a.org/x"]' END),
      concat('"attachments": ', CASE email_id % 23 WHEN 14 THEN '"none"'
        WHEN 15 THEN '[7, {{"filename": "a.exe", "extension": ".EXE", "size_kb": true, "mime_type": "m"}}]'
        WHEN 16 THEN '[{{"filename": 1, "size_kb": "9"}}]'
        WHEN 17 THEN '[{{"filename": "a.exe", "extension": ".EXE", "size_kb": true, "mime_type": "m"}}]'
        ELSE '[{{"filename": "a.zip", "extension": "zip", "size_kb": 1.5, "mime_type": "m"}}]' END)
    ), '}}') END AS raw
FROM {mail}
"""
GAP = "30 minutes"
POLICY = [("parcels-pay.work", "block"), ("google.com", "allow"), ("microsoft.com", "allow"),
          ("microsoft.com", "block"), ("mail.google.com", "allow")]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread_small_input(spark.read.parquet(f"{folder}/{name}.parquet"))


def mail(spark: SparkSession, folder: str) -> DataFrame:
    """Documents dressed as mail: senders, subjects, links and files by id."""
    return spark.sql(MAIL_SQL, documents=table(spark, folder, "documents"))


def _words(column: str):
    return F.filter(F.split(column, " "), lambda w: w != "")


def emails(spark: SparkSession, folder: str) -> DataFrame:
    """The mail view in the shape of an email table."""
    held = mail(spark, folder)
    files = F.transform(_words("files_joined"), lambda f: F.struct(
        f.alias("filename"),
        F.when(f.contains("."), F.lower(F.substring_index(f, ".", -1))).otherwise("")
        .alias("extension"),
        F.lit(0.0).alias("size_kb"), F.lit("application/octet-stream").alias("mime_type")))
    return held.select("email_id", "sender_email", "sender_name", "subject", "body_text",
                       _words("urls_joined").alias("urls"), files.alias("attachments"),
                       "page_source")


def training_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The mail view in the shape of a training CSV, plus its id."""
    return mail(spark, folder).select(
        F.col("email_id").alias("id"), "sender_email",
        F.coalesce("sender_name", F.lit("")).alias("sender_name"), "subject", "body_text",
        F.replace("urls_joined", F.lit(" "), F.lit(";")).alias("urls"),
        F.replace("files_joined", F.lit(" "), F.lit(";")).alias("attachments"),
        F.expr(LABEL_SQL).cast("int").alias("label"))


def raw_json(spark: SparkSession, folder: str) -> DataFrame:
    """JSON texts, some of them faulty."""
    def quoted(column: str) -> str:
        packed = f"to_json(named_struct('v', {column}))"
        return f"substring({packed}, 6, length({packed}) - 6)"

    held = mail(spark, folder)
    text = RAW_SQL.replace("{quoted_sender}", quoted("sender_email")).replace(
        "{quoted_body}", quoted("body_text"))
    return spark.sql(text, mail=held)


def policy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POLICY, "domain string, action string")


def ts_us(df: DataFrame, column: str = "ts"):
    return micros_of(df, column).alias(f"{column}_us")


def _visits(events: DataFrame, target: str, n: int) -> DataFrame:
    # Visitors stay with one target for three days, so repeats follow each other.
    period = F.floor(micros_of(events, "ts") / (3 * 86400 * 1000000))
    return events.select(
        F.col("user_id").alias("tab"), "ts", F.col("event_id").alias("seq"),
        ((F.col("user_id") * 7 + period) % n).alias(target))


def page_captures(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """Events as page captures: tab, ts, seq and the fingerprint of the visited page."""
    pages = table(spark, folder, "pages")
    prints = fingerprint(pages_to_emails(pages)).select(
        F.col("email_id").alias("page_id"), "fingerprint")
    events = table(spark, folder, "events") if events is None else events
    return _visits(events, "page_id", pages.count()).join(prints, "page_id")


def visited_verdicts(spark: SparkSession, folder: str, verdicts: DataFrame,
                     events: DataFrame | None = None) -> DataFrame:
    """Events as analyses of mails: tab (null for some), ts, seq and the mail's verdict."""
    n = table(spark, folder, "documents").count()
    events = table(spark, folder, "events") if events is None else events
    visits = _visits(events, "email_id", n).withColumn(
        "tab", F.when(F.col("seq") % 17 != 0, F.col("tab")))
    return visits.join(verdicts, "email_id")


def url_lines_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Text lines: URLs of mails and pages, with padding, blanks and repeats."""
    of_mail = mail(spark, folder).select(F.explode(F.split("urls_joined", " ")).alias("value"))
    of_pages = table(spark, folder, "pages").select(F.concat(F.lit("  "), "url", F.lit(" \t"))
                                                    .alias("value"))
    return of_mail.unionByName(of_pages).unionByName(of_pages)


def mail_boxes(spark: SparkSession, folder: str) -> str:
    """The mail view as an archive of mailboxes in the shared folder; every eleventh mail is broken."""
    mails = mail_files(spark, folder).select(F.when(
        F.regexp_extract("path", r"(\d+)", 1).cast("long") % 11 == 0,
        F.concat(F.encode(F.lit("From: \"\r\n"), "UTF-8"), F.col("content"))).otherwise(F.col("content")).alias("content"))
    boxes = f"{shared_folder(spark)}/boxes"
    write_boxes(mails, boxes)
    return boxes


def mail_files(spark: SparkSession, folder: str) -> DataFrame:
    """The mail view as message files: (path, content)."""
    crlf = F.lit("\r\n")
    head = F.concat(
        F.lit("From: "), F.coalesce("sender_name", F.lit("")), F.lit(" <Box"),
        F.col("email_id").cast("string"), F.lit("@Mail.Example.COM>"), crlf,
        F.lit("Subject: "), F.col("subject"), crlf, F.lit("MIME-Version: 1.0"), crlf)
    links = F.concat(F.lit("\r\nSee "), F.col("urls_joined"), F.lit(" now\r\n"))

    def part(kind: str, body) -> object:
        return F.concat(F.lit(f"Content-Type: {kind}; charset=utf-8\r\n"
                              "Content-Transfer-Encoding: 8bit\r\n\r\n"), body)

    edge = "=_edge_of_a_part_="
    attachment = F.when(F.col("files_joined") != "", F.concat(
        F.lit(f"\r\n--{edge}\r\nContent-Type: application/octet-stream\r\n"
              "Content-Disposition: attachment; filename=\""), F.col("files_joined"),
        F.lit('"\r\n\r\nxyz'))).otherwise("")
    mixed = F.concat(F.lit(f'Content-Type: multipart/mixed; boundary="{edge}"\r\n\r\n--{edge}\r\n'),
                     part("text/plain", F.concat("body_text", links)), attachment,
                     F.lit(f"\r\n--{edge}--\r\n"))
    single = part("text/html", F.concat(F.lit("<html><p>"), "body_text", F.lit("</p><b>"),
                                        links, F.lit("</b></html>")))
    empty = part("text/plain", F.lit(" \r\n"))
    body = (F.when(F.col("email_id") % 5 == 0, single).when(F.col("email_id") % 5 == 1, empty)
            .otherwise(mixed))
    return mail(spark, folder).select(
        F.concat(F.lit("mail/"), F.col("email_id").cast("string"), F.lit(".eml")).alias("path"),
        F.encode(F.concat(head, body), "UTF-8").alias("content"))
