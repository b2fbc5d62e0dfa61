"""Web pages and opened mails turned into scorable emails."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions import html
from baitline.functions.sender_rules import shown_address
from baitline.functions.strings import EMAIL_ADDRESS, first_text, web_strip
from baitline.functions.url_rules import split_urls

_NO_FILES = ("array<struct<filename:string,extension:string,size_kb:double,mime_type:string>>")


def pages_to_emails(pages: DataFrame, key: str = "page_id", max_chars: int | None = None,
                    max_links: int | None = None) -> DataFrame:
    """page_id, url, html -> email columns. Map-only.

    The whole text and all links are read unless limits are given.
    """
    host = F.get(split_urls(F.array("url")), F.lit(0))["host"]
    links = F.filter(
        F.transform(html.links_of(F.col("_shown")), lambda h: html.resolve(h, F.col("_base"))),
        lambda u: u.startswith("http"))
    shown = pages.select(key, "url", "html", html.shown_html(F.col("html")).alias("_shown"),
                         html.page_base(F.col("url")).alias("_base"))
    body = html.text_of(F.col("_shown"))
    read = shown.select(
        F.col(key).alias("email_id"), "url",
        first_text(host, F.lit(fv.UNKNOWN_HOST)).alias("_host"),
        (body if max_chars is None else F.substring(body, 1, max_chars)).alias("body_text"),
        html.page_title(F.col("html")).alias("_title"), links.alias("_links"))
    found = F.regexp_extract("body_text", EMAIL_ADDRESS, 0)
    seen = F.array_distinct(F.filter(F.concat(F.array("url"), F.col("_links")), lambda u: u != ""))
    return read.select(
        "email_id",
        first_text(found, F.concat(F.lit("no-reply@"), F.col("_host"))).alias("sender_email"),
        F.col("_host").alias("sender_name"),
        first_text(F.col("_title"), F.col("_host")).alias("subject"),
        "body_text",
        (seen if max_links is None else F.slice(seen, 1, max_links)).alias("urls"),
        F.array().cast(_NO_FILES).alias("attachments"),
        F.lit("webpage").alias("page_source"))


def mail_view_to_emails(views: DataFrame) -> DataFrame:
    """email_id, subject, from_name, from_addr, body_html, files -> email columns."""
    links = F.filter(html.raw_links(F.col("body_html")), lambda u: u.startswith("http"))
    names = F.filter(F.transform("files", lambda f: web_strip(f)), lambda f: f != "")
    files = F.transform(names, lambda f: F.struct(
        f.alias("filename"),
        F.when(f.contains("."), F.lower(F.substring_index(f, ".", -1))).otherwise("")
        .alias("extension"),
        F.lit(0.0).alias("size_kb"), F.lit("application/octet-stream").alias("mime_type")))
    name = web_strip(F.col("from_name"))
    return views.select(
        "email_id", shown_address(first_text(F.col("from_addr"), name)).alias("sender_email"),
        F.coalesce(name, F.lit("")).alias("sender_name"),
        F.coalesce(web_strip(F.col("subject")), F.lit("")).alias("subject"),
        html.visible_text(F.col("body_html")).alias("body_text"),
        F.array_distinct(links).alias("urls"), files.alias("attachments"),
        F.lit("gmail").alias("page_source"))
