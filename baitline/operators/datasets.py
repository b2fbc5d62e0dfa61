"""Labelled data sets from mail archives, URL lines and generated harmless rows."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from email import policy as mime_policy
from email.parser import BytesParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions.sender_rules import header_address, header_name
from baitline.functions.strings import SPACE_CLASS, collapse_spaces, first_text, strip
from baitline.operators.sampling import seeded_sample
from baitline.plans.scale import cut_lineage
from baitline.schemas import TRAINING_COLUMNS

# Code that runs in Python workers travels with the job: executors need not have this
# package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINK_IN_TEXT = rf"(?i)https?://[^{SPACE_CLASS[1:-1]}\"'<>]+"
TAG = r"<[^>]+>"
DECODED_BYTES = 2 << 20  # of mails whose parts a task gathers before it hands them on

_PARTS = pa.schema([
    ("path", pa.string()), ("place", pa.int64()), ("from_header", pa.string()), ("subject", pa.string()),
    ("multipart", pa.bool_()),
    ("parts", pa.list_(pa.struct([("content_type", pa.string()), ("filename", pa.string()),
                                  ("text", pa.string())]))),
    ("error", pa.string()),
])
_PARTS_DDL = ("path string, place long, from_header string, subject string, multipart boolean,"
              " parts array<struct<content_type:string,filename:string,text:string>>, error string")


def _decode_part(part) -> str:
    try:
        body = part.get_content()
    except Exception:
        return ""
    return body.decode("utf-8", errors="ignore") if isinstance(body, bytes) else str(body)


def _clean(value: str) -> str:
    # Lone surrogates of undecodable bytes cannot be stored as UTF-8.
    return value.encode("utf-8", errors="replace").decode("utf-8")


def _remembering_policy():
    """The standard mail policy, but a header of the mail at hand is parsed once, not at every access."""
    class Remembering(type(mime_policy.default)):
        def header_fetch_parse(self, name, value):
            if hasattr(value, "name"):
                return value
            if (name, value) not in known:
                known[name, value] = mime_policy.default.header_fetch_parse(name, value)
            return known[name, value]

    known: dict = {}
    return Remembering(), known


def _read_message(path: str, content: bytes, parser: BytesParser | None = None) -> dict:
    """The headers and decoded parts of one message."""
    message = (parser or BytesParser(policy=mime_policy.default)).parsebytes(content)
    multipart = message.is_multipart()
    parts = []
    for part in (message.walk() if multipart else [message]):
        kind = part.get_content_type()
        wanted = not multipart or kind in ("text/plain", "text/html")
        name = part.get_filename() if multipart else None
        parts.append({"content_type": kind, "filename": _clean(name) if name else None,
                      "text": _clean(_decode_part(part)) if wanted else None})
    return {"path": path, "from_header": _clean(str(message.get("From", ""))),
            "subject": _clean(str(message.get("Subject", ""))), "multipart": multipart, "parts": parts}


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, place, content, error) -> the rows of ``decode_mail``, a few megabytes of mails at a time."""
    policy, known = _remembering_policy()
    parser = BytesParser(policy=policy)
    rows, size = [], 0
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]  # one mail is decoded at a time
            known.clear()
            found = {"path": row["path"], "place": row["place"], "error": row["error"]}
            if row["error"] is None and row["content"] is None:
                found["error"] = "no content"
            elif row["error"] is None:
                try:
                    found.update(_read_message(row["path"], row["content"], parser))
                except Exception as e:
                    found["error"] = f"{type(e).__name__}: {_clean(str(e))}"
            rows.append(found)
            size += len(row["content"] or b"") + 256
            if size >= DECODED_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema=_PARTS)
                rows, size = [], 0
        pa.default_memory_pool().release_unused()
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_PARTS)


def decode_mail(files: DataFrame) -> DataFrame:
    """(path, content) -> headers and decoded parts, or ``error`` where a mail cannot be read.

    ``place`` and ``error`` of an archive are taken over; a null content without an error is one.
    Only the MIME codec runs in Python.
    """
    place = F.col("place") if "place" in files.columns else F.lit(0).cast("long").alias("place")
    error = F.col("error") if "error" in files.columns else F.lit(None).cast("string").alias("error")
    return files.select("path", place, "content", error).mapInArrow(_decoded, _PARTS_DDL)


def rejected_mail(decoded: DataFrame) -> DataFrame:
    """The mails that could not be read: path, place, error."""
    return decoded.filter("error IS NOT NULL").select("path", "place", "error")


def text_urls(text: Column) -> Column:
    """Every http(s) URL in a text, in order, with repeats."""
    return F.regexp_extract_all(text, F.lit(LINK_IN_TEXT), F.lit(0))


def joined_set(values: Column, n: int | None = None) -> Column:
    """Distinct values in order, joined by semicolons; the first ``n`` if given."""
    every = F.array_sort(F.array_distinct(values))
    return F.array_join(every if n is None else F.slice(every, 1, n), ";")


def mail_to_training(decoded: DataFrame, max_urls: int | None = None,
                     max_attachments: int | None = None) -> DataFrame:
    """Decoded parts -> training row: path and the seven columns, label 1.

    All URLs and attachments are kept unless a limit is given. Mails with an error are
    in :func:`rejected_mail`.
    """
    decoded = decoded.filter("error IS NULL")
    multipart = F.col("multipart")
    html = F.filter("parts", lambda p: p["content_type"] == "text/html")
    # In a message of one part, whatever is not HTML is read as text.
    plain = F.when(multipart, F.filter("parts", lambda p: p["content_type"] == "text/plain")
                   ).otherwise(F.filter("parts", lambda p: p["content_type"] != "text/html"))
    texts = F.filter("parts", lambda p: p["text"].isNotNull())
    names = F.filter(F.transform("parts", lambda p: p["filename"]),
                     lambda f: F.coalesce(f, F.lit("")) != "")

    def joined(parts: Column) -> Column:
        return F.array_join(F.transform(parts, lambda p: p["text"]), " ")

    return decoded.select(
        "path",
        header_address(F.col("from_header")).alias("sender_email"),
        header_name(F.col("from_header")).alias("sender_name"),
        collapse_spaces(F.col("subject")).alias("subject"),
        first_text(collapse_spaces(joined(plain)),
                   collapse_spaces(F.regexp_replace(joined(html), TAG, " ")),
                   F.lit(fv.EMPTY_BODY)).alias("body_text"),
        joined_set(F.flatten(F.transform(texts, lambda p: text_urls(p["text"]))),
                   max_urls).alias("urls"),
        joined_set(names, max_attachments).alias("attachments"),
        F.lit(1).alias("label"))


def _pick(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def benign_urls(index: DataFrame, column: str = "id") -> DataFrame:
    """One harmless URL per row number (0, 1, 2, ...); 200 different ones."""
    i = F.col(column)
    n = len(fv.SAFE_DOMAINS)
    protocol = F.when(i % 5 == 0, "http").otherwise("https")
    url = F.concat(protocol, F.lit("://www."), _pick(fv.SAFE_DOMAINS, i % n),
                   _pick(fv.SAFE_PATHS, F.floor(i / n) % len(fv.SAFE_PATHS)))
    return index.select(column, url.alias("url"))


def _seeded_choice(values: list, seed: int, name: str, i: Column) -> Column:
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(name),
                                                i.cast("string"))), 1, 8), 16, 10).cast("bigint")
    return _pick(values, draw % len(values))


def benign_emails(index: DataFrame, column: str = "id", seed: int = fv.SEED) -> DataFrame:
    """One harmless training row per row number, drawn by hash: the same on every retry."""
    i = F.col(column)
    senders = list(range(len(fv.BENIGN_SENDERS)))
    chosen = index.withColumn("_who", _seeded_choice(senders, seed, "sender", i))
    return chosen.select(
        column,
        _pick([a for a, _ in fv.BENIGN_SENDERS], F.col("_who")).alias("sender_email"),
        _pick([n for _, n in fv.BENIGN_SENDERS], F.col("_who")).alias("sender_name"),
        _seeded_choice(fv.BENIGN_SUBJECTS, seed, "subject", i).alias("subject"),
        _seeded_choice(fv.BENIGN_BODIES, seed, "body", i).alias("body_text"),
        _seeded_choice(fv.BENIGN_URLS, seed, "url", i).alias("urls"),
        F.lit("").alias("attachments"), F.lit(0).alias("label"))


def url_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Stripped, non-empty, distinct lines."""
    return (lines.select(strip(F.col(column)).alias("url")).filter("url <> ''").distinct())


def build_url_testset(lines: DataFrame, n_bad: int, n_good: int, seed: int = fv.SEED,
                      good_index: DataFrame | None = None) -> DataFrame:
    """Sampled lines (label 1) and generated harmless URLs (label 0): url, y_true."""
    if good_index is None:
        good_index = lines.sparkSession.range(n_good)
    bad = seeded_sample(lines.select("url").distinct(), n_bad, "url", seed)
    good = benign_urls(good_index, good_index.columns[0]).select("url")
    return bad.withColumn("y_true", F.lit(1)).unionByName(good.withColumn("y_true", F.lit(0)))


def build_training_set(spark: SparkSession, mail: DataFrame, ratio: float = 1.0,
                       seed: int = fv.SEED) -> DataFrame:
    """Phishing rows and int(n * ratio) generated harmless ones.

    The rows are written once, so an archive is not decoded again to be counted.
    """
    mail = cut_lineage(mail.select(TRAINING_COLUMNS))
    harmless = benign_emails(spark.range(int(mail.count() * max(0.0, ratio))), "id", seed)
    return mail.unionByName(harmless.select(TRAINING_COLUMNS))
