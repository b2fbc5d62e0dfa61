"""Licence scans by the digest of a canonical text.

A text is canonical when it is lower-cased, lines that state a copyright are gone, words of
two spellings have one, and everything but letters and digits is a gap between words. Entire
texts are compared: the SHA-256 of the canonical text is joined with the digests of known
licences. Units are whole documents, every line of them, and runs of paragraphs (lines between
blank lines) of as many paragraphs as a licence may have (``RUNS``), so a notice or a licence
inside a document is found as the text it is. Known texts stand with and without their titles.

A line of a body may begin with "copyright" when it is wrapped there. Documents are therefore
read both ways: without any such line, and without those that state a copyright only; runs of
paragraphs in the second way. A notice wrapped inside a paragraph of other lines is not found.

Only DataFrame functions run. Known texts all hold one of a few words (checked when they are
read); units without any of them cannot match and are not made canonical.

Cases: a null, empty or wordless text matches nothing; two names with the same canonical text
are both reported; a document of one line matches as a document and as a line; repeated rows
are one document if they have one id and text (counts are per id and text); extra columns do
not matter; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from baitline.llm.license_texts import KNOWN, SAME_WORDS
from baitline.plans.scale import lookup_join

COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|©)[^\n]*$"
NO_WORD = r"[^\p{L}\p{N}]+"
# Every known text holds one of these, in any spelling.
SIGNS = r"licen[cs]e|permission|spdx|redistribution"
# Lines that state a copyright, not the lines of a licence that go on with that word.
STATED = (r"(?mi)^[ \t]*(copyright(?![ \t]*[,.;)]|\s+(notices?|holders?|owners?|licen[cs]es?|laws?|"
          r"statements?|interests?|and|or|in|to|of|on|for|is|are|the|rights?|protection|permission)\b)"
          r"|\(c\)[ \t]*\d|©)[^\n]*$")

HEAD = 24         # characters of a known text by which its first paragraph is told
MOST_HEADS = 500


def _paragraphs(text: str) -> int:
    return len([p for p in re.split(r"\n\s*\n", text) if re.search(r"\w", p)])


# Short licences are set in up to a dozen paragraphs; long ones as they were published.
RUNS = sorted({*range(1, 13), *(_paragraphs(text) for _, text in KNOWN)})


def canonical(text: Column, dropped: str = COPYRIGHT_LINE) -> Column:
    """Words of a text, each between two blanks, so that equal words in a row are all replaced."""
    bare = F.regexp_replace(F.lower(text), dropped, "")
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(bare, NO_WORD, "  ")), F.lit(" "))
    return reduce(lambda c, pair: F.replace(c, F.lit(f" {pair[0]} "), F.lit(f" {pair[1]} ")),
                  SAME_WORDS, words)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """license, digest."""
    texts = spark.createDataFrame(known, "license string, text string")
    odd = texts.filter(~F.lower("text").rlike(SIGNS)).count()
    if odd:
        raise ValueError(f"{odd} known texts hold none of {SIGNS}")
    ways = F.explode(F.array(*[F.struct(F.sha2(c, 256).alias("digest"), F.left(c, F.lit(HEAD)).alias("head"))
                               for d in (COPYRIGHT_LINE, STATED) for c in [canonical(F.col("text"), d)]])).alias("way")
    return texts.select("license", ways).select("license", "way.digest", "way.head").distinct()


def _runs(text: Column, heads: list[str] | None) -> Column:
    """place, whole, digest of runs of paragraphs; a run of one line only if it is the text.

    A run is tried only where its first paragraphs begin like a known text (``heads``; None: everywhere).
    """
    paragraphs = F.filter(F.split(F.regexp_replace(text, STATED, ""), r"\n\s*\n"),
                          lambda p: p.rlike(r"[\p{L}\p{N}]"))
    lengths = F.array(*[F.lit(k) for k in RUNS])

    def run(held: Column, at: Column, length: Column) -> Column:
        own = F.array_join(F.slice(held, at, length), "\n")
        whole = (at == 1) & (length == F.size(held))
        lines = F.trim(F.regexp_replace(own, r"^\s+|\s+$", "")).contains("\n")
        return F.when(whole | lines, F.struct(
            (at * 1000 + length).cast("long").alias("place"), whole.alias("whole"),
            F.sha2(canonical(own, STATED), 256).alias("digest")))

    def first(held: Column, at: Column) -> Column:
        own = F.array_join(F.slice(held, at, F.lit(3)), "\n")
        return F.struct(at.alias("at"), F.left(canonical(own, STATED), F.lit(HEAD)).alias("head"))

    def known(place: Column) -> Column:
        if heads is None:
            return F.lit(True)
        return F.exists(F.array(*[F.lit(h) for h in heads]),
                        lambda h: place["head"].startswith(h) | h.startswith(place["head"]))

    def every(held: Column) -> Column:
        places = F.transform(F.sequence(F.lit(1), F.size(held)), lambda at: first(held, at))
        return F.flatten(F.transform(F.filter(places, known), lambda x: F.transform(
            F.filter(lengths, lambda k: k <= F.size(held) - x["at"] + 1), lambda k: run(held, x["at"], k))))

    # The paragraphs are the value of a lambda's variable: cut once, not again at every place.
    cut = F.filter(F.array(paragraphs), lambda held: F.size(held) > 0)
    return F.flatten(F.transform(cut, every))


def scan_licenses(docs: DataFrame, digests: DataFrame, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """doc_id, unit (document, line or paragraphs), license, n: units that are a known text."""
    held = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("t")).filter(
        F.lower("t").rlike(SIGNS))
    whole = held.select("doc_id", F.xxhash64("t").alias("h"), F.lit("document").alias("unit"),
                        F.lit(-1).alias("place"), "t")
    lines = held.select("doc_id", F.xxhash64("t").alias("h"), F.lit("line").alias("unit"),
                        F.posexplode(F.split("t", "\n", -1)).alias("place", "t"))
    lines = lines.filter(F.lower("t").rlike(SIGNS))
    units = whole.unionByName(lines).withColumn("digest", F.sha2(canonical(F.col("t")), 256)).drop("t")
    again = whole.withColumn("digest", F.sha2(canonical(F.col("t"), STATED), 256)).drop("t")
    heads = None
    if "head" in digests.columns:
        rows = digests.select("head").distinct().limit(MOST_HEADS + 1).collect()
        heads = sorted(r.head for r in rows) if 0 < len(rows) <= MOST_HEADS else None
        digests = digests.drop("head").distinct()
    runs = held.select("doc_id", F.xxhash64("t").alias("h"), F.explode(_runs(F.col("t"), heads)).alias("run"))
    runs = runs.filter("run IS NOT NULL").select(
        "doc_id", "h", F.when(F.col("run.whole"), "document").otherwise("paragraphs").alias("unit"),
        F.when(F.col("run.whole"), F.lit(-1).cast("long")).otherwise(F.col("run.place")).alias("place"), "run.digest")
    units = units.withColumn("place", F.col("place").cast("long"))
    again = again.withColumn("place", F.col("place").cast("long"))
    units = units.unionByName(again).unionByName(runs)
    found = lookup_join(units, digests, "digest", ["doc_id", "place"], how="inner")
    found = found.select("doc_id", "h", "unit", "place", "license").distinct()
    return found.groupBy("doc_id", "unit", "license").agg(F.count(F.lit(1)).alias("n"))
