"""Chunking and the keyword/caps/exclamation score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions.strings import blank_if_null, count_contained, count_of, strip


def merged_text(subject: Column, body: Column) -> Column:
    return strip(F.concat(blank_if_null(subject), F.lit("\n"), blank_if_null(body)))


def chunk_array(text: Column) -> Column:
    """Overlapping windows over the whole text; an empty text has none.

    Each match looks ahead one window, keeps it, and moves on by one step: one pass over
    the text. Substrings by position would count characters from the start for every
    window, which is quadratic in the length of a mail.
    """
    window = f"(?s)(?=(.{{1,{fv.CHUNK_CHARS}}})).{{1,{fv.CHUNK_STEP}}}"
    return F.regexp_extract_all(text, F.lit(window), F.lit(1))


def uppercase_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{IsUppercase}]+", ""))


def keyword_score(chunk: Column, lowered: Column, keywords: list[str]) -> Column:
    hits = count_contained(lowered, keywords)
    caps = uppercase_count(chunk) / F.greatest(F.lit(1), F.length(chunk))
    shouts = F.least(F.lit(fv.EXCLAMATION_LIMIT), count_of(chunk, "!") * fv.EXCLAMATION_WEIGHT)
    return F.least(F.lit(1.0), hits * fv.KEYWORD_WEIGHT + caps * fv.CAPS_WEIGHT + shouts)


def chunk_scores(chunks: Column, keywords: list[str]) -> Column:
    # Two steps, so that each chunk is lower-cased once and not once per keyword.
    pairs = F.transform(chunks, lambda c: F.struct(c.alias("chunk"), F.lower(c).alias("low")))
    return F.transform(pairs, lambda p: keyword_score(p["chunk"], p["low"], keywords))


def roll_up(scores: Column, aggregation: str) -> Column:
    """Mean or maximum of the chunk scores; null when there are none."""
    if aggregation == "max":
        return F.array_max(scores)
    if aggregation != "mean":
        raise ValueError(f"aggregation must be 'mean' or 'max', not {aggregation!r}")
    total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + s)
    return F.when(F.size(scores) > 0, total / F.size(scores))


def text_reasons(value: Column, n_chunks: Column, from_model: bool = False) -> Column:
    wording = (F.when(value >= fv.TEXT_STRONG_FROM, F.lit(fv.TEXT_REASONS["strong"]))
               .when(value >= fv.TEXT_SOME_FROM, F.lit(fv.TEXT_REASONS["some"])))
    model = F.lit(fv.TEXT_REASONS["model"]) if from_model else F.lit(None).cast("string")
    return (F.when(n_chunks == 0, F.array(F.lit(fv.TEXT_REASONS["empty"])))
            .otherwise(F.array_compact(F.array(wording, model))))
