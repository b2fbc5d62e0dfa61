"""Text indicator: chunk, score, roll up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline.functions import text_rules as tr
from baitline.functions.strings import clean_text, round2
from baitline.rules import DEFAULT_RULES, RuleSet


def clean_emails(emails: DataFrame, subject_chars: int | None = None,
                 body_chars: int | None = None) -> DataFrame:
    """Collapse whitespace in subject and body; a limit cuts the text."""
    return emails.withColumns({
        "subject": clean_text(F.col("subject"), subject_chars),
        "body_text": clean_text(F.col("body_text"), body_chars),
    })


def text_chunks(emails: DataFrame, key: str = "email_id") -> DataFrame:
    """One row per chunk of the merged subject and body: key, pos, chunk. Map-only."""
    merged = emails.select(key, tr.merged_text(F.col("subject"), F.col("body_text")).alias("_t"))
    return merged.select(key, F.posexplode(tr.chunk_array(F.col("_t"))).alias("pos", "chunk"))


def keyword_scores(chunks: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Adds ``chunk_score`` to a chunk table."""
    return chunks.withColumn("chunk_score", tr.keyword_score(
        F.col("chunk"), F.lower("chunk"), rules.text_keywords))


def score_text(emails: DataFrame, aggregation: str = "mean",
               rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Adds text_score, text_reasons, chunk_count, text_aggregation, text_mode.

    Chunks live in an array of the row, so no row leaves its partition.
    """
    chunked = emails.withColumn("_merged", tr.merged_text(F.col("subject"), F.col("body_text")))
    chunked = chunked.withColumn("_chunks", tr.chunk_array(F.col("_merged")))
    chunked = chunked.withColumn("_scores", tr.chunk_scores(F.col("_chunks"), rules.text_keywords))
    chunked = chunked.withColumn("_value", tr.roll_up(F.col("_scores"), aggregation))
    n_chunks = F.size("_scores")
    scored = n_chunks > 0
    return chunked.withColumns({
        "text_score": F.coalesce(round2(F.col("_value") * 100), F.lit(0.0)),
        "text_reasons": tr.text_reasons(F.col("_value"), n_chunks),
        "chunk_count": n_chunks,
        "text_aggregation": F.when(scored, F.lit(aggregation)),
        "text_mode": F.when(scored, F.lit("heuristic")),
    }).drop("_merged", "_chunks", "_scores", "_value")
