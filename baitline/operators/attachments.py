"""Attachment indicator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline.functions import attachment_rules as ar
from baitline.rules import DEFAULT_RULES, RuleSet


def score_attachments(emails: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Adds attachment_score, attachment_reasons, attachment_count. Map-only."""
    held = emails.withColumn("_found", ar.judge_attachments(F.col("attachments"), rules))
    none = F.col("attachments").isNull()
    return held.withColumns({
        "attachment_score": F.coalesce(ar.capped_points(F.col("_found")), F.lit(0.0)),
        "attachment_reasons": F.coalesce(F.transform("_found", lambda f: f["reason"]),
                                         F.array().cast("array<string>")),
        "attachment_count": F.when(none, 0).otherwise(F.size("attachments")),
    }).drop("_found")
