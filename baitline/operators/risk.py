"""From four indicators to one verdict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions.strings import round2
from baitline.rules import DEFAULT_RULES, RuleSet

INDICATORS = ["text", "url", "sender", "attachment"]


def risk_level(score: Column) -> Column:
    return (F.when(score >= fv.HIGH_FROM, "high").when(score >= fv.MEDIUM_FROM, "medium")
            .otherwise("low"))


def recommended_action(level: Column) -> Column:
    return (F.when(level == "high", fv.ACTIONS["high"])
            .when(level == "medium", fv.ACTIONS["medium"]).otherwise(fv.ACTIONS["low"]))


def assemble_verdict(scored: DataFrame, rules: RuleSet = DEFAULT_RULES,
                     max_reasons: int | None = None) -> DataFrame:
    """Indicator columns on one row -> verdict columns on the same row.

    Reads ``<indicator>_score`` and ``<indicator>_reasons``; a missing score counts 0.
    All reasons are kept unless ``max_reasons`` is given.
    """
    value = {i: F.coalesce(F.col(f"{i}_score"), F.lit(0.0)) for i in INDICATORS}
    weighted = reduce(lambda a, b: a + b, [value[i] * rules.weights[i] for i in INDICATORS])
    said = F.concat(*[F.coalesce(F.col(f"{i}_reasons"), F.array().cast("array<string>"))
                      for i in INDICATORS])
    held = scored.withColumns({
        "risk_score": round2(F.least(F.lit(100.0), weighted)), "_said": said})
    held = held.withColumn("risk_level", risk_level(F.col("risk_score")))
    return held.withColumns({
        "reasons": F.when(F.size("_said") == 0, F.array(F.lit(fv.NO_REASON)))
        .otherwise(F.col("_said") if max_reasons is None else F.slice("_said", 1, max_reasons)),
        "indicators": F.struct(*[value[i].alias(i) for i in INDICATORS]),
        "recommended_action": recommended_action(F.col("risk_level")),
    }).drop("_said")


def combine_scores(text: DataFrame, url: DataFrame, sender: DataFrame, attachment: DataFrame,
                   key: str = "email_id", rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Four indicator tables (key, score, reasons; unique key) -> verdict table.

    One union and one aggregation on the key, so each table is shuffled once and a key
    that is missing from some of them still gets its verdict. A key that a table holds twice
    is an error: rows of different mails would be put together.
    """
    tables = dict(zip(INDICATORS, (text, url, sender, attachment)))
    tagged = reduce(DataFrame.unionByName, [
        t.select(key, F.lit(i).alias("_i"), F.col("score").cast("double").alias("score"), "reasons")
        for i, t in tables.items()])
    wide = tagged.groupBy(key).agg(*[
        F.first(F.when(F.col("_i") == i, F.col(c)), ignorenulls=True).alias(f"{i}_{c}" if c ==
                                                                           "reasons" else f"{i}_score")
        for i in INDICATORS for c in ("score", "reasons")],
        F.greatest(*[F.count(F.when(F.col("_i") == i, 1)) for i in INDICATORS]).alias("_most"))
    twice = F.raise_error(F.concat(F.lit(f"{key} is not unique: "), F.col(key).cast("string")))
    wide = wide.withColumn(key, F.when(F.col("_most") > 1, twice.cast(wide.schema[key].dataType))
                           .otherwise(F.col(key))).drop("_most")
    return assemble_verdict(wide, rules).select(
        key, "risk_score", "risk_level", "reasons", "indicators", "recommended_action")
