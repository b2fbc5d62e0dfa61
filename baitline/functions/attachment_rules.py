"""Attachment name and extension expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.rules import RuleSet


def clean_extension(extension: Column) -> Column:
    return F.btrim(F.lower(extension), F.lit("."))


def judge_attachments(attachments: Column, rules: RuleSet) -> Column:
    """array<attachment> -> array<struct<points, reason>>, file by file in rule order."""
    known = F.transform(attachments, lambda a: F.struct(
        a["filename"].alias("filename"), clean_extension(a["extension"]).alias("extension"),
        F.lower(a["filename"]).alias("low")))

    def finding(kind: str, test: Column, filename: Column) -> Column:
        return F.when(test, F.struct(
            F.lit(fv.ATTACHMENT_POINTS[kind]).alias("points"),
            F.concat(F.lit(fv.ATTACHMENT_REASONS[kind]), filename).alias("reason")))

    def findings(s: Column) -> Column:
        name, extension = s["filename"], s["extension"]
        last = F.substring_index(s["low"], ".", -1)
        doubled = (F.size(F.split(s["low"], r"\.")) >= 3) & last.isin(rules.executable_extensions)
        return F.array_compact(F.array(
            finding("executable", extension.isin(rules.executable_extensions), name),
            finding("macro", extension.isin(rules.macro_extensions), name),
            finding("archive", extension.isin(rules.archive_extensions), name),
            finding("double", doubled, name)))

    return F.flatten(F.transform(known, findings))


def capped_points(found: Column) -> Column:
    total = F.aggregate(found, F.lit(0), lambda acc, f: acc + f["points"])
    return F.least(F.lit(100.0), total.cast("double"))
