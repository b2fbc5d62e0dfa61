"""Validation and normalisation of raw JSON mail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions.attachment_rules import clean_extension
from baitline.functions.strings import strip
from baitline.plans.scale import filter_late

_NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN)$"
_FIELDS = ["sender_email", "sender_name", "subject", "body_text", "urls", "attachments",
           "page_source"]


def _field(name: str) -> Column:
    """The field's value as a variant, read from the text once."""
    return F.col(f"_value_{name}")


def _kind(name: str) -> Column:
    """Type name of a field; null when it is absent, VOID for a JSON null."""
    return F.col(f"_kind_{name}")


def _is_text(name: str) -> Column:
    return F.coalesce(_kind(name) == "STRING", F.lit(False))


def _is_list(name: str) -> Column:
    return F.coalesce(_kind(name).startswith("ARRAY"), F.lit(False))


def _item_is_text(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def _items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _complaint(ok: Column, message) -> Column:
    return F.when(~ok, message if isinstance(message, Column) else F.lit(message))


def _attachment_errors(attachments: Column) -> Column:
    def of_item(item: Column, i: Column) -> Column:
        where = F.concat(F.lit("attachments["), i.cast("string"), F.lit("]"))

        def part(name: str) -> Column:
            return F.try_variant_get(item, f"$.{name}", "variant")

        number = F.coalesce(F.schema_of_variant(part("size_kb")).rlike(_NUMBER), F.lit(False))
        listed = F.array_compact(F.array(*[
            _complaint(number if name == "size_kb" else _item_is_text(part(name)),
                       F.concat(where, F.lit(f".{name} must be "
                                             f"{'numeric' if name == 'size_kb' else 'a string'}")))
            for name in ("filename", "extension", "size_kb", "mime_type")]))
        is_object = F.coalesce(F.schema_of_variant(item).startswith("OBJECT"), F.lit(False))
        return F.when(is_object, listed).otherwise(
            F.array(F.concat(where, F.lit(" must be an object"))))

    return F.flatten(F.transform(_items(attachments), of_item))


def _errors() -> Column:
    missing = F.array_compact(F.array(*[
        F.when(_kind(f).isNull(), F.lit(f"Missing required field: {f}"))
        for f in fv.REQUIRED_FIELDS]))
    address, name = F.try_variant_get(_field("sender_email"), "$", "string"), _kind("sender_name")
    filled = F.coalesce(strip(address) != "", F.lit(False))
    all_text = _is_list("urls") & F.coalesce(
        F.forall(_items(_field("urls")), _item_is_text), F.lit(False))
    wrong = F.concat(
        F.array_compact(F.array(
            _complaint(_is_text("sender_email") & filled,
                       "sender_email must be a non-empty string"),
            _complaint(name.isNull() | name.isin("VOID", "STRING"),
                       "sender_name must be a string when provided"),
            _complaint(_is_text("subject"), "subject must be a string"),
            _complaint(_is_text("body_text"), "body_text must be a string"),
            _complaint(all_text, "urls must be a list of strings"),
            _complaint(_is_list("attachments"), "attachments must be a list"))),
        F.when(_is_list("attachments"), _attachment_errors(_field("attachments")))
        .otherwise(F.array().cast("array<string>")))
    return (F.when(~F.col("_is_object"), F.array(F.lit(fv.NOT_AN_OBJECT)))
            .when(F.size(missing) > 0, missing).otherwise(wrong))


def check_emails(raw: DataFrame, column: str = "raw") -> DataFrame:
    """Parse JSON text and add ``errors`` plus the typed fields, in one narrow pass.

    ``email_id`` is a hash of the text unless the input already has one: stable when a
    task is retried, and equal texts have equal verdicts.
    """
    def text(name: str) -> Column:
        return F.when(_is_text(name), F.try_variant_get(_field(name), "$", "string"))

    def of_attachment(item: Column) -> Column:
        size = F.try_variant_get(item, "$.size_kb", "double")
        flag = F.try_variant_get(item, "$.size_kb", "boolean").cast("int").cast("double")
        return F.struct(
            F.try_variant_get(item, "$.filename", "string").alias("filename"),
            F.try_variant_get(item, "$.extension", "string").alias("extension"),
            F.coalesce(size, flag).alias("size_kb"),
            F.try_variant_get(item, "$.mime_type", "string").alias("mime_type"))

    held = raw.withColumn("_doc", F.try_parse_json(F.col(column)))
    if "email_id" not in raw.columns:
        held = held.withColumn("email_id", F.sha2(F.coalesce(F.col(column), F.lit("")), 256))
    is_object = F.schema_of_variant(F.col("_doc")).startswith("OBJECT")
    held = held.withColumn("_is_object", F.coalesce(is_object, F.lit(False)))
    held = held.withColumns({f"_value_{f}": F.try_variant_get(F.col("_doc"), f"$.{f}", "variant")
                             for f in _FIELDS})
    held = held.withColumns({f"_kind_{f}": F.schema_of_variant(_field(f)) for f in _FIELDS})
    held = held.withColumn("errors", _errors())
    valid = F.size("errors") == 0
    parsed = {f: text(f) for f in ("sender_email", "sender_name", "subject", "body_text",
                                   "page_source")}
    parsed["urls"] = F.try_variant_get(_field("urls"), "$", "array<string>")
    parsed["attachments"] = F.transform(_items(_field("attachments")), of_attachment)
    helpers = ["_doc", "_is_object", *[f"_{part}_{f}" for part in ("value", "kind")
                                       for f in _FIELDS]]
    return held.withColumns({f: F.when(valid, parsed[f]) for f in _FIELDS}).drop(*helpers)


def accepted(checked: DataFrame, column: str = "raw") -> DataFrame:
    return filter_late(checked, F.size("errors") == 0).drop("errors", column)


def rejected(checked: DataFrame, column: str = "raw") -> DataFrame:
    return filter_late(checked, F.size("errors") > 0).select("email_id", column, "errors")


def validate_emails(raw: DataFrame, column: str = "raw") -> tuple[DataFrame, DataFrame]:
    """Valid mails and the rejected texts with every complaint about them."""
    checked = check_emails(raw, column)
    return accepted(checked, column), rejected(checked, column)


def normalize_emails(emails: DataFrame) -> DataFrame:
    """Strip sender fields, clean extensions, sizes as doubles."""
    files = F.transform("attachments", lambda a: F.struct(
        a["filename"].alias("filename"), clean_extension(a["extension"]).alias("extension"),
        a["size_kb"].cast("double").alias("size_kb"), a["mime_type"].alias("mime_type")))
    return emails.withColumns({
        "sender_email": strip(F.col("sender_email")),
        "sender_name": strip(F.col("sender_name")),
        "attachments": files,
    })
