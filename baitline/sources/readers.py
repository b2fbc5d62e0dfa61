"""Readers. Columns are taken by name; no type is inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from baitline import fixed_values as fv
from baitline.functions.strings import SPACE_CLASS, web_strip
from baitline.operators.datasets import decode_mail, mail_to_training, rejected_mail, url_lines
from baitline.operators.features import training_text
from baitline.plans.scale import cut_lineage
from baitline.schemas import LABELLED_URL, PREDICTION
from baitline.sources.mail_archive import read_archive, read_archive_stream
from baitline.sources.quoted_csv import read_quoted_csv

REQUIRED_TRAINING = ["body_text", "label", "subject"]
FILLED = {"classic": ["sender_email", "urls", "attachments"],
          "tagged": ["sender_email", "sender_name", "subject", "body_text", "urls", "attachments"]}


def read_raw_emails(spark: SparkSession, path: str) -> DataFrame:
    """One JSON text per line as ``raw``; checking it is the intake's work."""
    return spark.read.text(path).withColumnRenamed("value", "raw")


def read_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Header CSV, all text; large files are read by many tasks either way.

    ``multiline=False`` is for files without line breaks inside quotes: Spark splits them
    without a look at the quotes. A file of a folder whose header differs is an error: its
    columns would be mixed up.
    """
    if multiline:
        return read_quoted_csv(spark, path)
    return (spark.read.option("header", True).option("enforceSchema", False).option("quote", '"')
            .option("escape", '"').csv(path))


def read_training_csv(spark: SparkSession, path: str, layout: str = "classic",
                      multiline: bool = True) -> DataFrame:
    """Training mail with ``text`` added; fails when a required column is absent."""
    df = read_csv(spark, path, multiline)
    missing = [c for c in REQUIRED_TRAINING if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    blanks = {c: F.lit("") for c in FILLED[layout] if c not in df.columns}
    filled = df.withColumns(blanks) if blanks else df
    texts = {c: F.coalesce(F.col(c), F.lit("")) for c in filled.columns if c != "label"}
    return training_text(filled.withColumns({**texts, "label": F.col("label").cast("int")}),
                         layout)


def read_mail_archive(spark: SparkSession, folder: str, limit: int | None = None, **options: object) -> DataFrame:
    """Training rows (label 1) of an archive of mails and mailboxes; with a limit of its first files."""
    return mail_to_training(decode_mail(read_archive(spark, folder, limit=limit or None, **options)))


def read_mail_archive_checked(spark: SparkSession, folder: str, **options: object) -> tuple[DataFrame, DataFrame]:
    """Training rows, and the mails that could not be read with the reason. Mails are decoded once."""
    decoded = cut_lineage(decode_mail(read_archive(spark, folder, **options)))
    return mail_to_training(decoded), rejected_mail(decoded)


def read_mail_archive_stream(spark: SparkSession, folder: str, **options: object) -> DataFrame:
    """Training rows of mails as they arrive."""
    return mail_to_training(decode_mail(read_archive_stream(spark, folder, **options)))


def read_url_lines(spark: SparkSession, path: str) -> DataFrame:
    """Distinct stripped lines. Bytes that are not UTF-8 are dropped."""
    lines = spark.read.text(path)
    # Undecodable bytes show up as the replacement character.
    return url_lines(lines.select(F.translate("value", "�", "").alias("value")))


def parse_feed(raw: DataFrame, column: str = "value", out: str = "domain") -> DataFrame:
    """Values split at commas and whitespace, lower-cased, distinct."""
    tokens = raw.select(F.explode(F.split(F.col(column), f"[,{SPACE_CLASS[1:-1]}]+")).alias("t"))
    return tokens.select(F.lower("t").alias(out)).filter(F.col(out) != "").distinct()


def read_reputation_feed(spark: SparkSession, path: str | None, column: str = "domain"
                         ) -> DataFrame:
    """A feed file as one column; the built-in values when there is no file or no value."""
    defaults = fv.DEFAULT_BAD_DOMAINS if column == "domain" else fv.DEFAULT_BAD_IPS
    fallback = spark.createDataFrame([(v,) for v in defaults], f"{column} string")
    if path is None:
        return fallback
    feed = parse_feed(spark.read.text(path), "value", column)
    return fallback if feed.isEmpty() else feed


def parse_domains(raw: DataFrame, action: str, column: str = "value") -> DataFrame:
    """Comma-separated domains -> (domain, action)."""
    tokens = raw.select(F.explode(F.split(F.col(column), ",")).alias("t"))
    return (tokens.select(F.lower(web_strip(F.col("t"))).alias("domain")).filter("domain <> ''")
            .distinct().withColumn("action", F.lit(action)))


def read_domain_policy(spark: SparkSession, allow: str | None = None, block: str | None = None
                       ) -> DataFrame:
    """Allow and block list files as one policy table."""
    policy = spark.createDataFrame([], "domain string, action string")
    for action, path in (("allow", allow), ("block", block)):
        if path is not None:
            policy = policy.unionByName(parse_domains(spark.read.text(path), action))
    return policy


def _by_name(held: DataFrame, schema: StructType) -> DataFrame:
    return held.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_labelled_urls(spark: SparkSession, path: str) -> DataFrame:
    """url and y_true of a header CSV, wherever the columns stand."""
    return _by_name(read_csv(spark, path), LABELLED_URL)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """y_true and y_pred of a header CSV, wherever the columns stand."""
    return _by_name(read_csv(spark, path), PREDICTION)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")
