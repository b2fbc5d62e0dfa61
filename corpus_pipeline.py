"""Cleaning of a text corpus: stages that each take the documents their predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baitline.llm import language_id as languages
from baitline.llm.common import read, saved, shared_folder
from baitline.llm.decontamination import with_leaks
from baitline.llm.jaccard_join import jaccard_components
from baitline.llm.line_dedup import drop_repeated_lines
from baitline.llm.queries import model_path
from baitline.llm.sentencepiece_codec import with_ids_and_decoded
from baitline.plans.scale import measure

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go; a missing language is filled in."""
    learn = languages.learnable(F.col("doc_id"), 4, 2)
    found = languages.with_language(docs, languages.fit(docs.filter(learn)))
    found = found.filter("NOT rejected").withColumn("lang", F.coalesce("lang", "lang_pred"))
    return found.select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a smaller id holds go."""
    return drop_repeated_lines(docs).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingle sets the one with the smallest id stays.

    A row is told by its id and text together: an id with two texts loses only the one that is a near
    copy, a row that occurs twice stays once, and rows without an id are linked like all others but
    stay only if nobody with an id is in their group. Documents without words are linked with nothing and stay.
    """
    folder, names = shared_folder(spark), [*COLUMNS, "_row"]
    own = F.xxhash64(F.struct("doc_id", "text"))
    docs = docs.select(*COLUMNS).withColumn("_row", own)
    classes = saved(jaccard_components(docs.select("_row", "text"), "_row").select(
        F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")).distinct(), folder, "classes")
    joined = classes.filter("_group <> _row").select("_group").distinct()
    members = classes.join(joined, "_group", "left_semi")
    named = docs.select("_row", "doc_id").join(members, "_row")
    first = named.groupBy("_group").agg(F.min_by("_row", F.struct(
        F.col("doc_id").isNull(), "doc_id", "_row")).alias("_row"))
    gone = saved(members.select("_row").join(first, "_row", "left_anti"), folder, "gone")
    kept = docs.join(F.broadcast(gone) if measure(gone).fits_broadcast else gone, "_row", "left_anti")
    again = saved(docs.groupBy("_row").count().filter("count > 1").select("_row"), folder, "again")
    size = measure(again)
    if size.rows:
        again = F.broadcast(again) if size.fits_broadcast else again
        once = kept.join(again, "_row", "left_semi").dropDuplicates(["_row"])
        kept = kept.join(again, "_row", "left_anti").select(*names).unionByName(once.select(*names))
    return kept.select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    marked = with_leaks(docs, read(spark, sf_dir, "benchmark"))
    return marked.filter(F.size("leaks") == 0).select(*COLUMNS)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left becomes ids; the decoded text is kept beside them."""
    return with_ids_and_decoded(docs.select(*COLUMNS), model_path())


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("SentencePiece", sentencepiece),
]

# Trained language identification and piece merging have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, docs = shared_folder(spark), read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), folder, f"stage-{k}")
    return docs
