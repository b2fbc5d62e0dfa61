"""Registered queries of this subpackage: one thin query per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baitline.llm.common import read
from baitline.llm import language_id, suffix_tree_lm, topk_search, toxicity
from baitline.llm.decontamination import with_leaks
from baitline.llm.importance_resampling import resample
from baitline.llm.jaccard_join import jaccard_components
from baitline.llm.license_scan import known_digests, scan_licenses
from baitline.llm.line_dedup import drop_repeated_lines
from baitline.llm.negative_mining import hard_negatives
from baitline.llm.sentencepiece_codec import with_ids_and_decoded
from baitline.llm.sharding import shard_by_bytes
from baitline.llm.token_counts import with_token_count


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return read(spark, folder, "documents").select(*(columns or ("doc_id", "text")))


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = shard_by_bytes(documents(spark, folder), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings").filter(topk_search.usable(F.col("embedding")))
    rows = rows.select("vec_id", topk_search.quantised(F.col("embedding")).alias("vector"))
    return topk_search.top_k(rows, rows.filter("vec_id % 50 = 0"), 5)


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """One row per leaked item of a document."""
    marked = with_leaks(documents(spark, folder), read(spark, folder, "benchmark"), keep=["doc_id"])
    leak = F.col("leak")
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", leak.item_id.alias("item_id"), leak.n_words.alias("n_words"),
        leak.n_covered.alias("n_covered"), F.size(leak.tiles).alias("n_tiles"),
        (leak.n_covered / leak.n_words).alias("coverage"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "text", "lang")
    learn = language_id.learnable(F.col("doc_id"), 4, 2)
    model = language_id.fit(docs.filter(learn))
    found = language_id.with_language(docs.drop("lang"), model, keep=["doc_id"])
    return found.select("doc_id", (~learn).alias("held_out"), "lang_pred", "score", "rejected")


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    coded = with_ids_and_decoded(documents(spark, folder), model_path()).drop("text")
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(decimal, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(documents(spark, folder))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = with_token_count(documents(spark, folder), model_path())
    return counted.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    learn = language_id.learnable(F.col("doc_id"), 5, 0)
    labels = read(spark, folder, "labels").select("doc_id", "toxic")
    labels = labels.filter(learn & F.col("toxic").isNotNull())
    model = toxicity.fit(docs.filter(learn), labels)
    scored = toxicity.with_toxicity(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (~learn).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(documents(spark, folder), known_digests(spark))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = drop_repeated_lines(documents(spark, folder))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_negative_mining(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings").filter(topk_search.usable(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), topk_search.quantised(F.col("embedding")).alias("vector"))
    return hard_negatives(rows, rows.filter("vec_id % 50 = 0"))


def op12_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    learn = language_id.learnable(F.col("doc_id"), 7, 2)
    scored = suffix_tree_lm.with_score(docs, suffix_tree_lm.fit(docs, learn))
    return scored.select("doc_id", (~learn).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample(documents(spark, folder), read(spark, folder, "benchmark"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_topk_search": op2_topk_search,
    "op3_decontamination": op3_decontamination,
    "op4_language_id": op4_language_id,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_license_scan": op9_license_scan,
    "op10_line_dedup": op10_line_dedup,
    "op11_negative_mining": op11_negative_mining,
    "op12_lm_scoring": op12_lm_scoring,
    "op13_importance_resampling": op13_importance_resampling,
}
