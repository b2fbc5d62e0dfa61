"""Text classifiers on Spark ML: features, training, evaluation and scoring."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer, SQLTransformer,
    VectorAssembler,
)
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from baitline import fixed_values as fv
from baitline.functions import text_rules as tr
from baitline.functions.strings import round2
from baitline.operators.features import (
    WORD, hand_features, ngram_vocabulary, with_class_weight,
)
from baitline.operators.metrics import binary_metrics
from baitline.operators.text import score_text
from baitline.plans.scale import UNBOUNDED, cut_lineage, lookup_join

ROWS_PER_PARTITION = 5_000
HAND_FEATURES = ["keyword_hits", "has_ip_url", "url_count", "has_free_sender"]


def fit_text_features(train: DataFrame, vocabulary: int = fv.MAX_FEATURES) -> PipelineModel:
    """tf-idf over words and word pairs, unit length, column ``tfidf``.

    One counting pass over the text gives the vocabulary and, with it, the document
    counts, so no separate pass is needed to fit the idf ln((1+n)/(1+df)) + 1. The
    vocabulary is bounded by its size limit and fits the driver.
    """
    terms = ngram_vocabulary(train, vocabulary).collect()
    n_docs = train.count()
    idf = [math.log((1 + n_docs) / (1 + t["n_docs"])) + 1.0 for t in terms]
    counts = CountVectorizerModel.from_vocabulary(
        [t["term"] for t in terms], inputCol="terms", outputCol="counts")
    return PipelineModel(stages=[
        RegexTokenizer(inputCol="text", outputCol="words", pattern=WORD, gaps=False,
                       toLowercase=True),
        NGram(n=2, inputCol="words", outputCol="pairs"),
        SQLTransformer(statement="SELECT *, concat(words, pairs) AS terms FROM __THIS__"),
        counts,
        ElementwiseProduct(inputCol="counts", outputCol="scaled", scalingVec=Vectors.dense(idf)),
        Normalizer(inputCol="scaled", outputCol="tfidf", p=2.0),
        SQLTransformer(statement="SELECT * EXCEPT (words, pairs, terms, counts, scaled)"
                                 " FROM __THIS__"),
    ])


def assemble_features(df: DataFrame, text_model: PipelineModel,
                      with_hand_features: bool = True) -> DataFrame:
    """Adds ``features``: tf-idf, followed by the four hand-made features unscaled."""
    held = text_model.transform(df)
    if with_hand_features:
        held = hand_features(held)
    inputs = ["tfidf"] + (HAND_FEATURES if with_hand_features else [])
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(held)


def logistic_regression(n_rows: int) -> LogisticRegression:
    """L2 with strength 1/n: class weights that sum to n and a penalty factor C of 1."""
    return LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight", predictionCol="y_pred",
        regParam=1.0 / n_rows, elasticNetParam=0.0, standardization=False,
        maxIter=fv.MAX_ITERATIONS, tol=fv.TOLERANCE)


def train_classifier(train: DataFrame, with_hand_features: bool = True,
                     vocabulary: int = fv.MAX_FEATURES) -> PipelineModel:
    """Balanced L2 logistic regression. One saved pipeline holds everything to score.

    The feature matrix is checkpointed: the optimiser passes over it many times and
    must not run the tokeniser again, nor lose it with an executor.
    """
    text_model = fit_text_features(train, vocabulary)
    weighted = with_class_weight(train)
    matrix = cut_lineage(assemble_features(weighted, text_model, with_hand_features)
                         .select("features", F.col("label").cast("double").alias("label"),
                                 "weight"))
    n_rows = matrix.count()
    # An iteration over few rows is all scheduling: fewer, fuller partitions then.
    parts = min(matrix.rdd.getNumPartitions(), max(1, n_rows // ROWS_PER_PARTITION))
    classifier = logistic_regression(n_rows).fit(matrix.coalesce(parts))
    inputs = ["tfidf"] + (HAND_FEATURES if with_hand_features else [])
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    return PipelineModel(stages=[*text_model.stages, assembler, classifier])


def predict(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds y_pred; hand features are computed when the model reads them."""
    reads_hand = any(isinstance(s, VectorAssembler) and len(s.getInputCols()) > 1
                     for s in model.stages)
    return model.transform(hand_features(df) if reads_hand else df).withColumn(
        "y_pred", F.col("y_pred").cast("int"))


def evaluate_model(validation: DataFrame, model: PipelineModel) -> DataFrame:
    """accuracy, precision, recall, f1, unrounded."""
    return binary_metrics(predict(validation, model), truth="label", digits=None)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str | None) -> PipelineModel | None:
    """The saved model, or None when there is none at the path; a failing read is an error."""
    if not path:
        return None
    spark = SparkSession.active()
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return PipelineModel.load(path)


def _merged(emails: DataFrame, key: str) -> DataFrame:
    """Key, merged text and a hash of it. Scores depend on nothing but the text."""
    merged = emails.select(key, tr.merged_text(F.col("subject"), F.col("body_text")).alias("_t"))
    return merged.withColumn("_text_id", F.struct(
        F.xxhash64("_t").alias("a"), F.xxhash64(F.lit(1), "_t").alias("b")))


def _chunk_rows(merged: DataFrame) -> DataFrame:
    """Chunks of every different text: copies of a mail are scored once."""
    texts = merged.groupBy("_text_id").agg(F.first("_t").alias("_t"))
    return texts.select("_text_id", F.explode_outer(tr.chunk_array(F.col("_t"))).alias("text"))


def _back_to_mails(merged: DataFrame, rolled: DataFrame, key: str) -> DataFrame:
    """One row per mail, copies included; a text of many mails is spread over many tasks."""
    mails = merged.select(key, "_text_id").withColumn("_row", F.monotonically_increasing_id())
    return lookup_join(mails, rolled, "_text_id", ["_row"], how="inner", size=UNBOUNDED
                       ).drop("_text_id", "_row")


def _roll_up_rows(scored: DataFrame, aggregation: str) -> DataFrame:
    # All chunks of a text come out of one task, so the map-side combine sends one row
    # per text.
    key = "_text_id"
    pick = {"mean": F.avg, "max": F.max}[aggregation]
    value, n = F.col("_value"), F.col("chunk_count")
    rolled = scored.groupBy(key).agg(pick("_p").alias("_value"),
                                     F.count("text").alias("chunk_count"))
    return rolled.select(
        key, F.coalesce(round2(value * 100), F.lit(0.0)).alias("text_score"),
        tr.text_reasons(value, n, from_model=True).alias("text_reasons"),
        n.cast("int").alias("chunk_count"),
        F.when(n > 0, F.lit(aggregation)).alias("text_aggregation"),
        F.when(n > 0, F.lit("transformer")).alias("text_mode"))


def score_text_with_model(emails: DataFrame, model: PipelineModel, aggregation: str = "mean",
                          key: str = "email_id") -> DataFrame:
    """Text indicator table from a text-only model: class-1 probability per chunk, rolled up."""
    merged = _merged(emails, key)
    chunks = _chunk_rows(merged)
    # Empty mails keep one row with a null text for the roll-up; the model sees "".
    held = chunks.withColumn("_text", F.col("text")).withColumn(
        "text", F.coalesce("text", F.lit("")))
    seen = model.transform(held)
    scored = seen.select("_text_id", F.col("_text").alias("text"), F.when(
        F.col("_text").isNotNull(), vector_to_array("probability")[1]).alias("_p"))
    return _back_to_mails(merged, _roll_up_rows(scored, aggregation), key)


def class_one(logits: Column) -> Column:
    """Sigmoid of a single logit, else the softmax share of class 1."""
    top = F.array_max(logits)
    parts = F.transform(logits, lambda x: F.exp(x - top))
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(logits) == 1, 1 / (1 + F.exp(-F.get(logits, F.lit(0))))).otherwise(
        F.get(parts, F.lit(1)) / total)


def score_text_with_fn(emails: DataFrame,
                       make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]],
                       aggregation: str = "mean", batch_size: int = 256,
                       key: str = "email_id") -> DataFrame:
    """As :func:`score_text_with_model` for any user model: texts in, logits (n, k) out.

    ``make_predict_fn`` loads the model once per Python worker; texts arrive in batches.
    """
    infer = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.DoubleType()),
                              batch_size=batch_size)
    merged = _merged(emails, key)
    logits = _chunk_rows(merged).withColumn("_logits", infer(F.coalesce("text", F.lit(""))))
    scored = logits.select("_text_id", "text", F.when(F.col("text").isNotNull(),
                                               class_one(F.col("_logits"))).alias("_p"))
    return _back_to_mails(merged, _roll_up_rows(scored, aggregation), key)


def score_text_auto(emails: DataFrame, model_path: str | None, aggregation: str = "mean",
                    key: str = "email_id") -> DataFrame:
    """Model scores when a model can be loaded, keyword scores otherwise."""
    model = load_model(model_path)
    if model is not None:
        return score_text_with_model(emails, model, aggregation, key)
    return score_text(emails, aggregation).select(
        key, "text_score", "text_reasons", "chunk_count", "text_aggregation", "text_mode")
