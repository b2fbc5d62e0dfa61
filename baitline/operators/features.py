"""Training text, hand-made features, class weights and the n-gram vocabulary."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions.strings import any_contained, blank_if_null, count_contained, count_of, strip
from baitline.operators.heavy_hitters import SIZE, candidates, few_values

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = r"[\p{L}\p{N}_]{2,}"
MAX_CLASSES = 1000


def _held(column: str) -> Column:
    return strip(blank_if_null(F.col(column).cast("string")))


def training_text(df: DataFrame, layout: str = "classic") -> DataFrame:
    """Adds ``text``: subject and body, or all five fields behind their tags."""
    if layout == "classic":
        return df.withColumn("text", strip(F.concat_ws(" ", _held("subject"), _held("body_text"))))
    if layout != "tagged":
        raise ValueError(f"layout must be 'classic' or 'tagged', not {layout!r}")
    fields = {"SENDER": "sender_email", "SUBJECT": "subject", "BODY": "body_text",
              "URLS": "urls", "ATTACHMENTS": "attachments"}
    pieces = [piece for tag, column in fields.items()
              for piece in (F.lit(f"[{tag}]"), _held(column))]
    return df.withColumn("text", F.concat_ws(" ", *pieces))


def hand_features(df: DataFrame) -> DataFrame:
    """Adds keyword_hits, has_ip_url, url_count, has_free_sender."""
    text = F.lower(F.concat_ws(" ", blank_if_null(F.col("subject")),
                               blank_if_null(F.col("body_text"))))
    urls, sender = F.lower(_held("urls")), F.lower(_held("sender_email"))
    ip_url = r"https?://\p{Nd}+\.\p{Nd}+\.\p{Nd}+\.\p{Nd}+"
    return df.withColumns({
        "keyword_hits": count_contained(text, fv.TRAINING_KEYWORDS),
        "has_ip_url": urls.rlike(ip_url).cast("int"),
        "url_count": count_of(urls, "http"),
        "has_free_sender": any_contained(sender, fv.TRAINING_FREE_PROVIDERS).cast("int"),
    })


def class_sizes(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """label, n_rows, weight = n / (classes * n_rows)."""
    # The window runs over the class table: one row per class, already counted.
    every = Window.partitionBy(F.lit(0))
    total, classes = F.sum("n_rows").over(every), F.count(F.lit(1)).over(every)
    return class_sizes(df, label).select(
        label, "n_rows", (total / (classes * F.col("n_rows"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``weight`` to every row. The class table becomes a literal, so a class with
    half of all rows is not shuffled to one place. A row without a label is an error."""
    rows = class_weights(df, label).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes: {label!r} is not a class label")
    if any(r[label] is None for r in rows):
        raise ValueError(f"rows without a {label}: filter them first")
    pairs = [F.lit(v) for r in rows for v in (r[label], r["weight"])]
    return df.withColumn("weight", F.element_at(F.create_map(*pairs), F.col(label)))


def words_of(text: Column) -> Column:
    """Lower-case words of two or more characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _pairs(words: Column) -> Column:
    return F.when(F.size(words) > 1, F.zip_with(
        F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1),
        lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))


def ngrams(text: Column) -> Column:
    """Words and their neighbouring pairs."""
    words = words_of(text)
    return F.concat(words, _pairs(words))


def _counted(terms: DataFrame, likely: np.ndarray) -> DataFrame:
    """Exact counts of the terms whose hash is among ``likely``: term, n_uses, n_docs.

    Each task counts for itself and sends one row per term.
    """
    known = terms.sparkSession.sparkContext.broadcast(likely)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = known.value
        uses, docs = np.zeros((2, len(wanted)), np.int64)
        names: list[str | None] = [None] * len(wanted)
        for whole in batches if len(wanted) else ():
            for batch in few_values(whole, ["word_ids", "pair_ids"]):
                words = batch.column("words").flatten()
                for column, width in (("word_ids", 1), ("pair_ids", 2)):
                    ids = batch.column(column)
                    doc = np.repeat(np.arange(len(ids)), ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                    flat = ids.flatten().to_numpy(zero_copy_only=False)
                    at = np.minimum(np.searchsorted(wanted, flat), len(wanted) - 1)
                    hit = np.flatnonzero(wanted[at] == flat)
                    term = at[hit]
                    uses += np.bincount(term, minlength=len(wanted))
                    docs += np.bincount(np.unique(doc[hit] * len(wanted) + term) % len(wanted), minlength=len(wanted))
                    new, first = np.unique(term, return_index=True)
                    # A pair begins at the word of the same number, less the last words of earlier texts.
                    skipped = np.zeros(len(ids) + 1, np.int64)
                    lengths = batch.column("words").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                    np.cumsum(np.minimum(lengths, width - 1), out=skipped[1:])
                    for t, k in zip(new.tolist(), hit[first].tolist()):
                        if names[t] is None:
                            start = k + int(skipped[doc[k]])
                            names[t] = " ".join(words[start + i].as_py() for i in range(width))
            pa.default_memory_pool().release_unused()
        seen = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[t] for t in seen], pa.string()), pa.array(uses[seen]), pa.array(docs[seen])],
            names=["term", "n_uses", "n_docs"])

    found = terms.mapInArrow(run, "term string, n_uses long, n_docs long")
    return found.groupBy("term").agg(F.sum("n_uses").alias("n_uses"), F.sum("n_docs").alias("n_docs"))


def ngram_vocabulary(df: DataFrame, n: int = fv.MAX_FEATURES, text: str = "text",
                     summary: int = SIZE) -> DataFrame:
    """The n most frequent terms: term, n_uses, n_docs.

    Summaries of bounded size find the terms that can be among them, a second pass counts these
    exactly: what is shuffled depends on the summaries and on n, not on the number of different terms. Where
    summaries cannot tell (see ``candidates``), every term is counted.
    """
    words = df.select(words_of(F.col(text)).alias("words"))
    hashed = words.select("words", F.transform("words", lambda w: F.xxhash64(w)).alias("word_ids"),
                          F.transform(_pairs(F.col("words")), lambda p: F.xxhash64(p)).alias("pair_ids"))
    likely = candidates(hashed.select(F.concat("word_ids", "pair_ids").alias("ids")), "ids", n, summary)
    counted = _counted(hashed, likely) if likely is not None else _all_counted(df, text)
    return counted.orderBy(F.desc("n_uses"), F.asc("term")).limit(n)


def _all_counted(df: DataFrame, text: str) -> DataFrame:
    """All terms, counted by one aggregation with a map-side combine: a document sends each of its
    uses, and once per different term a document mark."""
    terms = df.select(ngrams(F.col(text)).alias("terms"))
    marks = F.concat(
        F.transform("terms", lambda t: F.struct(t.alias("term"), F.lit(1).alias("use"),
                                                F.lit(0).alias("doc"))),
        F.transform(F.array_distinct("terms"), lambda t: F.struct(
            t.alias("term"), F.lit(0).alias("use"), F.lit(1).alias("doc"))))
    return (terms.select(F.explode(marks).alias("m"))
            .groupBy(F.col("m.term").alias("term"))
            .agg(F.sum("m.use").alias("n_uses"), F.sum("m.doc").alias("n_docs")))
