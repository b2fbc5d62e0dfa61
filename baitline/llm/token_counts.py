"""Token counts and token budgets of whole texts, without encoding anything twice.

A table over a text holds the exact number of tokens at every prefix: counts inside a run
come from the run's table of prefixes, and runs add up. From one such table any question
about a truncation is answered: tokens of the first n characters, or the longest prefix
that stays within a budget.

Cases: a null or empty text has 0 tokens; a prefix length below 0 counts as 0 and one
beyond the text as the whole text; a budget below 0 allows 0 characters; null lengths or
budgets give null; repeated rows and ties change nothing; columns of the input named like an
output column are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from baitline.llm.common import text_slices
from baitline.llm.pieces import coder_of, load_vocabulary
from baitline.llm.sentencepiece_codec import _schema, _with

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def with_token_count(df: DataFrame, model: str, text: str = "text",
                     out: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of every whole text. Nothing is shuffled."""
    vocabulary = df.sparkSession.sparkContext.broadcast(load_vocabulary(model))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(vocabulary.value, model)
        for rows, _, _ in text_slices(batches, text, memo=coder.memo_key):
            texts = rows.column(rows.schema.get_field_index(text)).fill_null("").to_pylist()
            yield _with(rows, {out: pa.array(coder.counts(texts), pa.int64())})
    return df.mapInArrow(count, _schema(df, **{out: T.LongType()}))


def with_prefix_answers(df: DataFrame, model: str, text: str = "text",
                        lengths: list[int] = (), budgets: list[int] = ()) -> DataFrame:
    """Add ``tokens_at``: tokens of the first n characters for each of ``lengths``, and
    ``chars_within``: characters of the longest prefix of at most n tokens for each of ``budgets``.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(load_vocabulary(model))
    lengths, budgets = list(lengths), list(budgets)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(vocabulary.value, model)
        for rows, _, _ in text_slices(batches, text, memo=coder.memo_key):
            at, within = [], []
            for own in rows.column(rows.schema.get_field_index(text)).fill_null("").to_pylist():
                table = np.array(coder.prefix_counts(own))
                at.append([None if n is None else int(table[min(max(n, 0), len(own))])
                           for n in lengths])
                # A longer prefix may have fewer tokens, so the last one that fits is asked for.
                fits = [None if n is None else np.flatnonzero(table <= n) for n in budgets]
                within.append([None if f is None else int(f[-1]) if len(f) else 0 for f in fits])
            kind = pa.list_(pa.int64())
            yield _with(rows, {"tokens_at": pa.array(at, kind),
                               "chars_within": pa.array(within, kind)})
    longs = T.ArrayType(T.LongType())
    return df.mapInArrow(answer, _schema(df, tokens_at=longs, chars_within=longs))
