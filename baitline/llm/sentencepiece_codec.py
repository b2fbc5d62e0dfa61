"""SentencePiece encoding and decoding of whole texts, exact to the id.

Cases: a null or empty text has no ids and decodes to an empty text; characters outside the
vocabulary become byte ids; repeated rows and ties change nothing; texts of any length are
coded whole; columns of the input named like an output column are replaced; an empty table
gives an empty table.
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

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _with(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + list(columns.values()),
                                      names=names + list(columns))


def _schema(df: DataFrame, **columns: T.DataType) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name not in columns]
    return T.StructType(kept + [T.StructField(n, kind) for n, kind in columns.items()])


def with_ids(df: DataFrame, model: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the ids of every text as an array of integers.

    ``model`` is the path of a SentencePiece BPE model on the driver. Its vocabulary (a few
    hundred kB whatever the data) is broadcast; texts stay where they are.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(load_vocabulary(model))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(vocabulary.value, model)
        for rows, _, _ in text_slices(batches, text, memo=coder.memo_key):
            texts = rows.column(rows.schema.get_field_index(text)).fill_null("").to_pylist()
            coded = coder.encode(texts)
            ends = np.cumsum([0] + [len(c) // 4 for c in coded]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(coded), np.int32))
            yield _with(rows, {out: pa.ListArray.from_arrays(pa.array(ends), ids)})
    return df.mapInArrow(encode, _schema(df, **{out: T.ArrayType(T.IntegerType())}))


def with_decoded(df: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of every array of ids; a null array is an empty text, null ids are left out."""
    vocabulary = df.sparkSession.sparkContext.broadcast(load_vocabulary(model))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(vocabulary.value, model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                lists = rows.column(rows.schema.get_field_index(ids)).to_pylist()
                texts = [coder.decode([i for i in own or () if i is not None]) for own in lists]
                yield _with(rows, {out: pa.array(texts, pa.string())})
    return df.mapInArrow(decode, _schema(df, **{out: T.StringType()}))


def with_ids_and_decoded(df: DataFrame, model: str, text: str = "text", ids: str = "ids",
                         out: str = "decoded") -> DataFrame:
    """Both steps in one pass: the ids of every text, and the text of these ids."""
    vocabulary = df.sparkSession.sparkContext.broadcast(load_vocabulary(model))

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(vocabulary.value, model)
        for rows, _, _ in text_slices(batches, text, memo=coder.memo_key):
            texts = rows.column(rows.schema.get_field_index(text)).fill_null("").to_pylist()
            coded = coder.encode(texts)
            ends = np.cumsum([0] + [len(c) // 4 for c in coded]).astype(np.int32)
            every = np.frombuffer(b"".join(coded), np.int32)
            decoded = [coder.decode(every[a:b].tolist()) for a, b in zip(ends, ends[1:])]
            yield _with(rows, {ids: pa.ListArray.from_arrays(pa.array(ends), pa.array(every)),
                               out: pa.array(decoded, pa.string())})
    return df.mapInArrow(both, _schema(df, **{ids: T.ArrayType(T.IntegerType()),
                                              out: T.StringType()}))
