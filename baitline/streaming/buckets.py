"""Tabs in buckets: what a stream keeps per tab is read and written by bucket.

A call of the keyed state and a handler's run cost milliseconds, whatever they carry. By tab they would be most of a
job's time; by bucket their number does not grow with the tabs. A bucket is one task's work at a time, so its rows of a batch and its state
must fit a worker: take more buckets for more tabs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 256
# No leading underscore: Spark hands the rows of a group over as named tuples.
BUCKET = "bucket__"
MARK = "missing__"


def with_bucket(df: DataFrame, tab: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(tab), F.lit(buckets)).cast("int"))


def _marked(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if f.nullable and isinstance(f.dataType, IntegralType)]


def packed(df: DataFrame) -> DataFrame:
    """Integers that may be null as a number and a mark: pandas makes floats of a column with a null."""
    marked = _marked(df.schema)
    return df.select(*[F.coalesce(f.name, F.lit(0).cast(f.dataType)).alias(f.name) if f.name in marked else F.col(f.name)
                       for f in df.schema.fields], *[F.col(c).isNull().alias(MARK + c) for c in marked])


def unpacked(df: DataFrame, schema: StructType) -> DataFrame:
    marked = _marked(schema)
    return df.select(*[F.when(~F.col(MARK + f.name), F.col(f.name)).alias(f.name) if f.name in marked else F.col(f.name)
                       for f in schema.fields])


def sort_keys(rows: pd.DataFrame, order: list[str]) -> tuple[list[str], list[bool]]:
    """Columns to sort by, and which ascend: missing values come first."""
    names = [n for c in order for n in (MARK + c, c) if n in rows.columns]
    return names, [not n.startswith(MARK) for n in names]


def tab_keys(rows: pd.DataFrame, tab: str) -> list[str]:
    return [n for n in (MARK + tab, tab) if n in rows.columns]


def values_of(rows: pd.DataFrame, columns: list[str]) -> Iterator[tuple]:
    """Plain values of each row; a missing one is None."""
    return zip(*[rows[c].astype(object).where(rows[c].notna(), None).tolist() for c in columns])


def places(values: tuple) -> tuple:
    """A row's (ts, seq) with its marks as something to compare, missing ones first."""
    return tuple(not v if isinstance(v, bool) else (False, 0) if v is None else (True, v) for v in values)


def newest_rows(rows: pd.DataFrame, tab: list[str], order: list[str]) -> pd.DataFrame:
    names, ascending = sort_keys(rows, order)
    return rows.sort_values(names, ascending=ascending, na_position="first").drop_duplicates(tab, keep="last")
