"""Last verdict per tab as a changelog: state that is forgotten in time, files that are compacted.

The stream remembers per tab only the place (ts, seq) of the newest row, and for ``forget_ms`` of processing
time after the tab was last seen. Tabs are handled by bucket, whose places are read at once. It lets through rows that are newer than that; what it lets through for a forgotten tab
may be old. A reader takes the newest row per tab, so forgetting costs a row in a file and never a
wrong answer, and the state stays as large as the set of tabs seen lately.

Every micro-batch is a folder of changes. After every ``compact_every`` batches all rows up to then are merged into one
per tab and published with the number of that batch; readers take this table and the few folders after it.
Folders of changes that the version before the newest does not need are deleted; published versions stay.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from baitline.streaming.buckets import (
    BUCKET, BUCKETS, newest_rows, packed, places, sort_keys, unpacked, values_of, with_bucket,
)
from baitline.sources.writers import newest_version, publish, read_published

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEW = 16  # up to so many tabs of a bucket are looked up one by one, beyond the bucket is read


class _Newer(StatefulProcessor):
    """Lets through the newest row of each tab of a bucket if no newer one is remembered."""

    def __init__(self, tab: str, kind: str, order: list[str], forget_ms: int):
        self._tab, self._kind, self._order, self._forget_ms = tab, kind, order, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._places = handle.getMapState("places", f"tab {self._kind}", "place binary", ttlDurationMs=self._forget_ms)

    def _known(self, tabs: list[tuple]) -> dict[tuple, bytes]:
        if len(tabs) > FEW:
            return {tuple(tab): place for tab, (place,) in self._places.iterator()}
        found = ((tab, self._places.getValue(tab)) for tab in tabs)
        return {tab: held[0] for tab, held in found if held}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for batch in rows:  # one row per tab is held, however many a tab has
            best = newest_rows(batch if best is None else pd.concat((best, batch)), [self._tab], self._order)
        tabs = list(values_of(best, [self._tab]))
        known, newer = self._known(tabs), []
        for tab, values in zip(tabs, values_of(best, sort_keys(best, self._order)[0])):
            place, before = places(values), known.get(tab)
            newer.append(before is None or place > pickle.loads(before))
            # Seen again: the time starts anew.
            self._places.updateValue(tab, (pickle.dumps(place) if newer[-1] else before,))
        if any(newer):
            yield best[newer]

    def close(self) -> None:
        pass


def latest_changes(verdicts: DataFrame, forget_ms: int, tab: str = "tab", ts: str = "ts", seq: str = "seq",
                   buckets: int = BUCKETS) -> DataFrame:
    """A stream's rows that are newer than what is remembered of their tab (append).

    Before the shuffle only the newest row of a tab in a batch of records is kept, so a busy tab is thinned out
    where it is read. State is kept by bucket of tabs; a task holds one bucket's places and newest rows of a batch.
    """
    order = [ts, seq]

    def thinned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield newest_rows(batch, [tab], order)

    known = packed(verdicts.filter(F.col(tab).isNotNull()))
    thin = with_bucket(known.mapInPandas(thinned, known.schema), tab, buckets)
    return unpacked(thin.groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=_Newer(tab, thin.schema[tab].dataType.simpleString(), order, forget_ms), outputStructType=thin.schema, outputMode="Append",
        timeMode="ProcessingTime"), verdicts.schema)


def _newest(df: DataFrame, tab: str, ts: str, seq: str) -> DataFrame:
    rest = [c for c in df.columns if c != tab]
    last = df.groupBy(tab).agg(F.max_by(F.struct(*rest), F.struct(ts, seq)).alias("_last"))
    return last.select(tab, *[F.col(f"_last.{c}").alias(c) for c in rest])


def _merged(spark: SparkSession, path: str) -> int:
    """Number of the last batch that the published table holds; -1 without one."""
    return read_published(spark, path, "upto").first()[0] if newest_version(spark, path) else -1


def read_latest(spark: SparkSession, path: str, tab: str = "tab", ts: str = "ts", seq: str = "seq") -> DataFrame:
    """The last row per tab of everything that has arrived; a tab forgotten by the state included."""
    upto = _merged(spark, path)
    rows = spark.read.parquet(f"{path}/changes").filter(F.col("batch_id") > upto).drop("batch_id")
    if upto >= 0:
        rows = read_published(spark, path, "latest").unionByName(rows)
    return _newest(rows, tab, ts, seq)


def compact(spark: SparkSession, path: str, batch_id: int, tab: str = "tab", ts: str = "ts", seq: str = "seq") -> None:
    """Merge all changes up to a batch into the published table; does nothing where that is done already."""
    before = _merged(spark, path)
    if before >= batch_id:
        return
    latest = read_latest(spark, path, tab, ts, seq)
    version = publish({"latest": latest, "upto": spark.range(1).select(F.lit(batch_id).cast("bigint").alias("upto"))}, path)
    # Readers of the version before still take the changes after its last batch.
    keep = read_published(spark, path, "upto", version - 1).first()[0] if version > 1 else -1
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/changes")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for held in files.listStatus(folder):
        name = held.getPath().getName()
        if name.startswith("batch_id=") and int(name.split("=")[1]) <= keep:
            files.delete(held.getPath(), True)


def stream_latest_log(verdicts: DataFrame, path: str, checkpoint: str, forget_ms: int, compact_every: int = 100,
                      tab: str = "tab", ts: str = "ts", seq: str = "seq", once: bool = False) -> StreamingQuery:
    """Keep the last row per tab of a stream at ``path``; :func:`read_latest` reads it.

    Rows without a tab have no last one and are left out; of rows at an equal place (ts, seq) one stays. A retried batch
    overwrites its folder, or if it is merged already, adds nothing new.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact(spark, path, batch_id, tab, ts, seq)

    writer = latest_changes(verdicts, forget_ms, tab, ts, seq).writeStream.option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append").foreachBatch(write)
    # With processing time Spark would run batches without data for ever; a batch with data forgets as well.
    spark, name = verdicts.sparkSession, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        return (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        spark.conf.set(name, before)
