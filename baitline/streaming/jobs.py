"""Streaming forms of scoring, bursts, change detection, alert suppression and last verdicts.

Sinks write one folder per micro-batch and overwrite it when the batch is retried, so a
restart neither loses nor repeats rows.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from baitline import fixed_values as fv
from baitline.operators.alerts import with_alert_key
from baitline.operators.intake import accepted, check_emails, rejected
from baitline.operators.urls import Feeds
from baitline.plans.scoring import score_emails
from baitline.rules import DEFAULT_RULES, RuleSet
from baitline.streaming.buckets import (
    BUCKET, BUCKETS, packed, sort_keys, tab_keys, unpacked, values_of, with_bucket,
)

# Code that runs in Python workers travels with the job: executors need not have this
# package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MICROS, ARRIVED = "micros__", "arrived__"  # what waiting rows are ordered by, besides their number
PIECES, LEAST_PIECE = 4, 256             # into how many pieces a batch is cut, and the least rows of one
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STREAM_SETTINGS = {
    # Keyed state on disk and not on the heap; needed by the keyed processors.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # Bursts are merged on the map side first, which thins out a busy tab.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def use_stream_settings(spark: SparkSession) -> None:
    for name, value in STREAM_SETTINGS.items():
        spark.conf.set(name, value)


def read_raw_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """JSON lines arriving as files; the trigger bounds how much one batch can hold."""
    return (spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
            .withColumnRenamed("value", "raw"))


def to_folder(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
              once: bool = False) -> StreamingQuery:
    """Write every micro-batch to ``path/batch_id=N``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return _start(writer.foreachBatch(write), once)


def _start(writer, once: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_score_emails(raw: DataFrame, verdicts_path: str, rejected_path: str, checkpoint: str,
                        feeds: Feeds = Feeds(), policy: DataFrame | None = None,
                        rules: RuleSet = DEFAULT_RULES, keep: tuple[str, ...] = (),
                        once: bool = False) -> StreamingQuery:
    """Check and score every arriving text; faulty ones go to the rejected table."""
    def score(batch: DataFrame, batch_id: int) -> None:
        checked = check_emails(batch).persist()
        try:
            score_emails(accepted(checked), feeds, policy, rules, keep=keep).write.mode(
                "overwrite").parquet(f"{verdicts_path}/batch_id={batch_id}")
            rejected(checked).write.mode("overwrite").parquet(
                f"{rejected_path}/batch_id={batch_id}")
        finally:
            checked.unpersist()

    return _start(raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(score), once)


def stream_debounce(captures: DataFrame, gap: str = f"{fv.DEBOUNCE_MS} milliseconds",
                    delay: str = "10 seconds", tab: str = "tab", ts: str = "ts",
                    seq: str = "seq") -> DataFrame:
    """Last capture of every burst, once the watermark has passed the burst's end (append).

    ``ts`` must be a zoned timestamp. Captures later than ``delay`` are dropped.
    """
    rest = [c for c in captures.columns if c != tab]
    # A session window still takes in a row exactly one gap later; the timer has fired by then.
    bursts = (captures.withWatermark(ts, delay)
              .groupBy(tab, F.session_window(ts, f"{gap} -1 microseconds").alias("burst"))
              .agg(F.max_by(F.struct(*rest), F.struct(ts, seq)).alias("_last")))
    return bursts.select(tab, *[F.col(f"_last.{c}").alias(c) for c in rest])


class _DropRepeats(StatefulProcessor):
    """Keeps the last value of one tab and lets through only rows that differ from it."""

    def __init__(self, value: str, order: list[str]):
        self._value, self._order = value, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", "value string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                        ) -> Iterator[pd.DataFrame]:
        # One tab's rows of one micro-batch, whose size the trigger limits.
        batch = pd.concat(list(rows)).sort_values(self._order, kind="stable")
        before = self._last.get()[0] if self._last.exists() else None
        shown = batch[self._value].shift(1)
        shown.iloc[0] = before
        kept = batch[batch[self._value] != shown]
        self._last.update((batch[self._value].iloc[-1],))
        if len(kept):
            yield kept

    def close(self) -> None:
        pass


class _DropRepeatsInOrder(StatefulProcessor):
    """The same by event time, for a bucket of tabs: rows wait until the watermark has passed them.

    Waiting rows lie in pieces, each cut from a sorted batch, so that a piece is read only once the watermark has
    passed its first row. One timer per bucket stands at its earliest waiting row; when it fires, all
    rows the watermark has passed are compared in their order and the timer moves to the next one.
    """

    def __init__(self, value: str, tab: str, order: list[str]):
        self._value, self._tab, self._order = value, tab, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "values binary")
        self._index = handle.getValueState("index", "pieces binary")
        self._pieces = handle.getMapState("pieces", "n long", "rows binary")

    def _keep(self, rows: pd.DataFrame, index: dict) -> None:
        """Put rows sorted by time away, in pieces."""
        size = max(-(-len(rows) // PIECES), LEAST_PIECE)
        for k in range(0, len(rows), size):
            part = rows.iloc[k:k + size]
            self._pieces.updateValue((index["next"],), (pickle.dumps(part),))
            index["held"][index["next"]] = (int(part[MICROS].iloc[0]), int(part[MICROS].iloc[-1]))
            index["next"] += 1

    def _set_timer(self, index: dict) -> None:
        first = min((first for first, _ in index["held"].values()), default=None)
        due = None if first is None else -(-first // 1000)
        if due is not None and (index["due"] is None or due < index["due"]):
            if index["due"] is not None:
                self._handle.deleteTimer(index["due"])
            self._handle.registerTimer(due)
            index["due"] = due
        self._index.update((pickle.dumps(index),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        empty = {"taken": 0, "next": 0, "due": None, "held": {}}
        state = self._index.get()
        index = pickle.loads(state[0]) if state else empty
        for batch in rows:
            batch = batch.drop(columns=BUCKET).assign(**{ARRIVED: range(index["taken"], index["taken"] + len(batch))})
            index["taken"] += len(batch)
            self._keep(batch.sort_values(MICROS, kind="stable"), index)
        self._set_timer(index)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        index = pickle.loads(self._index.get()[0])
        index["due"] = None
        ready, later = [], []
        for n in [n for n, (first, _) in index["held"].items() if first <= passed]:
            part = pickle.loads(self._pieces.getValue((n,))[0])
            done = part[MICROS] <= passed
            ready.append(part[done])
            later.append(part[~done])
            self._pieces.removeKey((n,))
            del index["held"][n]
        if any(map(len, later)):
            self._keep(pd.concat([p for p in later if len(p)]).sort_values([MICROS, ARRIVED]), index)
        self._set_timer(index)
        if any(map(len, ready)):
            kept = self._compared(pd.concat([p for p in ready if len(p)]))
            if len(kept):
                yield kept.drop(columns=[MICROS, ARRIVED])

    def _compared(self, rows: pd.DataFrame) -> pd.DataFrame:
        """The rows that differ from the one before of their tab; the last value of each tab is remembered."""
        names, ascending = sort_keys(rows, [MICROS, self._order[1], ARRIVED])
        rows = rows.sort_values(names, ascending=ascending, na_position="first")
        tab = tab_keys(rows, self._tab)
        state = self._last.get()
        last = pickle.loads(state[0]) if state else {}
        keep = []
        for own, (value,) in zip(values_of(rows, tab), values_of(rows, [self._value])):
            keep.append(value != last.get(own))
            last[own] = value
        self._last.update((pickle.dumps(last),))
        return rows[keep]

    def close(self) -> None:
        pass


def _drop_repeats(df: DataFrame, value: str, tab: str, ts: str, seq: str, delay: str | None) -> DataFrame:
    if delay is None:
        return df.groupBy(tab).transformWithStateInPandas(
            statefulProcessor=_DropRepeats(value, [ts, seq]), outputStructType=df.schema, outputMode="Append",
            timeMode="None")
    held = packed(df.withWatermark(ts, delay))
    rows = with_bucket(held, tab, BUCKETS).withColumn(MICROS, F.unix_micros(F.col(ts)))
    kept = rows.groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=_DropRepeatsInOrder(value, tab, [ts, seq]), outputStructType=held.schema, outputMode="Append",
        timeMode="EventTime")
    return unpacked(kept, df.schema)


def stream_changes(captures: DataFrame, tab: str = "tab", ts: str = "ts", seq: str = "seq",
                   delay: str | None = None) -> DataFrame:
    """Captures whose fingerprint differs from the tab's previous one.

    Without ``delay`` a tab's rows are compared as they arrive, those of a batch in (ts, seq) order.
    With ``delay`` they are compared in (ts, seq) order whatever order they arrive in: a row waits until the
    watermark (latest ts less ``delay``) has passed it. Later rows are dropped. ``ts`` must then be zoned.
    """
    return _drop_repeats(captures, "fingerprint", tab, ts, seq, delay)


def stream_alerts(alerts: DataFrame, tab: str = "tab", ts: str = "ts", seq: str = "seq",
                  delay: str | None = None) -> DataFrame:
    """Alerts that are not a repeat of the tab's last one; rows without a tab all pass.

    ``delay`` as in :func:`stream_changes`.
    """
    keyed = with_alert_key(alerts)
    known = _drop_repeats(keyed.filter(F.col(tab).isNotNull()), "alert_key", tab, ts, seq, delay)
    return known.unionByName(keyed.filter(F.col(tab).isNull()))


def stream_latest(verdicts: DataFrame, tab: str = "tab", ts: str = "ts", seq: str = "seq"
                  ) -> DataFrame:
    """The last verdict per tab; run it in update mode."""
    rest = [c for c in verdicts.columns if c != tab]
    last = verdicts.groupBy(tab).agg(F.max_by(F.struct(*rest), F.struct(ts, seq)).alias("_last"))
    return last.select(tab, *[F.col(f"_last.{c}").alias(c) for c in rest])


def newest_per_key(updates: DataFrame, key: str = "tab", batch: str = "batch_id") -> DataFrame:
    """Folder written in update mode -> its current rows."""
    rest = [c for c in updates.columns if c not in (key, batch)]
    last = updates.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(batch)).alias("_last"))
    return last.select(key, *[F.col(f"_last.{c}").alias(c) for c in rest])


def drain(spark: SparkSession, start: Callable[[], StreamingQuery]) -> None:
    """Run a query started with ``once=True`` until its input is used up.

    State partitions are fixed when a stream first starts and each costs a state store
    and a worker per batch, so there are at most two per core.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), 2 * spark.sparkContext.defaultParallelism)))
    try:
        start().awaitTermination()
    finally:
        spark.conf.set(name, before)
