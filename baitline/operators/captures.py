"""Captured page contexts: completeness, fingerprints, change detection, bursts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions.strings import blank_if_null
from baitline.plans.scale import with_neighbour


def capture_filter(captures: DataFrame, min_page_chars: int = fv.MIN_PAGE_CHARS) -> DataFrame:
    """Keep captures with sender, subject and body; web pages with less text are dropped.

    A plain filter: on stored captures it reaches the scan.
    """
    filled = [F.coalesce(F.col(c), F.lit("")) != "" for c in
              ("sender_email", "subject", "body_text")]
    short = (F.coalesce(F.col("page_source"), F.lit("")) == "webpage") & (
        F.length("body_text") < min_page_chars)
    return captures.filter(filled[0] & filled[1] & filled[2] & ~short)


def fingerprint_of(sender: Column, subject: Column, body: Column, urls: Column) -> Column:
    """First 120 base64 characters, which are the first 90 bytes of the joined fields."""
    joined = F.concat_ws(
        "||", blank_if_null(sender), blank_if_null(subject),
        F.substring(blank_if_null(body), 1, fv.FINGERPRINT_BODY_CHARS),
        F.coalesce(F.array_join(urls, "|"), F.lit("")))
    head = F.substring(F.encode(joined, "UTF-8"), 1, fv.FINGERPRINT_CHARS * 3 // 4)
    return F.regexp_replace(F.base64(head), r"[\r\n]", "")


def fingerprint(captures: DataFrame) -> DataFrame:
    return captures.withColumn("fingerprint", fingerprint_of(
        F.col("sender_email"), F.col("subject"), F.col("body_text"), F.col("urls")))


def drop_consecutive_duplicates(captures: DataFrame, tab: str = "tab", ts: str = "ts",
                                seq: str = "seq", slice_seconds: int = 3600) -> DataFrame:
    """Per tab, drop a capture whose fingerprint equals the one before it.

    A dropped capture equals its predecessor, so comparing with the previous row and
    with the previous kept row is the same thing.
    """
    held = with_neighbour(captures, tab, [ts, seq], F.col("fingerprint"), "_previous",
                          step=-1, slice_seconds=slice_seconds)
    return held.filter(~F.col("fingerprint").eqNullSafe(F.col("_previous"))).drop("_previous")


def debounce(captures: DataFrame, gap: str = f"{fv.DEBOUNCE_MS} milliseconds", tab: str = "tab",
             ts: str = "ts", seq: str = "seq", slice_seconds: int = 3600) -> DataFrame:
    """Last capture of every burst: the next one of the tab comes at least ``gap`` later.

    Each new capture restarts the timer, so a burst has no maximum length.
    """
    held = with_neighbour(captures, tab, [ts, seq], F.col(ts), "_next",
                          step=1, slice_seconds=slice_seconds)
    pause = F.expr(f"`{ts}` + INTERVAL '{gap}'")
    return held.filter(F.col("_next").isNull() | (F.col("_next") >= pause)).drop("_next")
