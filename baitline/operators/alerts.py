"""Badges, alert rows, repeat suppression and the latest verdict of a tab."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline import fixed_values as fv
from baitline.functions.strings import first_text
from baitline.plans.scale import filter_late, with_neighbour


def badge(verdicts: DataFrame) -> DataFrame:
    level = F.col("risk_level")

    def pick(i: int):
        return (F.when(level == "high", fv.BADGES["high"][i])
                .when(level == "medium", fv.BADGES["medium"][i]).otherwise(fv.BADGES["low"][i]))

    return verdicts.withColumns({"badge_text": pick(0), "badge_color": pick(1)})


def alert_rows(verdicts: DataFrame) -> DataFrame:
    """Medium and high verdicts on web pages, with the text of their alert."""
    on_pages = verdicts.filter(F.col("page_source") == "webpage")
    due = filter_late(on_pages, F.col("risk_level").isin("medium", "high"))
    level = F.upper("risk_level")
    source = first_text(F.col("subject"), F.col("sender_name"), F.col("sender_email"),
                        F.lit(fv.ALERT_FALLBACK_SOURCE))
    reason = first_text(F.get("reasons", F.lit(0)), F.lit(fv.ALERT_FALLBACK_REASON))
    number = F.regexp_replace(F.col("risk_score").cast("string"), r"\.0$", "")
    message = F.concat(source, F.lit("\nScore: "), number, F.lit("\n"), reason)
    return due.withColumns({
        "title": F.concat(level, F.lit(fv.ALERT_TITLE)),
        "message": F.substring(message, 1, fv.ALERT_CHARS),
        "priority": F.when(level == "HIGH", 2).otherwise(1),
        "sticky": level == "HIGH",
    })


def with_alert_key(alerts: DataFrame) -> DataFrame:
    """What two alerts of one tab must share to be repeats of each other."""
    held = F.coalesce(F.nullif(F.col("fingerprint"), F.lit("")), F.col("subject"), F.lit(""))
    return alerts.withColumn("alert_key", F.concat(held, F.lit(":"), F.col("risk_level")))


def suppress_repeat_alerts(alerts: DataFrame, tab: str = "tab", ts: str = "ts",
                           seq: str = "seq", slice_seconds: int = 3600) -> DataFrame:
    """Per tab, drop an alert equal to the last one shown there; no tab, no memory."""
    keyed = alerts if "alert_key" in alerts.columns else with_alert_key(alerts)
    held = with_neighbour(keyed, tab, [ts, seq], F.col("alert_key"), "_shown",
                          step=-1, slice_seconds=slice_seconds)
    return held.filter(F.col(tab).isNull() | ~F.col("alert_key").eqNullSafe(F.col("_shown"))
                       ).drop("_shown")


def latest_analysis(verdicts: DataFrame, tab: str = "tab", ts: str = "ts",
                    seq: str = "seq") -> DataFrame:
    """The last verdict per tab. ``max_by`` combines on the map side, so a busy tab is cheap."""
    rest = [c for c in verdicts.columns if c != tab]
    last = verdicts.groupBy(tab).agg(
        F.max_by(F.struct(*rest), F.struct(ts, seq)).alias("_last"))
    return last.select(tab, *[F.col(f"_last.{c}").alias(c) for c in rest])
