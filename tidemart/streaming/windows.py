"""Event windows and sessions, the same for batch frames and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXACT = "decimal(12,2)"


def timed(events: DataFrame) -> DataFrame:
    """Events with a zoned timestamp, which watermarks require."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.col("value").cast(EXACT)).cast("double").alias("total"),
    ]


def event_windows(events: DataFrame, size: str = "1 hour", slide: str | None = None,
                  delay: str | None = None) -> DataFrame:
    """Counts and totals per window and event type; ``delay`` sets a watermark on a stream."""
    rows = events.withWatermark("ts", delay) if delay else events
    span = F.window("ts", size, slide) if slide else F.window("ts", size)
    return rows.groupBy(span.alias("span"), "event_type").agg(*_measures()).select(
        F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"),
        "event_type", "n_events", "total",
    )


def event_sessions(events: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Sessions per user: a pause of the gap or longer starts a new one.

    Events of a user in one gap-wide slot always share a session, so they fold into one row
    per slot before anything is ordered. A user's group is then bounded by the slots of the
    observed time span, however many events the user has.
    """
    seconds = F.unix_micros("ts") / F.lit(1_000_000.0)
    slots = events.groupBy(
        "user_id", F.floor(seconds / gap_seconds).alias("slot")
    ).agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"),
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast(EXACT)).alias("value"),
    )
    in_time = Window.partitionBy("user_id").orderBy("slot")
    pause = F.unix_micros("first") - F.unix_micros(F.lag("last").over(in_time))
    starts = F.when(pause >= gap_seconds * 1_000_000, 1).otherwise(0)
    numbered = slots.withColumn("starts", starts).withColumn(
        "session", F.sum("starts").over(in_time)
    )
    return numbered.groupBy("user_id", "session").agg(
        F.min("first").alias("session_start"), F.max("last").alias("last_event"),
        F.sum("n").alias("n_events"), F.sum("value").cast("double").alias("total"),
    ).drop("session")


def stream_sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour"
                    ) -> DataFrame:
    """Sessions on a stream, given out once the watermark has passed their end."""
    span = F.session_window("ts", gap).alias("span")
    return events.withWatermark("ts", delay).groupBy(span, "user_id").agg(*_measures()).select(
        "user_id", F.col("span.start").alias("session_start"),
        F.col("span.end").alias("session_end"), "n_events", "total",
    )
