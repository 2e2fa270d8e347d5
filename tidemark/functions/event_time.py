"""Event time, watermarks and filters that must not hold a watermark back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clock import interval_text


def behavior_time(df: DataFrame, delay_ms: int = 0, name: str = "ts") -> DataFrame:
    """Event time of behavior records (epoch seconds), in-order input by default."""
    return with_event_time(df, F.timestamp_seconds("timestamp"), delay_ms, name)


def access_log_time(df: DataFrame, delay_ms: int = 1000, name: str = "ts") -> DataFrame:
    """Event time of access-log records (epoch ms), one second of disorder by default."""
    return with_event_time(df, F.timestamp_millis("event_time"), delay_ms, name)


def with_event_time(df: DataFrame, when: Column, delay_ms: int, name: str = "ts") -> DataFrame:
    """Add the event-time column and, on a stream, its watermark."""
    timed = df.withColumn(name, when)
    if timed.isStreaming:
        timed = timed.withWatermark(name, interval_text(delay_ms))
    return timed


def keep(df: DataFrame, column: str, value: str, ts: str = "ts") -> DataFrame:
    """Rows whose ``column`` equals ``value`` exactly; null never does.

    Rows that are filtered out still have to move the watermark. A plain
    predicate on a stream is pushed below the watermark operator and would stop
    them from doing so, hence the reference to the event-time column. In batch
    the plain form is used: it reaches the file scan.
    """
    wanted = F.col(column) == F.lit(value)
    if df.isStreaming:
        wanted = F.when(F.col(ts).isNotNull(), wanted).otherwise(F.lit(False))
    return df.where(wanted)


def page_views(df: DataFrame) -> DataFrame:
    return keep(df, "behavior", "pv")


def get_requests(df: DataFrame) -> DataFrame:
    return keep(df, "method", "GET")


def rowtime(df: DataFrame, *columns: str, ts: str = "ts") -> DataFrame:
    """Keep ``columns`` and the event time, renamed ``rt``."""
    return df.select(*columns, F.col(ts).alias("rt"))
