"""Windowed counts on streams, on Spark's own watermark and state.

Tumbling windows are a streaming aggregation. Sliding windows that are whole slots
are intervals in keyed state (``window_state``) and written out when they close.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import interval_text
from ..operators.windows import window_ends
from .window_state import window_stretches


def stream_count(
    df: DataFrame,
    keys: Sequence[str],
    size: int,
    slide: int | None = None,
    *,
    ts: str = "ts",
    name: str = "count",
) -> DataFrame:
    """Rows per key and window, for append mode: each window once, when closed."""
    if slide and slide != size and size % slide == 0:
        stretches = window_stretches(df, keys, size, slide, ts=ts).where("_rows is not null")
        written = window_ends(stretches.withColumnRenamed("_rows", name), keys, [name], slide)
        return written.select("window_end", *keys, name)
    every = [interval_text(ms) for ms in (size, slide) if ms]
    counted = df.groupBy(F.window(ts, *every).alias("_w"), *keys).agg(
        F.count(F.lit(1)).alias(name)
    )
    return counted.select(F.unix_millis("_w.end").alias("window_end"), *keys, name)


def stream_partial_counts(
    df: DataFrame, size: int, salt, *, ts: str = "ts", salt_name: str = "salt_key"
) -> DataFrame:
    """Rows per tumbling window and salt key, for append mode."""
    return stream_count(df.withColumn(salt_name, salt), [salt_name], size, ts=ts)
