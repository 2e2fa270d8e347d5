"""Hot items: every five minutes the top N items by page views of the last hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..functions.clock import hours, minutes
from ..functions.event_time import behavior_time, page_views
from ..functions.parsing import parse_behavior
from ..functions.reports import item_report
from ..operators.topn import sliding_top_n, top_n
from ..operators.totals import hot_salted_count
from ..operators.windows import sliding_count
from ..sources.lines import read_lines
from ..streaming.batch_log import BatchLog
from ..streaming.counts import stream_count
from ..streaming.run import BatchHandler, into_log, start

SIZE, SLIDE, TOP = hours(1), minutes(5), 5
RANKED = StructType(
    [
        StructField("window_end", LongType()),
        StructField("rk", IntegerType()),
        StructField("item_id", LongType()),
        StructField("count", LongType()),
    ]
)


def item_counts(behavior: DataFrame, size: int = SIZE, slide: int = SLIDE) -> DataFrame:
    return sliding_count(page_views(behavior_time(behavior)), ["item_id"], size, slide)


def hourly_item_counts(behavior: DataFrame, size: int = SIZE, share: float = 0.01) -> DataFrame:
    """(window_end, item_id, count) per hour, items above ``share`` of all rows salted."""
    return hot_salted_count(page_views(behavior_time(behavior)), "item_id", size, share=share)


def hot_items(
    behavior: DataFrame, n: int = TOP, size: int = SIZE, slide: int = SLIDE
) -> DataFrame:
    """Ranked rows (window_end, rk, item_id, count)."""
    return sliding_top_n(page_views(behavior_time(behavior)), n, "item_id", size, slide)


def hot_items_report(spark, path: str, n: int = TOP) -> DataFrame:
    """From behavior lines at ``path`` to one report block per window."""
    return item_report(hot_items(parse_behavior(read_lines(spark, path)), n))


def start_hot_items(
    behavior: DataFrame,
    handle: BatchLog | BatchHandler,
    checkpoint: str,
    *,
    n: int = TOP,
    size: int = SIZE,
    slide: int = SLIDE,
    interval: str | None = None,
    timed: bool = False,
) -> StreamingQuery:
    """Stream form. ``timed``: ``behavior`` already carries ``ts`` and its watermark."""
    records = behavior if timed else behavior_time(behavior)
    counts = stream_count(page_views(records), ["item_id"], size, slide)
    if isinstance(handle, BatchLog):
        handle = into_log(handle, lambda batch: top_n(batch, n, "item_id"))
    return start(counts, handle, checkpoint, interval=interval)


def report_batch(n: int = TOP):
    """Closed windows' counts to report blocks, for an output handler."""

    def transform(batch: DataFrame) -> DataFrame:
        return item_report(top_n(batch, n, "item_id"))

    return transform
