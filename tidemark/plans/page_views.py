"""Page views per hour, counted in two phases over salted keys.

Two forms: a total per window, and a table whose total is updated with every
partial count and shown as change rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from ..functions.clock import hours, slot_end
from ..functions.event_time import behavior_time, page_views, rowtime
from ..functions.parsing import parse_behavior
from ..functions.reports import pv_report as report
from ..functions.salts import hashed_salt
from ..operators.changelog import running_totals, to_retract
from ..operators.totals import partial_counts, plain_total, salted_total
from ..operators.user_aggregate import Count, aggregate_by
from ..operators.windows import tumbling_count
from ..sources.lines import read_lines
from ..streaming.batch_log import BatchLog
from ..streaming.counts import stream_partial_counts
from ..streaming.run import BatchHandler, into_log, start

SIZE, SALTS = hours(1), 8
TOTALS = StructType(
    [StructField("window_end", LongType()), StructField("count", LongType())]
)
CHANGES = StructType(
    [
        StructField("is_add", BooleanType()),
        StructField("counts", LongType()),
        StructField("endtime", LongType()),
        StructField("seq", IntegerType()),
    ]
)


def page_view_total(
    behavior: DataFrame, size: int = SIZE, salt: Column | None = None
) -> DataFrame:
    """(window_end, count), salted."""
    return salted_total(page_views(behavior_time(behavior)), size, salt=salt)


def page_view_total_plain(behavior: DataFrame, size: int = SIZE) -> DataFrame:
    return plain_total(page_views(behavior_time(behavior)), size)


def page_view_total_by_aggregate(behavior: DataFrame, size: int = SIZE) -> DataFrame:
    """(window_end, count), by an aggregate of the user surface."""
    views = page_views(behavior_time(behavior))
    ends = views.select(slot_end(F.unix_millis("ts"), size).alias("window_end"))
    return aggregate_by(ends, ["window_end"], Count())


def page_view_partials(behavior: DataFrame, salt: Column, size: int = SIZE) -> DataFrame:
    """(window_end, salt_key, count)."""
    return partial_counts(page_views(behavior_time(behavior)), size, salt)


def page_view_report(spark, path: str) -> DataFrame:
    """From behavior lines at ``path`` to one report per hour."""
    return report(page_view_total(parse_behavior(read_lines(spark, path))))


# -- table form --------------------------------------------------------------


def table_salt(n: int = SALTS) -> Column:
    """The behavior with a number appended, from a hash of the row time."""
    return hashed_salt(F.col("behavior"), "rt", n=n)


def table_partials(
    behavior: DataFrame, size: int = SIZE, salt: Column | None = None
) -> DataFrame:
    """(window_end, random_k, count): counts non-null salt keys."""
    salt = table_salt() if salt is None else salt
    timed = page_views(behavior_time(behavior))
    salted = rowtime(timed, *[c for c in timed.columns if c != "ts"]).withColumn("random_k", salt)
    return tumbling_count(salted, ["random_k"], size, ts="rt", counted="random_k")


def table_totals(partials: DataFrame) -> DataFrame:
    """(counts, endtime)."""
    return partials.groupBy(F.col("window_end").alias("endtime")).agg(
        F.sum("count").alias("counts")
    ).select("counts", "endtime")


def table_changes(partials: DataFrame, order: str = "random_k") -> DataFrame:
    """(is_add, counts, endtime, seq): the total's change rows, partial by partial."""
    return to_retract(running_totals(partials, order)).select(
        "is_add", F.col("count").alias("counts"), F.col("window_end").alias("endtime"), "seq"
    )


# -- streams -----------------------------------------------------------------


def start_page_views(
    behavior: DataFrame,
    handle: BatchLog | BatchHandler,
    checkpoint: str,
    *,
    size: int = SIZE,
    interval: str | None = None,
    timed: bool = False,
) -> StreamingQuery:
    records = behavior if timed else behavior_time(behavior)
    totals = salted_total(page_views(records), size)
    if isinstance(handle, BatchLog):
        handle = into_log(handle, lambda batch: batch)
    return start(totals, handle, checkpoint, interval=interval)


def start_page_view_changes(
    behavior: DataFrame,
    log: BatchLog,
    checkpoint: str,
    *,
    size: int = SIZE,
    salt: Column | None = None,
    interval: str | None = None,
    timed: bool = False,
) -> StreamingQuery:
    """Change rows; a window's partial counts all arrive when it closes."""
    records = behavior if timed else behavior_time(behavior)
    salt = hashed_salt(F.col("behavior"), "ts", n=SALTS) if salt is None else salt
    partials = stream_partial_counts(page_views(records), size, salt, salt_name="random_k")
    return start(partials, into_log(log, table_changes), checkpoint, interval=interval)
