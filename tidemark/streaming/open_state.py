"""Looking into a stopped stream: the windows its state still holds.

Read by Spark's state data source from the query's checkpoint: the intervals of the
keyed processor (``window_state``) become window counts by the batch operators.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.windows import interval_sums
from ..session import pin_state_store


def watermark_ms(query: StreamingQuery) -> int:
    """The watermark a query has come to, in epoch milliseconds; 0 before the first."""
    told = (query.lastProgress or {}).get("eventTime", {}).get("watermark")
    if not told:
        return 0
    return round(datetime.fromisoformat(told.replace("Z", "+00:00")).timestamp() * 1000)


def open_windows(
    spark: SparkSession,
    checkpoint: str,
    keys: str,
    size: int,
    slide: int,
    watermark: int,
    *,
    name: str = "count",
) -> DataFrame:
    """Counts per key of all windows that are open at ``watermark``: ``window_end``,
    ``keys`` (given as their DDL) and ``name``.

    Keys are visited when they have something to fire or to drop, so state may hold
    windows that have passed; the watermark tells them apart.
    """
    pin_state_store(spark)
    held = spark.read.format("statestore").option("stateVarName", "held").load(checkpoint)
    intervals = held.select(
        F.from_json("key.group", keys).alias("_key"),
        F.inline(F.arrays_zip("value.starts", "value.stops", "value.counted")),
    ).toDF("_key", "_start", "_stop", "_rows")
    counts = interval_sums(
        intervals.select("_key.*", "_start", "_stop", "_rows"),
        spark.createDataFrame([], keys).columns,
        ["_rows"],
        size,
        slide,
        present="_rows",
    )
    return counts.where(F.col("window_end") - 1 > watermark).withColumnRenamed("_rows", name)
