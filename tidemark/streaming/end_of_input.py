"""Closing the last windows of bounded input.

A bounded file ends event time itself: every window fires, also those the
watermark has not reached. A stream over files needs a last record far in the
future for that. Its kind matches no filter, so it moves the watermark only.

The record may come only when all others have been taken, in however many
micro-batches: whatever comes after it is late. So a bounded run has two parts on
one checkpoint. The first takes everything the source holds; then the closing
record is put into a second source, empty so far, and the second part takes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# The closing record, 2200-01-01 00:00:00 UTC.
END_SECONDS = 7_258_118_400
END_KIND = "__end__"
END_BEHAVIOR_LINE = f"0,0,0,{END_KIND},{END_SECONDS}"
END_ACCESS_LOG_LINE = f"0.0.0.0 - - 01/01/2200:00:00:00 +0000 {END_KIND} -"


class BoundedInput:
    """``stream`` and a closing row of the same columns, to come from ``folder``.

    ``rows`` is the stream to build the job on. ``end_seconds`` has to lie behind
    every window of the data.
    """

    def __init__(
        self, stream: DataFrame, folder: str, kind: str, ts: str, end_seconds: int = END_SECONDS
    ):
        self._spark, self._folder = stream.sparkSession, folder
        values = {
            kind: F.lit(END_KIND),
            ts: F.timestamp_seconds(F.lit(end_seconds)),
        }
        self._row = self._spark.range(1).select(
            *[
                values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                for f in stream.schema.fields
            ]
        )
        # A folder without rows: the source exists from the first batch on.
        self._row.limit(0).write.mode("overwrite").parquet(folder)
        self.rows = stream.unionByName(
            self._spark.readStream.schema(stream.schema).parquet(folder)
        )

    def run(self, begin: Callable[[], StreamingQuery]) -> None:
        """Run the job that ``begin`` starts, with an ``availableNow`` trigger, to its end."""
        begin().awaitTermination()
        self._row.write.mode("append").parquet(self._folder)
        begin().awaitTermination()
