"""Starting streams whose micro-batches are finished by batch operators.

In append mode a window's rows all leave the aggregation in the one micro-batch
in which the watermark passes its end. So per-window work that streams do not
offer (ranking, change rows) runs on that micro-batch as an ordinary DataFrame,
with the operators of the batch jobs and no further state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..session import pin_state_store
from .batch_log import BatchLog

BatchHandler = Callable[[DataFrame, int], None]


def start(
    stream: DataFrame,
    handle: BatchHandler,
    checkpoint: str,
    *,
    output_mode: str = "append",
    interval: str | None = None,
) -> StreamingQuery:
    """Run ``handle`` per micro-batch: every ``interval``, or over what is there now."""
    pin_state_store(stream.sparkSession)
    writer = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def into_log(log: BatchLog, transform: Callable[[DataFrame], DataFrame]) -> BatchHandler:
    """Handler that appends ``transform(batch)`` to ``log``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        log.write(transform(batch), batch_id)

    return handle


def into_all(*handlers: BatchHandler) -> BatchHandler:
    """Several outputs of one stream; the batch is computed once for all."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for each in handlers:
                each(batch, batch_id)
        finally:
            batch.unpersist()

    return handle
