"""Top-N per window on a stream with allowed lateness and a late output.

Spark's streaming aggregations drop late rows before any user code and close a
window once. Here a keyed processor (``window_state``) holds each key's windows
open for ``lateness`` after they close, on Spark's own watermark, state and timers,
and gives a key's corrected counts when late rows come. What is left for a
micro-batch are ordinary DataFrames:

* windows that close in it are ranked;
* windows that late rows have changed are ranked again. Counts only grow, so the
  new ranking is among the old ranked rows and the corrected keys: no other key is
  looked at. Old rows are read from the output of the few micro-batches whose
  windows are still open;
* rows too late for all their windows go to ``late``. They come from a stateless
  branch beside the processor, which tells the first open window end.

A window that closes and gets late rows in one micro-batch is ranked twice in it:
as it closed, then with them. A micro-batch run again overwrites its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from ..functions.clock import slot_end
from ..operators.changelog import latest
from ..operators.lateness import LatenessRule
from ..operators.topn import hopeful_stretches, top_n
from ..operators.windows import window_ends
from .batch_log import BatchLog
from .window_state import window_stretches

_RECORD = "_record"


class RevisedTopN:
    """What to run on a stream of records (:meth:`stream`), and on its micro-batches."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        records: StructType,
        *,
        key: str,
        n: int = 5,
        rule: LatenessRule | None = None,
        ts: str = "ts",
    ):
        self.rule = rule or LatenessRule()
        self.key, self.n, self.ts = key, n, ts
        self.late = BatchLog(spark, f"{path}/late", records)
        self.ranked = BatchLog(
            spark,
            f"{path}/ranked",
            StructType(
                [
                    StructField("window_end", LongType()),
                    StructField("rk", IntegerType()),
                    records[key],
                    StructField("count", LongType()),
                    StructField("again", BooleanType()),
                ]
            ),
        )
        #: The last window end that each micro-batch has ranked, of those still open.
        self._open: dict[int, int] | None = None

    @property
    def delay(self) -> int:
        """How far the watermark of the records has to trail."""
        return self.rule.delay + self.rule.lateness

    def stream(self, records: DataFrame) -> DataFrame:
        """Changes of counts, and the records beside them. ``records`` are the wanted
        ones, filtered above a watermark that is :attr:`delay` behind."""
        rule = self.rule
        changes = window_stretches(
            records, [self.key], rule.size, rule.slide, lateness=rule.lateness, ts=self.ts
        )
        beside = records.select(F.struct(*self.late.schema.names).alias(_RECORD))
        return changes.unionByName(beside, allowMissingColumns=True)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            self._handle(batch, batch_id)
        finally:
            batch.unpersist()

    def _handle(self, batch: DataFrame, batch_id: int) -> None:
        rule = self.rule
        changes = batch.where("_open_end is not null")
        told = changes.agg(
            F.max("_open_end").alias("open_end"),
            F.min(F.when(F.col("_again"), F.col("_at"))).alias("first_again"),
            (F.max("_next") - F.min("_at")).alias("span"),
        ).first()
        start = slot_end(F.unix_millis(F.col(_RECORD)[self.ts]), rule.slide)
        too_late = F.lit(False)
        if told.open_end is not None:
            too_late = start + rule.size <= F.lit(told.open_end).cast("long")
        self.late.write(
            batch.where(F.col(_RECORD).isNotNull()).where(too_late).select(f"{_RECORD}.*"), batch_id
        )
        stretches = changes.where("_rows is not null").withColumnRenamed("_rows", "count")
        fresh = hopeful_stretches(
            stretches.where("not _again"), self.n, self.key, rule.slide, span=told.span or 0
        )
        closed = window_ends(fresh, [self.key], ["count"], rule.slide)
        ranked = top_n(closed, self.n, self.key).persist()
        try:
            out = ranked.withColumn("again", F.lit(False))
            if told.first_again is not None:
                late = stretches.where("_again")
                corrected = window_ends(late, [self.key], ["count"], rule.slide)
                out = out.unionByName(
                    self._ranked_again(ranked, corrected, batch_id, told.first_again)
                )
            self.ranked.write(out, batch_id)
        finally:
            ranked.unpersist()
        self._note(batch_id, told.open_end)

    def _ranked_again(
        self, ranked: DataFrame, corrected: DataFrame, batch_id: int, first: int
    ) -> DataFrame:
        old = self.ranked.of(*[b for b, last in self._still_open(batch_id).items() if last >= first])
        rows = ["window_end", self.key, "count"]
        windows = corrected.select(F.col("window_end").alias("_end")).distinct()
        before = ranked.select(rows).unionByName(old.select(rows))
        known = before.join(windows, F.col("window_end") == F.col("_end"), "left_semi")
        counts = corrected.select(rows).unionByName(known).groupBy("window_end", self.key).agg(
            F.max("count").alias("count")
        )
        return top_n(counts, self.n, self.key).withColumn("again", F.lit(True))

    def _still_open(self, batch_id: int) -> dict[int, int]:
        """Earlier micro-batches and their last window ends; after a restart from the output."""
        if self._open is None:
            last = self.ranked.read().groupBy("batch_id").agg(F.max("window_end").alias("last"))
            self._open = {r.batch_id: r["last"] for r in last.collect()}
        return {b: last for b, last in self._open.items() if b < batch_id}

    def _note(self, batch_id: int, open_end: int | None) -> None:
        last = self.ranked.of(batch_id).agg(F.max("window_end")).first()[0]
        self._open = self._still_open(batch_id)
        if last is not None:
            self._open[batch_id] = last
        if open_end is not None:
            self._open = {b: end for b, end in self._open.items() if end >= open_end}

    def _in_order(self) -> DataFrame:
        return self.ranked.read().withColumn("_fired", F.struct("batch_id", "again"))

    def firings(self) -> DataFrame:
        """Every ranking of every window, numbered by ``version`` as they fired."""
        fired = Window.partitionBy("window_end").orderBy("_fired")
        return self._in_order().select(
            "window_end", F.dense_rank().over(fired).alias("version"), "rk", self.key, "count"
        )

    def current(self) -> DataFrame:
        """Every window's ranking as last written."""
        return latest(self._in_order(), ["window_end", "rk"], "_fired").select(
            "window_end", "rk", self.key, "count"
        )
