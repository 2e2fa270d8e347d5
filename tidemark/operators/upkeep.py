"""Sliding-window tables kept up to date, load by load.

New rows are counted per key and slot and added to a slot table partitioned by day, a
part of its own for each load. The windows they touch lie on a few days; only these
days of the window table are computed again, from the slots of those days and of as many
days before as a window is long. What a load costs depends on the days it touches, not
on the size of the tables.

A load has a name. One that failed half-way, or is delivered again, replaces its own
part of the slot table and the same days of the window table: the result is the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import hours
from .windows import as_intervals, interval_sums, slot_counts

DAY = hours(24)


def _day(ms: Column) -> Column:
    return F.floor(ms / F.lit(DAY)).cast("int")


def _overwrite(df: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions of ``path`` that ``df`` has rows for.

    Rows are brought together by day; a large day is split over several tasks.
    """
    (
        df.hint("rebalance", by[0])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


class WindowTable:
    """Rows per key and sliding window, below ``path``; ``keys`` are given as their DDL."""

    def __init__(self, spark: SparkSession, path: str, keys: str, size: int, slide: int):
        if size % slide:
            raise ValueError("window size must be a multiple of the slide")
        self.spark, self.size, self.slide = spark, size, slide
        self.keys: Sequence[str] = spark.createDataFrame([], keys).columns
        self._slots, self._windows = f"{path}/slots", f"{path}/windows"
        self._slot_ddl = f"{keys}, _start long, _rows long, day int, load string"
        self._window_ddl = f"window_end long, {keys}, count long, day int"
        # Both tables can be read before the first load.
        for folder, ddl in ((self._slots, self._slot_ddl), (self._windows, self._window_ddl)):
            spark.createDataFrame([], ddl).drop("day", "load").write.mode("append").parquet(folder)

    def slots_of(self, days: Sequence[int]) -> DataFrame:
        """The slots that windows ending on ``days`` are made of."""
        before = -(-self.size // DAY)
        wanted = sorted({d - b for d in days for b in range(before + 1)})
        slots = self.spark.read.schema(self._slot_ddl).parquet(self._slots)
        return slots.where(F.col("day").isin(wanted))

    def add(self, rows: DataFrame, load: str, ts: str = "ts") -> list[int]:
        """Add a load's rows; returns the days whose windows were computed again."""
        counted = slot_counts(rows, self.keys, self.slide, ts=ts)
        _overwrite(
            counted.withColumn("day", _day(F.col("_start"))).withColumn("load", F.lit(load)),
            self._slots, "day", "load",
        )
        own = self.spark.read.schema(self._slot_ddl).parquet(self._slots).where(F.col("load") == load)
        last = F.col("_start") + F.lit(self.size - self.slide)
        # A number for each day of the load.
        days = sorted(
            r.day for r in own.select(
                F.explode(F.sequence(F.col("day"), _day(last))).alias("day")
            ).distinct().collect()
        )
        if days:
            slots = self.slots_of(days).groupBy(*self.keys, "_start").agg(F.sum("_rows").alias("_rows"))
            counts = interval_sums(
                as_intervals(slots, self.size), self.keys, ["_rows"], self.size, self.slide,
                present="_rows",
            )
            dated = counts.withColumn("day", _day(F.col("window_end"))).where(F.col("day").isin(days))
            _overwrite(
                dated.select("window_end", *self.keys, F.col("_rows").alias("count"), "day"),
                self._windows, "day",
            )
        return days

    def windows(self, days: Sequence[int] | None = None) -> DataFrame:
        """``window_end``, keys and ``count``, of some days or all."""
        found = self.spark.read.schema(self._window_ddl).parquet(self._windows)
        if days is not None:
            found = found.where(F.col("day").isin(list(days)))
        return found.drop("day")

