"""Top-N per window.

Ranks follow count descending, then key ascending, so ties always rank alike.
``row_number`` with a bound lets Spark cut every task's rows to N per window
before the shuffle and again after it; no window's full key set meets in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import floor_to
from ..workspace import may_broadcast, write_table
from .windows import (
    Blocks,
    as_intervals,
    cut_at_blocks,
    interval_steps,
    sliding_count,
    slot_counts,
    tasks_for,
    window_ends,
)

_FLOOR_BYTES = 64  # a broadcast row of two longs
_KEY_BYTES = 256  # of a key in it
_FLOOR_ENDS = 12  # window ends of a block whose n-th best key bounds the others


def top_n(
    counts: DataFrame,
    n: int,
    key: str,
    *,
    window: str = "window_end",
    count: str = "count",
    rank: str = "rk",
) -> DataFrame:
    """The ``n`` highest counts of each window. One row per (window, key) expected."""
    order = Window.partitionBy(window).orderBy(F.desc(count), F.asc(key))
    return (
        counts.withColumn(rank, F.row_number().over(order))
        .where(F.col(rank) <= n)
        .select(window, rank, key, count)
    )


def top_n_in_blocks(
    blocks: Blocks, n: int, key: str, counted: Column, *, rank: str = "rk"
) -> DataFrame:
    """``top_n`` of the windows that stretches hold, each with ``counted`` above zero.

    First within each deal of a block, then per window over what is left: memory of a
    task follows from ``TASK_ROWS``, not from the number of keys or windows.
    """
    stretches = blocks.table.withColumn("count", counted).where("count > 0")
    counts = window_ends(stretches, ["_block", "_deal", key], ["count"], blocks.slide)
    order = [F.desc("count"), F.asc(key)]
    of_deal = Window.partitionBy("_block", "_deal", "window_end").orderBy(*order)
    parts = tasks_for(counts.sparkSession, blocks.most(n))
    left = (
        counts.withColumn("_place", F.row_number().over(of_deal))
        .where(F.col("_place") <= n)
        .select("window_end", key, "count")
        .repartition(parts, "window_end")
    )
    return top_n(left, n, key, rank=rank)


def hopeful_stretches(
    steps: DataFrame, n: int, key: str, slide: int, *, count: str = "count",
    span: int | None = None,
) -> DataFrame:
    """Stretches of equal counts, cut into blocks, without those that cannot rank.

    A key whose stretch covers a whole block has its count in every window there. So
    whoever ranks behind the n-th best of these keys, ties included, is behind n keys in
    every window of the block. Exact; the stretches of a key do not overlap. ``span`` is
    the time between the first and the last stretch, if that is known.
    """
    width = slide * _FLOOR_ENDS
    cut = cut_at_blocks(steps, width, slide)
    whole = cut.where(F.col("_next") - F.col("_at") == width)
    floors = (
        top_n(whole, n, key, window="_block", count=count)
        .where(F.col("rk") == n)
        .select("_block", F.col(key).alias("_floor_key"), F.col(count).alias("_floor"))
    )
    if span is not None and may_broadcast(span // width + 2, _FLOOR_BYTES + _KEY_BYTES):
        floors = F.broadcast(floors)
    # Nulls rank before other keys.
    not_behind = F.col(key).isNull() | (F.col(key) <= F.col("_floor_key"))
    return (
        cut.join(floors, "_block", "left")
        .where(
            F.col("_floor").isNull()
            | (F.col(count) > F.col("_floor"))
            | ((F.col(count) == F.col("_floor")) & not_behind)
        )
        .drop("_block", "_floor_key", "_floor")
    )


def sliding_top_n(
    df: DataFrame, n: int, key: str, size: int, slide: int, *, ts: str = "ts"
) -> DataFrame:
    """``top_n(sliding_count(...))`` without writing out windows of hopeless keys.

    A window that contains a whole bucket of time counts at least what the bucket
    counts. So if the n-th best key of a bucket has ``floor`` rows, every window
    around the bucket has n keys with at least ``floor``, and a key below that
    cannot be among the first n there. Such keys, usually the long tail, are left
    out while a window count is still one row per stretch of equal counts.

    Buckets are half a window, so the floors are a table of one row per bucket.
    """
    bucket = size // 2 // slide * slide
    if size % slide or not bucket:
        return top_n(sliding_count(df, [key], size, slide, ts=ts), n, key)
    # Used up to three times below; written once, so that the input is read once.
    slots, _ = write_table(slot_counts(df, [key], slide, ts=ts), "slots")
    first, last = slots.agg(F.min("_start"), F.max("_start")).head()
    intervals = as_intervals(slots, size)
    floors = _floors(slots, n, key, slide, bucket)
    if first is None or may_broadcast((last - first) // bucket + 2, _FLOOR_BYTES):
        floors = F.broadcast(floors)
    step, width = F.lit(slide).cast("long"), F.lit(bucket).cast("long")
    steps = interval_steps(intervals, [key], ["_rows"], size, slide, present="_rows")
    pieces = steps.select(
        "*",
        F.explode(
            F.sequence(
                floor_to(F.col("_at"), bucket), floor_to(F.col("_next") - step, bucket), width
            )
        ).alias("_bucket"),
    )
    hopeful = pieces.join(floors, "_bucket", "left").where(
        F.col("_rows") >= F.coalesce("_floor", F.lit(0))
    )
    counts = hopeful.select(
        key,
        F.col("_rows").alias("count"),
        F.explode(
            F.sequence(
                F.greatest(F.col("_at"), F.col("_bucket")),
                F.least(F.col("_next"), F.col("_bucket") + width) - step,
                step,
            )
        ).alias("window_end"),
    )
    return top_n(counts, n, key)


def _floors(slots: DataFrame, n: int, key: str, slide: int, bucket: int) -> DataFrame:
    """Per bucket of window ends, the count of the n-th best key in the bucket before."""
    before = floor_to(F.col("_start") - F.lit(slide), bucket)
    counts = slots.groupBy((before + F.lit(bucket).cast("long")).alias("_bucket"), key).agg(
        F.sum("_rows").alias("_rows")
    )
    return (
        top_n(counts, n, key, window="_bucket", count="_rows")
        .groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_keys"), F.min("_rows").alias("_floor"))
        .where(F.col("_keys") == n)
        .select("_bucket", "_floor")
    )


def top_n_of_max(
    history: DataFrame,
    n: int,
    key: str,
    *,
    window: str = "window_end",
    count: str = "count",
    rank: str = "rk",
) -> DataFrame:
    """As :func:`top_n` where a key may come several times: its largest count ranks."""
    best = history.groupBy(window, key).agg(F.max(count).alias(count))
    return top_n(best, n, key, window=window, count=count, rank=rank)


def as_table_rows(ranked: DataFrame, key: str) -> DataFrame:
    """Name ranked rows as the table aggregate does: endtime1, rk, url1, counts1."""
    return ranked.select(
        F.col("window_end").alias("endtime1"),
        "rk",
        F.col(key).alias("url1"),
        F.col("count").alias("counts1"),
    )


def max_per_rank(rows: DataFrame) -> DataFrame:
    """One row per (endtime1, rk), the key of the upsert table.

    For a final top-N set only. Over a history of revisions the maxima could mix
    url and count of different revisions: take :func:`changelog.latest` there.
    """
    return rows.groupBy("endtime1", "rk").agg(
        F.max("url1").alias("url2"), F.max("counts1").alias("counts2")
    )
