"""Windowed counts on batch DataFrames.

Windows are half-open, aligned to the epoch, and named by their end in epoch
milliseconds. Empty windows give no row.

A sliding window of ``size`` / ``slide`` puts each record into ``size / slide``
windows (120 for ten minutes every five seconds). Copying records that often
before counting multiplies the shuffle by the same factor. Instead:

1. records are counted per key and slide-wide slot, with a map-side partial
   count, so the first shuffle carries slots and a hot key has no more rows
   than there are slots;
2. a slot is an interval ``[first window end, past last window end)`` carrying
   its count; intervals are shuffled once by key and time chunk;
3. within a chunk an interval is ``+count`` where it begins and ``-count`` where
   it ends; the running sum is the window count, constant between two edges;
4. only then are the window ends in between written out.

The shuffles see one row per slot; the copies exist only downstream of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.clock import floor_to, interval_text, slot_end
from ..session import shuffle_partitions

# A chunk spans this many window sizes: about 1/32 of the intervals cross into
# the next chunk and are shuffled twice. Where intervals are unique per key and
# slot, or ``presum`` is given, a key has at most 2 * 33 * size / slide edges in
# a chunk.
_CHUNK_SIZES = 32
# A task writes out, sorts or ranks about so many rows, where their number is known.
TASK_ROWS = 1_000_000
# Window ends of one block, and rows of it that are dealt together.
_BLOCK_ENDS, _DEAL_ROWS = 256, TASK_ROWS // 16


def _event_ms(ts: str | Column) -> Column:
    return F.unix_millis(F.col(ts) if isinstance(ts, str) else ts)


def _counted(column: str | None) -> Column:
    return F.count(F.lit(1) if column is None else F.col(column))


def tumbling_count(
    df: DataFrame,
    keys: Sequence[str],
    size: int,
    *,
    ts: str = "ts",
    counted: str | None = None,
    name: str = "count",
) -> DataFrame:
    """Rows (or non-null ``counted`` values) per key and tumbling window."""
    return df.groupBy(slot_end(_event_ms(ts), size).alias("window_end"), *keys).agg(
        _counted(counted).alias(name)
    )


def sliding_count(
    df: DataFrame,
    keys: Sequence[str],
    size: int,
    slide: int,
    *,
    ts: str = "ts",
    counted: str | None = None,
    name: str = "count",
) -> DataFrame:
    """Rows (or non-null ``counted`` values) per key and sliding window."""
    if size % slide:
        return _sliding_count_direct(df, keys, size, slide, ts, counted, name)
    measures = ["_rows"] if counted is None else ["_rows", "_values"]
    slots = slot_counts(df, keys, slide, ts=ts, counted=counted)
    counts = interval_sums(
        as_intervals(slots, size), keys, measures, size, slide, present="_rows"
    )
    return counts.select("window_end", *keys, F.col(measures[-1]).alias(name))


def slot_counts(
    df: DataFrame, keys: Sequence[str], slide: int, *, ts: str = "ts", counted: str | None = None
) -> DataFrame:
    """Rows per key and slide-wide slot, named by the slot's end in ``_start``."""
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    if counted is not None:
        aggregates.append(F.count(F.col(counted)).alias("_values"))
    return df.groupBy(*keys, slot_end(_event_ms(ts), slide).alias("_start")).agg(*aggregates)


def as_intervals(slots: DataFrame, size: int) -> DataFrame:
    """The window ends each slot counts for: ``[_start, _stop)``."""
    return slots.withColumn("_stop", F.col("_start") + F.lit(size).cast("long"))


def _sliding_count_direct(df, keys, size, slide, ts, counted, name) -> DataFrame:
    """Sizes that are no multiple of the slide: window ends do not fall on slots."""
    window = F.window(ts, interval_text(size), interval_text(slide))
    return (
        df.groupBy(window.alias("_w"), *keys)
        .agg(_counted(counted).alias(name))
        .select(F.unix_millis("_w.end").alias("window_end"), *keys, name)
    )


def interval_sums(
    intervals: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    size: int,
    slide: int,
    *,
    present: str,
) -> DataFrame:
    """Sum ``measures`` over all intervals covering each window end.

    ``intervals`` has ``keys``, LONG ``measures`` and ``[_start, _stop)`` on the
    slide grid. A window end is reported where the sum of ``present`` is positive.
    """
    steps = interval_steps(intervals, keys, measures, size, slide, present=present)
    return window_ends(steps, keys, measures, slide)


def window_ends(
    steps: DataFrame, keys: Sequence[str], measures: Sequence[str], slide: int
) -> DataFrame:
    """Stretches written out: one row per window end."""
    step = F.lit(slide).cast("long")
    return steps.select(
        *keys,
        *measures,
        F.explode(F.sequence(F.col("_at"), F.col("_next") - step, step)).alias("window_end"),
    )


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Partitions for ``rows`` rows, ``TASK_ROWS`` each; the session's number at least."""
    return max(shuffle_partitions(spark), -(-rows // TASK_ROWS))


def cut_at_blocks(steps: DataFrame, width: int, slide: int) -> DataFrame:
    """Stretches cut at the borders of blocks of ``width``, named by their ``_block``."""
    step, wide = F.lit(slide).cast("long"), F.lit(width).cast("long")
    blocks = F.sequence(
        floor_to(F.col("_at"), width), floor_to(F.col("_next") - step, width), wide
    )
    return (
        steps.withColumn("_block", F.explode(blocks))
        .withColumn("_at", F.greatest("_at", "_block"))
        .withColumn("_next", F.least(F.col("_next"), F.col("_block") + wide))
    )


@dataclass(frozen=True)
class Blocks:
    """Stretches cut at the borders of time blocks, ``_block`` and ``_deal`` named.

    ``table`` is dealt by both, so that a task writes out about ``TASK_ROWS`` windows,
    however many keys and windows there are; ``most`` rows come out where each deal
    gives ``n`` rows a window.
    """

    table: DataFrame
    slide: int
    windows: int
    deals: int

    def most(self, n: int) -> int:
        return min(self.windows, self.deals * _BLOCK_ENDS * n)


def in_blocks(steps: DataFrame, key: str, slide: int) -> Blocks:
    """Deal the stretches ``steps``, a table that is read twice, by the windows they hold.

    How many bytes stretches have says little of the windows written out from them. So
    windows are counted per block of time, and a block of many is dealt by ``key`` too.
    """
    step = F.lit(slide).cast("long")
    cut = cut_at_blocks(steps, slide * _BLOCK_ENDS, slide)
    sizes = cut.groupBy("_block").agg(
        F.sum(((F.col("_next") - F.col("_at")) / step).cast("long")).alias("_windows")
    )
    windows, blocks, largest = sizes.agg(
        F.sum("_windows"), F.count(F.lit(1)), F.max("_windows")
    ).first()
    deals = max(1, -(-(largest or 0) // _DEAL_ROWS))
    n = tasks_for(steps.sparkSession, windows or 0)
    table = cut.withColumn(
        "_deal", F.pmod(F.xxhash64(key), F.lit(deals).cast("long"))
    ).repartition(n, "_block", "_deal")
    return Blocks(table, slide, windows or 0, blocks * deals)


def interval_steps(
    intervals: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    size: int,
    slide: int,
    *,
    present: str,
    presum: bool = False,
    rows: int = 0,
) -> DataFrame:
    """As :func:`interval_sums`, one row per stretch ``[_at, _next)`` of equal sums.

    ``presum`` adds up edges of one key and time before they are dealt out, for
    intervals that share them. ``rows``: at most so many intervals, if that is known;
    the number of tasks grows with it.
    """
    step = F.lit(slide).cast("long")
    chunk_ms = F.lit(size * _CHUNK_SIZES).cast("long")
    chunk_start = F.col("_chunk")
    chunk_stop = F.col("_chunk") + chunk_ms

    chunked = intervals.select(
        *keys,
        *measures,
        "_start",
        "_stop",
        F.explode(
            F.sequence(
                floor_to(F.col("_start"), size * _CHUNK_SIZES),
                floor_to(F.col("_stop") - step, size * _CHUNK_SIZES),
                chunk_ms,
            )
        ).alias("_chunk"),
    )
    # A fixed partition number: adaptive coalescing would judge by the bytes
    # before the window ends are written out, short by a factor size / slide.
    begins = F.struct(
        F.greatest(F.col("_start"), chunk_start).alias("_at"),
        *[F.col(m).alias(m) for m in measures],
    )
    ends = F.struct(
        F.least(F.col("_stop"), chunk_stop).alias("_at"),
        *[(-F.col(m)).alias(m) for m in measures],
    )
    both = F.inline(F.array(begins, ends)).alias("_at", *measures)
    key_columns = [F.col(k) for k in keys]
    n = tasks_for(intervals.sparkSession, 2 * rows)
    if presum:
        summed = chunked.select(*keys, "_chunk", both).groupBy(*keys, "_chunk", "_at").agg(
            *[F.sum(m).alias(m) for m in measures]
        )
        edges = summed.repartition(n, *key_columns, F.col("_chunk"))
    else:
        spread = chunked.repartition(n, *key_columns, F.col("_chunk"))
        edges = spread.select(*keys, "_chunk", both)

    by_time = Window.partitionBy(*keys, "_chunk").orderBy("_at")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return edges.select(
        *keys,
        "_at",
        F.lead("_at").over(by_time).alias("_next"),
        *[F.sum(m).over(so_far).alias(m) for m in measures],
    ).where((F.col("_next") > F.col("_at")) & (F.col(present) > 0))
