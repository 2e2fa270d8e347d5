"""Allowed lateness and the late output, replayed exactly on batch data.

Rule. Rows arrive in the order of ``position``. The watermark before a row is
the largest event time of all earlier rows, minus ``delay``. For a window ending
at ``e`` the row is

* on time        while  watermark < e - 1,
* accepted late  while  e - 1 <= watermark < e - 1 + lateness,
* dropped        from there on;

a row dropped from the last of its windows, hence from all, belongs to the late
output.

"The watermark before this row has passed x" is the same as "the first row to
push it past x stands before this one". So the data need no global order: the
first position per event-time slot is a grouped minimum (partial per task, hence
indifferent to skew), and the minimum over all slots from x on says when x was
passed. These gates are a table that grows with the time span, not with the
rows; they are kept per block of time as a sorted array, in which each row finds
how far the watermark had come by binary search.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import floor_to, slot_end
from ..workspace import may_broadcast, write_table
from .windows import interval_steps, window_ends

_GATE_BYTES = 64  # one array element, a struct of a long and a decimal(38)


@dataclass(frozen=True)
class LatenessRule:
    """Durations in milliseconds; the defaults are those of the hot-URL job."""

    size: int = 600_000
    slide: int = 5_000
    delay: int = 1_000
    lateness: int = 60_000

    def __post_init__(self):
        if self.size % self.slide:
            raise ValueError("window size must be a multiple of the slide")

    @property
    def unit(self) -> int:
        """Grid holding both thresholds of every window."""
        return gcd(self.slide, self.lateness) if self.lateness else self.slide

    @property
    def block(self) -> int:
        """Block length: the gates of a row start in one block and end by the next."""
        return self.size + self.lateness

    @property
    def max_gates(self) -> int:
        """Most gates a block can have, one past its end included."""
        return 2 * self.block // self.unit + 1


@dataclass(frozen=True)
class Gates:
    """Per block ``_block`` of window ends, the sorted array ``_gates``.

    An element ``(at, first)`` says: rows after position ``first`` find the
    watermark past window end ``at``. Both grow along the array.
    """

    table: DataFrame
    rule: LatenessRule
    event_ms: str
    position: str
    broadcastable: bool


def arrival_position(arrival: Column, tie: Column) -> Column:
    """Arrival order as one number: by ``arrival``, then by ``tie`` (0 or more).

    One decimal, not a struct: hash aggregation can update it in place.
    """
    shift = F.lit(str(10**19)).cast("decimal(20,0)")
    return (arrival.cast("decimal(18,0)") * shift + tie.cast("decimal(19,0)")).cast(
        "decimal(38,0)"
    )


def build_gates(
    df: DataFrame, rule: LatenessRule, *, event_ms: str = "event_ms", position: str = "position"
) -> Gates:
    """Replay the watermark over all rows of ``df``.

    Call it before filtering: rows a job filters out still move its watermark.
    """
    unit, block = rule.unit, rule.block
    end = slot_end(F.col(event_ms), rule.slide)
    # The highest grid point this row itself pushes the watermark past.
    reach = floor_to(F.col(event_ms) + F.lit(1 - rule.delay), unit)
    slots, _ = write_table(
        df.groupBy(reach.alias("_g"), floor_to(end, block).alias("_block")).agg(
            F.min(position).alias("_first")
        ),
        "slots",
    )
    own = floor_to(F.col("_g"), block)
    none = F.lit(None).cast("decimal(38,0)")

    # What lies past a block's array. One row per block: bounded by the time span.
    past_array = Window.orderBy(F.desc("_block")).rangeBetween(
        Window.unboundedPreceding, -2 * block
    )
    beyond = (
        slots.groupBy(own.alias("_block"))
        .agg(F.min("_first").alias("_first"))
        .unionByName(slots.select("_block").distinct().withColumn("_first", none))
        .groupBy("_block")
        .agg(F.min("_first").alias("_first"))
        .select(
            "_block",
            (F.col("_block") + F.lit(2 * block)).alias("_g"),
            F.min("_first").over(past_array).alias("_first"),
        )
        .where(F.col("_first").isNotNull())
    )
    near = slots.select(
        F.explode(F.array(own - F.lit(block), own)).alias("_block"), "_g", "_first"
    )
    from_here = Window.partitionBy("_block").orderBy(F.desc("_g"))
    table, _ = write_table(
        near.unionByName(beyond)
        .groupBy("_block", "_g")
        .agg(F.min("_first").alias("_first"))
        .withColumn("_first", F.min("_first").over(from_here))
        .groupBy("_block")
        # At most max_gates elements, whatever the number of rows.
        .agg(
            F.sort_array(
                F.collect_list(F.struct(F.col("_g").alias("at"), F.col("_first").alias("first")))
            ).alias("_gates")
        ),
        "gates",
    )
    gates = table.agg(F.sum(F.size("_gates"))).head()[0] or 0
    return Gates(table, rule, event_ms, position, may_broadcast(gates, _GATE_BYTES))


def _passed(df: DataFrame, gates: Gates) -> DataFrame:
    """Add a row's window ends ``[_start, _stop)`` and ``_wm``, the last window end
    in reach that the watermark before the row has passed (null: none)."""
    rule = gates.rule
    table = F.broadcast(gates.table) if gates.broadcastable else gates.table
    start = slot_end(F.col(gates.event_ms), rule.slide)
    placed = (
        df.withColumn("_start", start)
        .withColumn("_stop", F.col("_start") + F.lit(rule.size).cast("long"))
        .withColumn("_block", floor_to(F.col("_start"), rule.block))
        .join(table, "_block", "left")
    )
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(rule.max_gates.bit_length()))])

    def descend(passed: Column, step: Column) -> Column:
        ahead = F.get("_gates", passed + step - 1)["first"] < F.col(gates.position)
        return passed + F.when(ahead, step).otherwise(F.lit(0))

    # Null where no gate was passed: ``get`` at -1.
    last = F.get("_gates", F.reduce(steps, F.lit(0), descend) - 1)["at"]
    # Through a generator, so that filters above do not repeat the search. The
    # array of gates goes no further than this.
    return placed.select(*df.columns, "_start", "_stop", F.explode(F.array(last)).alias("_wm"))


def late_output(df: DataFrame, gates: Gates) -> DataFrame:
    """Rows that come too late for every window they belong to."""
    rule = gates.rule
    last_threshold = F.col("_stop") + F.lit(rule.lateness - rule.slide)
    return _passed(df, gates).where(F.col("_wm") >= last_threshold).select(*df.columns)


def classify(df: DataFrame, gates: Gates) -> DataFrame:
    """Add where a row's windows change class, as window ends on the slide grid.

    Windows in ``[_start, _accepted)`` drop the row, ``[_accepted, _on_time)``
    take it late, ``[_on_time, _stop)`` have it on time.
    """
    rule = gates.rule

    def first_after(threshold: Column) -> Column:
        end = floor_to(threshold, rule.slide) + F.lit(rule.slide)
        inside = F.least(F.greatest(end, F.col("_start")), F.col("_stop"))
        return F.when(F.col("_wm").isNull(), F.col("_start")).otherwise(inside)

    return _passed(df, gates).select(
        *df.columns,
        "_start",
        first_after(F.col("_wm") - F.lit(rule.lateness)).alias("_accepted"),
        first_after(F.col("_wm")).alias("_on_time"),
        "_stop",
    )


CLASSES = ["on_time", "accepted_late", "dropped"]


def class_counts(df: DataFrame, keys: Sequence[str], gates: Gates) -> DataFrame:
    """Rows per key, window end and class: on_time, accepted_late, dropped."""
    steps = class_steps(df, keys, gates)
    return window_ends(steps, keys, CLASSES, gates.rule.slide).select(
        "window_end", *keys, *CLASSES
    )


def class_steps(
    df: DataFrame, keys: Sequence[str], gates: Gates, *, rows: int = 0
) -> DataFrame:
    """As :func:`class_counts`, one row per key and stretch ``[_at, _next)`` of window ends.

    ``rows`` is the number of rows of ``df``, if that is known.
    """
    bounds = ["_start", "_accepted", "_on_time", "_stop"]
    alike = classify(df, gates).groupBy(*keys, *bounds).agg(F.count(F.lit(1)).alias("_n"))
    zero = F.lit(0).cast("long")

    def part(start: str, stop: str, measure: str) -> Column:
        return F.struct(
            F.col(start).alias("_start"),
            F.col(stop).alias("_stop"),
            *[
                (F.col("_n") if name == measure else zero).alias(name)
                for name in CLASSES
            ],
            F.col("_n").alias("_rows"),
        )

    parts = F.array(
        part("_start", "_accepted", "dropped"),
        part("_accepted", "_on_time", "accepted_late"),
        part("_on_time", "_stop", "on_time"),
    )
    intervals = alike.select(*keys, F.inline(parts)).where("_start < _stop")
    # A slot has an interval for each of its watermark positions; their edges coincide.
    return interval_steps(
        intervals, keys, [*CLASSES, "_rows"], gates.rule.size, gates.rule.slide,
        present="_rows", presum=True, rows=rows * len(CLASSES),
    ).drop("_rows")


def revised_windows(steps: DataFrame, rule: LatenessRule) -> DataFrame:
    """Window ends that accept a row late, hence change after they closed.

    ``steps`` as of :func:`class_steps`, whole or in blocks.
    """
    late = steps.where("accepted_late > 0")
    return window_ends(late, [], [], rule.slide).distinct()


def revised_counts(df: DataFrame, keys: Sequence[str], gates: Gates) -> DataFrame:
    """Counts of each window when it first closes and once it is final.

    ``first_count`` holds the rows on time, ``final_count`` also those accepted
    late. Windows whose rows were all dropped do not appear.
    """
    return revised(class_steps(df, keys, gates), keys, gates.rule)


def revised(steps: DataFrame, keys: Sequence[str], rule: LatenessRule) -> DataFrame:
    """As :func:`revised_counts`, from the stretches of :func:`class_steps`."""
    return (
        window_ends(steps, keys, CLASSES, rule.slide)
        .select(
            "window_end",
            *keys,
            F.col("on_time").alias("first_count"),
            (F.col("on_time") + F.col("accepted_late")).alias("final_count"),
        )
        .where("final_count > 0")
    )
