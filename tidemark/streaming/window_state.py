"""Sliding windows on streams, held as intervals in Spark's keyed state.

Copying each record into its ``size / slide`` windows (120 for ten minutes every
five seconds) before a shuffle multiplies the shuffle and the state. Here a record
is an interval of window ends, as in batch:

1. records are counted per key and slot within each Arrow batch, so a hot key is
   at most one row per slot and batch before the shuffle;
2. a stateful processor holds, per key, the intervals that windows still need,
   each with its number of records: one entry per slot, however many windows;
3. when the watermark passes window ends, the running sum over the intervals'
   edges gives the counts, as stretches of windows with equal counts.

State and timers are Spark's: one value and one timer per key, the timer at the
next moment at which something of the key fires or falls due for removal. A key
whose windows have all passed has no state left.

With ``lateness`` a window fires when Spark's watermark, which is to be delayed by
it, passes ``end - lateness``; it stays open until the watermark passes its end.
Late records for it then give its key's corrected count again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..functions.clock import slot_end

#: Before the first watermark every window is open.
_NEVER = -(1 << 62)
#: One row for all changes of a key at once.
_CHANGES = (
    "group string, at array<bigint>, next array<bigint>, counted array<bigint>, "
    "again boolean, open_end long"
)


def _floor(ms: int, width: int) -> int:
    return ms - ms % width


class Intervals:
    """Numbers of records for stretches ``[start, stop)`` of window ends."""

    def __init__(self, starts, stops, rows):
        self.starts, self.stops, self.rows = (
            np.asarray(a, dtype=np.int64) for a in (starts, stops, rows)
        )

    def __len__(self) -> int:
        return len(self.starts)

    def within(self, low: int, high: int) -> Intervals:
        starts, stops = np.maximum(self.starts, low), np.minimum(self.stops, high)
        some = starts < stops
        return Intervals(starts[some], stops[some], self.rows[some])

    def plus(self, other: Intervals) -> Intervals:
        """Both, with one entry for equal stretches."""
        both = np.concatenate(
            [np.column_stack([i.starts, i.stops]) for i in (self, other)]
        )
        places, which = np.unique(both, axis=0, return_inverse=True)
        rows = np.zeros(len(places), dtype=np.int64)
        np.add.at(rows, which.ravel(), np.concatenate([self.rows, other.rows]))
        return Intervals(places[:, 0], places[:, 1], rows)

    def stretches(self) -> Intervals:
        """Running sum over the edges: stretches that do not overlap, by time."""
        at, which = np.unique(np.concatenate([self.starts, self.stops]), return_inverse=True)
        change = np.zeros(len(at), dtype=np.int64)
        np.add.at(change, which.ravel(), np.concatenate([self.rows, -self.rows]))
        total = np.cumsum(change)
        some = np.flatnonzero(total > 0)
        return Intervals(at[some], at[some + 1] if len(some) else at[:0], total[some])


class WindowCounts(StatefulProcessor):
    """Counts of one key per window, when windows close and when late records come."""

    def __init__(self, size: int, slide: int, lateness: int):
        self.size, self.slide, self.lateness = size, slide, lateness

    def init(self, handle) -> None:
        self._handle = handle
        self._held = handle.getValueState(
            "held",
            "starts array<bigint>, stops array<bigint>, counted array<bigint>, "
            "fired_to bigint, wake bigint",
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        parts = list(rows)  # counts per slot of one micro-batch, not records
        slots = np.concatenate([np.asarray(r.slots, np.int64) for r in parts])
        counted = np.concatenate([np.asarray(r.counted, np.int64) for r in parts])
        come = Intervals(slots, slots + self.size, counted)
        return self._advance(key, timerValues.getCurrentWatermarkInMs(), come)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._advance(key, timerValues.getCurrentWatermarkInMs(), Intervals([], [], []))

    def close(self) -> None:
        pass

    def _advance(self, key, watermark: int, come: Intervals) -> Iterator[Row]:
        slide = self.slide
        held, before, wake = Intervals([], [], []), _NEVER, None
        if self._held.exists():
            starts, stops, rows, before, wake = self._held.get()
            held = Intervals(starts, stops, rows)
        # The first end still open for records, and the last one that has fired.
        open_end, fired_to = _NEVER, _NEVER
        if watermark > 0:
            open_end = _floor(watermark + 1, slide) + slide
            fired_to = _floor(watermark + self.lateness + 1, slide)
        latest = 1 << 62
        if fired_to > before:
            fresh = held.within(before + slide, fired_to + slide).stretches()
            yield from self._changes(key, fresh, False, open_end)
        kept = come.within(open_end, latest)
        too_late = (come.stops <= open_end).any()
        held = held.within(open_end, latest).plus(kept)
        touched = kept.within(_NEVER, fired_to + slide).stretches()
        if len(touched) or too_late:
            totals = held.stretches()
            parts = [totals.within(a, b) for a, b in zip(touched.starts, touched.stops)]
            again = Intervals(
                *(np.concatenate([getattr(p, c) for p in parts] or [[]])
                  for c in ("starts", "stops", "rows"))
            )
            yield from self._changes(key, again, True, open_end, too_late)
        self._keep(held, fired_to, wake)

    def _keep(self, held: Intervals, fired_to: int, wake: int | None) -> None:
        if not len(held):
            self._held.clear()
            return
        waiting = held.within(fired_to + self.slide, 1 << 62)
        # A timer goes off once the watermark is above it.
        if len(waiting):
            due = int(waiting.starts.min()) - self.lateness - 2
        else:
            due = int(held.stops.max()) - self.slide - 2
        if due != wake:
            self._handle.registerTimer(due)
        self._held.update(
            (held.starts.tolist(), held.stops.tolist(), held.rows.tolist(), fired_to, due)
        )

    def _changes(
        self, key, some: Intervals, again: bool, open_end: int, too_late: bool = False
    ) -> Iterator[Row]:
        if len(some) or too_late:
            gap = [None] * bool(too_late)  # one without counts tells of records too late
            yield Row(
                group=key[0],
                at=some.starts.tolist() + gap,
                next=some.stops.tolist() + gap,
                counted=some.rows.tolist() + gap,
                again=again,
                open_end=open_end,
            )


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch]).group_by(["group", "slot"]).aggregate(
                [([], "count_all")]
            )
            # A key's slots in one row: keyed state is visited per row.
            listed = table.group_by("group").aggregate([("slot", "list"), ("count_all", "list")])
            yield from listed.select(["group", "slot_list", "count_all_list"]).rename_columns(
                ["group", "slots", "counted"]
            ).combine_chunks().to_batches()


def window_stretches(
    df: DataFrame,
    keys: Sequence[str],
    size: int,
    slide: int,
    *,
    lateness: int = 0,
    ts: str = "ts",
) -> DataFrame:
    """Stretches ``[_at, _next)`` of window ends with ``_rows`` records each.

    ``df`` is a stream with a watermark on ``ts``, delayed by ``lateness`` too. Rows
    with ``_again`` correct windows that have fired before. ``_open_end`` is the first
    window end that was open in the micro-batch; a row without ``_rows`` says that the
    key had records too late for all their windows.
    """
    # One text per key: workers would take a number with nulls for a float.
    keyed = df.select(
        F.to_json(F.struct(*keys)).alias("group"),
        slot_end(F.unix_millis(ts), slide).alias("slot"),
    )
    changes = (
        keyed.mapInArrow(
            _count_slots, "group string, slots array<bigint>, counted array<bigint>"
        )
        .groupBy("group")
        .transformWithState(
            WindowCounts(size, slide, lateness), _CHANGES, "append", "eventTime"
        )
        .select(
            "group", "again", "open_end", F.inline(F.arrays_zip("at", "next", "counted"))
        )
    )
    types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    named = F.from_json("group", types)
    return changes.select(
        *[named[k].alias(k) for k in keys],
        F.col("at").alias("_at"),
        F.col("next").alias("_next"),
        F.col("counted").alias("_rows"),
        F.col("again").alias("_again"),
        F.col("open_end").alias("_open_end"),
    )
