"""Durations and epoch-millisecond arithmetic.

Durations are whole milliseconds. Inside a plan event time is a TIMESTAMP;
window bounds leave it as epoch milliseconds (LONG).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds(n: int) -> int:
    return n * 1000


def minutes(n: int) -> int:
    return n * 60_000


def hours(n: int) -> int:
    return n * 3_600_000


def interval_text(ms: int) -> str:
    """The form ``window`` and ``withWatermark`` take."""
    return f"{ms} milliseconds"


def floor_to(ms: Column, width: int) -> Column:
    """Largest multiple of ``width`` not above ``ms``, also before 1970."""
    return ms - F.pmod(ms, F.lit(width).cast("long"))


def slot_end(ms: Column, width: int) -> Column:
    """End (exclusive) of the epoch-aligned slot of ``width`` holding ``ms``."""
    return floor_to(ms, width) + F.lit(width).cast("long")


def ms_text(ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in the session zone."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")
