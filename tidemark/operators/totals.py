"""Page-view totals per window, plain and salted in two phases."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import interval_text
from ..functions.salts import hashed_salt
from .windows import tumbling_count


def plain_total(df: DataFrame, size: int, *, ts: str = "ts") -> DataFrame:
    """Rows per tumbling window. The partial count per task already levels skew."""
    return tumbling_count(df, [], size, ts=ts)


def partial_counts(
    df: DataFrame, size: int, salt: Column, *, ts: str = "ts", salt_name: str = "salt_key"
) -> DataFrame:
    """First phase: rows per window and salt key."""
    return tumbling_count(df.withColumn(salt_name, salt), [salt_name], size, ts=ts)


def sum_partials(
    partials: DataFrame, *, window: str = "window_end", count: str = "count", name: str = "count"
) -> DataFrame:
    """Second phase: one total per window end."""
    return partials.groupBy(window).agg(F.sum(count).alias(name))


def hot_keys(df: DataFrame, key: str, share: float) -> list:
    """Keys that may hold more than ``share`` of all rows, from a heavy-hitter sketch.

    The sketch tracks enough items for its error to be below half the share; so no such
    key is missed, and what is named has at least half the share. At most ``2 / share``
    keys, whatever the number of rows. A null key is named too, as None.
    """
    most, tracked = ceil(2 / share), ceil(16 / share)
    # Texts of keys behind a mark: the sketch leaves nulls out.
    named = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-"))
    found = df.select(named.alias("_key")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_key, {most}, {tracked})").alias("top")
    ).first()
    least = found.n * share / 2
    return [t.item[1:] if t.item != "-" else None for t in found.top or [] if t["count"] >= least]


def hot_salted(df: DataFrame, key: str, hot: list, salt: Column) -> Column:
    """``salt`` for rows of the ``hot`` keys, null for all others."""
    text = F.col(key).cast("string")
    is_hot = text.isin([k for k in hot if k is not None]) if any(k is not None for k in hot) else F.lit(False)
    if None in hot:
        is_hot = is_hot | text.isNull()
    return F.when(is_hot, salt)


def hot_salted_count(
    df: DataFrame,
    key: str,
    size: int,
    *,
    share: float = 0.05,
    salt: Column | None = None,
    ts: str = "ts",
) -> DataFrame:
    """Rows per key and tumbling window in two phases, salted for hot keys only.

    Equals the plain count for any skew. Keys below the share keep one group each, so
    the second phase sees no more rows for them than there are keys and windows.
    """
    salt = hashed_salt("", ts) if salt is None else salt
    salted = df.withColumn("_salt", hot_salted(df, key, hot_keys(df, key, share), salt))
    return (
        tumbling_count(salted, [key, "_salt"], size, ts=ts)
        .groupBy("window_end", key)
        .agg(F.sum("count").alias("count"))
    )


def salted_total(
    df: DataFrame, size: int, *, salt: Column | None = None, ts: str = "ts"
) -> DataFrame:
    """Two-phase count of rows per tumbling window; equals :func:`plain_total`.

    The default salt hashes the event time, so it needs no further column and a
    repeated task attempt repeats it. On a stream both phases are chained
    aggregations in append mode, keyed by the window itself: grouping by a bare
    window end would lose the watermark.
    """
    salt = hashed_salt("pv_", ts) if salt is None else salt
    if not df.isStreaming:
        return sum_partials(partial_counts(df, size, salt, ts=ts))
    window = F.window(ts, interval_text(size))
    first = df.groupBy(window.alias("_w"), salt.alias("salt_key")).agg(
        F.count(F.lit(1)).alias("count")
    )
    return (
        first.groupBy("_w")
        .agg(F.sum("count").alias("count"))
        .select(F.unix_millis("_w.end").alias("window_end"), "count")
    )
