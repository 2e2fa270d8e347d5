"""Updating results as change rows, and back to the current table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_totals(
    partials: DataFrame, order: str, *, window: str = "window_end", count: str = "count"
) -> DataFrame:
    """The total of each window after each of its partial counts, in ``order``.

    Partials are one row per window and salt, so a window has at most as many
    rows as there are salts.
    """
    so_far = (
        Window.partitionBy(window)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    by_order = Window.partitionBy(window).orderBy(order)
    return partials.select(
        window,
        F.row_number().over(by_order).alias("version"),
        F.sum(count).over(so_far).alias(count),
    )


def to_retract(
    versions: DataFrame,
    *,
    key: str = "window_end",
    value: str = "count",
    version: str = "version",
) -> DataFrame:
    """Change rows of an updating value.

    The first version of a key is one addition; each later one takes the value
    before it back (``is_add`` false) and adds the new one. ``seq`` numbers the
    change rows of a key.
    """
    by_version = Window.partitionBy(key).orderBy(version)
    before = versions.select(
        key,
        version,
        value,
        F.lag(value).over(by_version).alias("_old"),
    )
    change = lambda flag, column, seq: F.struct(
        F.lit(flag).alias("is_add"), F.col(column).alias(value), seq.cast("int").alias("seq")
    )
    added = change(True, value, F.col(version) * 2 - 1)
    retracted = change(False, "_old", F.col(version) * 2 - 2)
    pair = F.when(F.col("_old").isNull(), F.array(added)).otherwise(F.array(retracted, added))
    return before.select(key, F.inline(pair)).select("is_add", value, key, "seq")


def ranking_changes(
    history: DataFrame,
    values: Sequence[str],
    *,
    key: str = "window_end",
    rank: str = "rk",
    version: str = "version",
) -> DataFrame:
    """Change rows between the successive versions of each key's ranking.

    ``history`` holds whole rankings; a key's versions are numbered from 1 on. A rank
    that comes is an addition, one whose ``values`` change takes the old row back
    (``is_add`` false) and adds the new one, one that vanishes is taken back, and one
    that stays as it is gives nothing. ``seq`` orders the changes of a rank.
    """
    of_rank = Window.partitionBy(key, rank).orderBy(version)
    row = F.struct(*values)
    compared = history.select(
        key,
        rank,
        version,
        row.alias("_row"),
        F.lag(row).over(of_rank).alias("_before"),
        F.lag(version).over(of_rank).alias("_came"),
        F.lead(version).over(of_rank).alias("_next"),
        F.max(version).over(Window.partitionBy(key)).alias("_last"),
    )
    follows = F.col("_came").eqNullSafe(F.col(version) - 1)
    same = follows & F.col("_row").eqNullSafe(F.col("_before"))
    vanishes = (F.col(version) < F.col("_last")) & ~F.col("_next").eqNullSafe(F.col(version) + 1)

    def change(is_add: bool, of: str, when: Column) -> Column:
        seq = 2 * when + (1 if is_add else 0)
        return F.struct(
            F.lit(is_add).alias("is_add"), seq.cast("int").alias("seq"), F.col(of).alias("_value")
        )

    changes = F.concat(
        F.when(follows & ~same, F.array(change(False, "_before", F.col(version)))).otherwise(F.array()),
        F.when(~same, F.array(change(True, "_row", F.col(version)))).otherwise(F.array()),
        F.when(vanishes, F.array(change(False, "_row", F.col(version) + 1))).otherwise(F.array()),
    )
    return compared.select(key, rank, F.inline(changes)).select(
        "is_add", key, rank, "_value.*", "seq"
    )


def latest(
    history: DataFrame,
    keys: Sequence[str],
    version: str,
    *,
    is_add: str | None = None,
) -> DataFrame:
    """The current table: of each key the row with the highest ``version``.

    Whole rows are picked, so columns never mix between revisions. With
    ``is_add`` a key whose last change is a retraction is gone.
    """
    rest = [c for c in history.columns if c not in {*keys, version}]
    picked = history.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.col(version)).alias("_row")
    )
    current = picked.select(*keys, "_row.*")
    if is_add is not None:
        current = current.where(F.col(is_add)).drop(is_add)
    return current
