"""Aggregates that users write, in two phases over columnar batches.

An aggregate says what to keep of a group's rows (``add``), how to join what several
tasks have kept (``merge``), and what comes out (``emit``): any number of rows for a
group. It works on Arrow tables that hold many groups at once; what it keeps, its buffer,
are rows too, and few for a group.

The first phase runs where the rows are. It adds each batch and merges what it holds, so
a task sends one buffer per group and some batches, however many rows a hot group has.
The second phase takes buffers sorted by group and merges them as they come; it never
holds a group's buffers at once, only the merged one.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Buffer rows a task holds before it sends them on.
MOST_HELD = 100_000


class Aggregate(ABC):
    """``buffer`` and ``result`` are DDL of the columns beside those of the group."""

    buffer: str
    result: str

    @abstractmethod
    def add(self, rows: pa.Table, groups: list[str]) -> pa.Table:
        """Buffers of the groups in ``rows``."""

    @abstractmethod
    def merge(self, buffers: pa.Table, groups: list[str]) -> pa.Table:
        """Buffers joined: those of equal groups into one."""

    @abstractmethod
    def emit(self, buffers: pa.Table, groups: list[str]) -> pa.Table:
        """Result rows; each group's buffer is whole."""


def _ddl(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names]


def _columns(ddl: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in ddl.split(",")]


def _batches(table: pa.Table, names: list[str]) -> Iterator[pa.RecordBatch]:
    yield from table.select(names).combine_chunks().to_batches(max_chunksize=10_000)


def partial_buffers(df: DataFrame, groups: Sequence[str], aggregate: Aggregate) -> DataFrame:
    """What the tasks that read ``df`` keep of it."""
    groups = list(groups)
    names = [*groups, *_columns(aggregate.buffer)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            come = aggregate.add(pa.Table.from_batches([batch]), groups).select(names)
            held = come if held is None else aggregate.merge(
                pa.concat_tables([held, come]), groups
            ).select(names)
            if held.num_rows > MOST_HELD:
                yield from _batches(held, names)
                held = None
        if held is not None:
            yield from _batches(held, names)

    return df.mapInArrow(run, ", ".join([*_ddl(df, groups), aggregate.buffer]))


def _starts(table: pa.Table, groups: list[str]) -> np.ndarray:
    """Where a new group begins, in a table sorted by group."""
    n = table.num_rows
    change = np.zeros(max(n - 1, 0), dtype=bool)
    for name in groups:
        column = table[name].combine_chunks()
        here, after = column.slice(0, n - 1), column.slice(1)
        differ = pc.fill_null(pc.not_equal(here, after), False)
        nulls = pc.not_equal(pc.is_null(here), pc.is_null(after))
        change |= pc.or_(differ, nulls).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.flatnonzero(change) + 1))


def aggregate_by(df: DataFrame, groups: Sequence[str], aggregate: Aggregate) -> DataFrame:
    """The aggregate's result per group: ``groups`` and its ``result`` columns."""
    groups = list(groups)
    names = [*groups, *_columns(aggregate.buffer)]
    results = [*groups, *_columns(aggregate.result)]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            # All groups but the last one are whole.
            last = int(_starts(table, groups)[-1])
            if last:
                whole = aggregate.merge(table.slice(0, last), groups)
                yield from _batches(aggregate.emit(whole, groups), results)
            held = aggregate.merge(table.slice(last), groups).select(names)
        if held is not None:
            yield from _batches(aggregate.emit(held, groups), results)

    kinds = _ddl(df, groups)
    return (
        partial_buffers(df, groups, aggregate)
        .repartition(*[F.col(g) for g in groups])
        .sortWithinPartitions(*groups)
        .mapInArrow(finish, ", ".join([*kinds, aggregate.result]))
    )


class Count(Aggregate):
    """Rows of a group."""

    def __init__(self, name: str = "count"):
        self.name = name
        self.buffer = self.result = f"{name} long"

    def add(self, rows: pa.Table, groups: list[str]) -> pa.Table:
        counted = rows.group_by(groups).aggregate([([], "count_all")])
        return counted.select([*groups, "count_all"]).rename_columns([*groups, self.name])

    def merge(self, buffers: pa.Table, groups: list[str]) -> pa.Table:
        summed = buffers.group_by(groups).aggregate([(self.name, "sum")])
        return summed.select([*groups, f"{self.name}_sum"]).rename_columns([*groups, self.name])

    def emit(self, buffers: pa.Table, groups: list[str]) -> pa.Table:
        return buffers


class TopCounts(Aggregate):
    """The ``n`` keys with the largest counts of a group, ranked; of a key that comes
    several times the largest count."""

    def __init__(self, n: int, key: str, count: str, *, key_type: str = "string", rank: str = "rk"):
        self.n, self.key, self.count, self.rank = n, key, count, rank
        self.buffer = f"{key} {key_type}, {count} long"
        self.result = f"{rank} int, {key} {key_type}, {count} long"

    def _ranked(self, rows: pa.Table, groups: list[str]) -> tuple[pa.Table, np.ndarray]:
        best = rows.group_by([*groups, self.key]).aggregate([(self.count, "max")])
        best = best.select([*groups, self.key, f"{self.count}_max"])
        best = best.rename_columns([*groups, self.key, self.count])
        order = [*[(g, "ascending") for g in groups], (self.count, "descending"), (self.key, "ascending")]
        best = best.take(pc.sort_indices(best, order))
        starts = _starts(best, groups)
        rank = np.arange(best.num_rows) - np.repeat(starts, np.diff(np.append(starts, best.num_rows))) + 1
        return best, rank

    def add(self, rows: pa.Table, groups: list[str]) -> pa.Table:
        best, rank = self._ranked(rows, groups)
        return best.filter(pa.array(rank <= self.n))

    merge = add

    def emit(self, buffers: pa.Table, groups: list[str]) -> pa.Table:
        best, rank = self._ranked(buffers, groups)
        return best.append_column(self.rank, pa.array(rank.astype(np.int32)))
