"""Keyed upsert into a database table through a DB-API connection.

Spark's JDBC writer appends or replaces; it has no upsert. Rows are sent from the
tasks, each over its own connection. Rows of one window always go to the same writer,
sorted, and are committed together: a reader of the table never sees half a window.
A writer commits when ``max_rows`` rows are waiting or the first of them has waited for
``max_seconds``, at the end of the window it is in (a window has at most N rows).

A statement that fails is tried again over a new connection, ``attempts`` times in all;
what was not committed is sent anew. A task that dies is run again by Spark, and so is a
micro-batch; rows are written by key, so what it had committed is written once more.

Two attempts can also run at the same time: an executor that was given up for lost may
still be writing when its batch has been done elsewhere and a later one is under way. A
``ledger`` table in the same database keeps such a straggler out. It holds, for each
writer, the newest batch and whether that one is complete. Every transaction first claims
its writer's ledger row, which also makes attempts wait for each other: an older batch
cannot claim it and stops, a batch that is complete is not written again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..schemas import UPSERT_ROW

MAX_URL_LENGTH = 256
# The two common forms of an upsert, and of an insert that may meet its key.
_STATEMENTS = {
    "on_conflict": "INSERT INTO {table} ({columns}) VALUES ({marks})"
    " ON CONFLICT ({keys}) DO UPDATE SET {excluded}",
    "on_duplicate_key": "INSERT INTO {table} ({columns}) VALUES ({marks})"
    " ON DUPLICATE KEY UPDATE {values}",
}
_FIRST_CLAIM = {
    "on_conflict": "INSERT INTO {ledger} (writer, batch_id, complete) VALUES ({mark}, -1, 1)"
    " ON CONFLICT (writer) DO NOTHING",
    "on_duplicate_key": "INSERT IGNORE INTO {ledger} (writer, batch_id, complete)"
    " VALUES ({mark}, -1, 1)",
}


class StaleBatch(RuntimeError):
    """A newer batch has written where this one wanted to."""


@dataclass(frozen=True)
class UpsertTarget:
    """Where rows go. ``connect`` opens a connection inside a task.

    Host, user and password belong into ``connect``; nothing here holds them. ``ledger``
    names the table of :meth:`ledger_ddl`; the number of writers must not change then.
    """

    table: str
    connect: Callable[[], object]
    max_rows: int = 100
    max_seconds: float = 2.0
    writers: int = 4
    attempts: int = 3
    wait_seconds: float = 0.5
    ledger: str | None = None
    dialect: str = "on_conflict"
    mark: str = "?"

    def statement(self) -> str:
        columns, keys = UPSERT_ROW.names, UPSERT_ROW.names[:2]
        rest = columns[2:]
        return _STATEMENTS[self.dialect].format(
            table=self.table,
            columns=", ".join(columns),
            marks=", ".join([self.mark] * len(columns)),
            keys=", ".join(keys),
            excluded=", ".join(f"{c} = excluded.{c}" for c in rest),
            values=", ".join(f"{c} = VALUES({c})" for c in rest),
        )

    def trim_statement(self) -> str:
        end, rank = UPSERT_ROW.names[:2]
        return f"DELETE FROM {self.table} WHERE {end} = {self.mark} AND {rank} > {self.mark}"

    def ledger_ddl(self) -> str:
        return (
            f"CREATE TABLE {self.ledger} (writer INT NOT NULL PRIMARY KEY,"
            " batch_id BIGINT NOT NULL, complete INT NOT NULL)"
        )

    def first_claim(self) -> str:
        return _FIRST_CLAIM[self.dialect].format(ledger=self.ledger, mark=self.mark)


def checked_rows(rows: DataFrame) -> DataFrame:
    """Rows as the table declares them: no nulls, url of at most 256 characters."""
    bad = F.col("url2").isNull() | (F.char_length("url2") > MAX_URL_LENGTH)
    for name in ("endtime1", "rk", "counts2"):
        bad = bad | F.col(name).isNull()
    stop = F.raise_error(F.lit("row violates the upsert table's column constraints"))
    return rows.select(
        F.col("endtime1").cast("long"),
        F.col("rk").cast("int"),
        "url2",
        F.col("counts2").cast("long"),
    ).where(F.when(bad, stop.cast("boolean")).otherwise(F.lit(True)))


def flushes(
    rows: Iterable[Row], max_rows: int, max_seconds: float, now: Callable[[], float] = time.monotonic
) -> Iterator[list[Row]]:
    """Sorted rows in lists of whole windows: as soon as ``max_rows`` are there, or the
    first has waited for ``max_seconds``."""
    waiting: list[Row] = []
    since = 0.0
    for row in rows:
        if waiting and row.endtime1 != waiting[-1].endtime1 and (
            len(waiting) >= max_rows or now() - since >= max_seconds
        ):
            yield waiting
            waiting = []
        if not waiting:
            since = now()
        waiting.append(row)
    if waiting:
        yield waiting


class _Writer:
    """One task's side: transactions over a connection that is opened anew if it fails."""

    def __init__(self, target: UpsertTarget, number: int, batch_id: int | None):
        self.target, self.number, self.batch_id = target, number, batch_id
        self.fenced = target.ledger is not None and batch_id is not None
        self.connection = None

    def transaction(self, work: Callable[[object], object]):
        """``work`` on a cursor, committed; tried again over a new connection."""
        for attempt in range(1, self.target.attempts + 1):
            try:
                if self.connection is None:
                    self.connection = self.target.connect()
                done = work(self.connection.cursor())
                self.connection.commit()
                return done
            except StaleBatch:
                raise
            except Exception:
                self.close()
                if attempt == self.target.attempts:
                    raise
                time.sleep(self.target.wait_seconds * attempt)

    def close(self) -> None:
        """Give up the connection, and with it what was not committed."""
        connection, self.connection = self.connection, None
        if connection is not None:
            try:
                connection.rollback()
            finally:
                connection.close()

    def is_complete(self) -> bool:
        """Whether this batch has all been written before; makes the ledger row if needed."""
        mark, ledger = self.target.mark, self.target.ledger

        def look(cursor) -> bool:
            cursor.execute(self.target.first_claim(), (self.number,))
            cursor.execute(
                f"SELECT batch_id, complete FROM {ledger} WHERE writer = {mark}", (self.number,)
            )
            return tuple(cursor.fetchone()) == (self.batch_id, 1)

        return self.transaction(look)

    def claim(self, cursor, complete: int) -> None:
        mark = self.target.mark
        cursor.execute(
            f"UPDATE {self.target.ledger} SET batch_id = {mark}, complete = {mark}"
            f" WHERE writer = {mark} AND batch_id <= {mark}",
            (self.batch_id, complete, self.number, self.batch_id),
        )
        cursor.execute(
            f"SELECT batch_id FROM {self.target.ledger} WHERE writer = {mark}", (self.number,)
        )
        if cursor.fetchone()[0] != self.batch_id:
            raise StaleBatch(f"batch {self.batch_id} comes after a newer one")

    def send(self, rows: list[Row]) -> None:
        # Sorted: the last row of a window has its last rank.
        last_ranks = {row.endtime1: row.rk for row in rows}

        def work(cursor) -> None:
            if self.fenced:
                self.claim(cursor, 0)
            cursor.executemany(self.target.statement(), [tuple(row) for row in rows])
            cursor.executemany(self.target.trim_statement(), list(last_ranks.items()))

        self.transaction(work)


def upsert(rows: DataFrame, target: UpsertTarget, batch_id: int | None = None) -> None:
    """Write rows by key (endtime1, rk); the last write of a key wins.

    Ranks past a window's last one are deleted, in case an earlier version of
    that window had more. ``batch_id`` is for the ledger, where the target has one.
    """

    def send(partition: Iterator[Row]) -> None:
        from pyspark import TaskContext

        writer = _Writer(target, TaskContext.get().partitionId(), batch_id)
        try:
            if writer.fenced and writer.is_complete():
                return
            for some in flushes(partition, target.max_rows, target.max_seconds):
                writer.send(some)
            if writer.fenced:
                writer.transaction(lambda cursor: writer.claim(cursor, 1))
        finally:
            writer.close()

    by = F.pmod(F.xxhash64("endtime1"), F.lit(target.writers)).cast("int")
    (
        checked_rows(rows)
        .repartitionById(target.writers, by)
        .sortWithinPartitions("endtime1", "rk")
        .foreachPartition(send)
    )


def upsert_batches(target: UpsertTarget, transform=lambda batch: batch):
    """Handler for ``foreachBatch``; a batch written twice leaves the same table."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        upsert(transform(batch), target, batch_id)

    return handle
