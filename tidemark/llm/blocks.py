"""Groups dealt out to tasks whole, or as pairs of blocks where they are crowded.

Members of a group are to be compared with each other. A group of up to ``block`` rows
is one part. A larger one is cut into blocks by a hash, and every pair of blocks,
a block with itself included, is a part of its own: every pair of members meets in
exactly one part, and no part grows with the group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import may_broadcast, write_table

#: ``side`` of a row whose part is one block: it is compared with all others there.
WITHIN = 2


def dealt(rows: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """``rows`` with ``part`` and ``side``, in tasks by ``key`` and ``part``, sorted by both.

    In a part made of two blocks ``side`` is 0 or 1, and only rows of different sides
    are to be compared.
    """
    crowded = (
        rows.groupBy(key)
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > block)
        .select(F.col(key).alias("crowded_key"), F.ceil(F.col("n") / block).alias("blocks"))
    )
    crowded, _ = write_table(crowded, "crowded")
    side = F.broadcast(crowded) if may_broadcast(crowded.count(), 32) else crowded
    own = F.pmod(F.xxhash64(member), F.col("blocks"))
    mates = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda y: F.struct(
            (F.least(own, y) * F.col("blocks") + F.greatest(own, y)).alias("part"),
            F.when(own == y, WITHIN).when(own < y, 0).otherwise(1).cast("byte").alias("side"),
        ),
    )
    alone = F.array(
        F.struct(F.lit(0).cast("long").alias("part"), F.lit(WITHIN).cast("byte").alias("side"))
    )
    placed = rows.join(side, F.col(key) == F.col("crowded_key"), "left").select(
        *rows.columns,
        F.explode(F.when(F.col("crowded_key").isNull(), alone).otherwise(mates)).alias("place"),
    )
    return (
        placed.select(*rows.columns, "place.part", "place.side")
        .repartition(key, "part")
        .sortWithinPartitions(key, "part")
    )


def whole_parts(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole parts, from batches sorted by ``key`` and ``part``."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.column_stack([batch.column(key).to_numpy(), batch.column("part").to_numpy()])
        if last is not None and (marks[0] != last).any():
            yield pa.Table.from_batches(rest)
            rest = []
        last = marks[-1]
        others = np.flatnonzero((marks != last).any(axis=1))
        cut = int(others[-1]) + 1 if len(others) else 0
        if cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = []
        rest.append(batch.slice(cut))
    if rest:
        yield pa.Table.from_batches(rest)


def runs(table: pa.Table, key: str) -> np.ndarray:
    """Where each part begins, and the number of rows at the end."""
    keys, parts = table[key].to_numpy(), table["part"].to_numpy()
    change = (keys[1:] != keys[:-1]) | (parts[1:] != parts[:-1])
    return np.concatenate(([0], np.flatnonzero(change) + 1, [len(keys)]))
