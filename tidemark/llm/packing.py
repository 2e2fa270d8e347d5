"""Best-fit packing of documents into sequences, under conflicts.

Documents longer than ``capacity`` tokens are cut into pieces of that length and a rest.
Pieces are dealt at random into shards of about ``shard_rows`` and each shard is packed
by decreasing length. Open bins are kept in order of their residual capacity. A bin
carries a bitmap of the duplicate clusters in it and one of the sources that have
reached ``per_source`` pieces. A piece goes to the bin with the smallest residual that
is large enough and whose bitmaps do not hold the piece's cluster or source; the search
goes on from successor to successor until one is found, or a bin is opened.

Defined cases. A null or empty text has no tokens; its one piece of length zero takes
part and has no cluster. A null source or cluster conflicts with nothing. Equal lengths
are ordered by their random place. Rows that are repeated, or share an id, are packed
one by one. An empty table gives no rows. Texts of any length are packed whole. Extra
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import runs, whole_parts
from tidemark.llm.rows import col, text_of, word_count
from tidemark.workspace import write_table

CAPACITY = 2048
#: Pieces of one source that a bin may hold.
PER_SOURCE = 2
SHARD_ROWS = 2048
_SEED = 5


class Bins:
    """The bins of a shard, by residual capacity."""

    def __init__(self, capacity: int, per_source: int):
        self._capacity, self._per_source = capacity, per_source
        self._levels = 0  # bit r: some bin has residual r
        self._at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._clusters: list[int] = []
        self._sources: list[list[int]] = []  # bitmap i: sources with more than i pieces
        self._residual: list[int] = []

    def place(self, length: int, cluster: int, source: int) -> tuple[int, int]:
        """``(bin, offset)`` for a piece; ``cluster`` and ``source`` are one-bit maps or 0."""
        levels = self._levels >> length
        while levels:
            residual = length + (levels & -levels).bit_length() - 1
            for place, bin_ in enumerate(self._at[residual]):
                if not (self._clusters[bin_] & cluster or self._sources[bin_][-1] & source):
                    found = self._at[residual]
                    found[place] = found[-1]
                    found.pop()
                    if not found:
                        self._levels &= ~(1 << residual)
                    return self._put(bin_, length, cluster, source)
            levels = (levels & (levels - 1))
        self._clusters.append(0)
        self._sources.append([0] * self._per_source)
        self._residual.append(self._capacity)
        return self._put(len(self._residual) - 1, length, cluster, source)

    def _put(self, bin_: int, length: int, cluster: int, source: int) -> tuple[int, int]:
        offset = self._capacity - self._residual[bin_]
        self._residual[bin_] -= length
        self._clusters[bin_] |= cluster
        counts = self._sources[bin_]
        for i in range(self._per_source - 1, 0, -1):
            counts[i] |= counts[i - 1] & source
        counts[0] |= source
        self._at[self._residual[bin_]].append(bin_)
        self._levels |= 1 << self._residual[bin_]
        return bin_, offset


def _bits(codes: pa.ChunkedArray) -> list[int]:
    """A one-bit map for each value, numbered by first sight; 0 for null."""
    numbers: dict = {}
    out = []
    for code in codes.to_pylist():
        out.append(0 if code is None else 1 << numbers.setdefault(code, len(numbers)))
    return out


def _pack(capacity: int, per_source: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_parts(batches, "shard"):
            starts = runs(table, "shard")
            for low, high in zip(starts, starts[1:]):
                shard = table.slice(low, high - low)
                bins = Bins(capacity, per_source)
                placed = [
                    bins.place(*piece)
                    for piece in zip(
                        shard["n_tokens"].to_pylist(),
                        _bits(shard["cluster"]),
                        _bits(shard["source_code"]),
                    )
                ]
                found = np.array(placed, dtype=np.int64)
                ids = (shard["shard"].to_numpy() << 32) + found[:, 0]
                kept = shard.select(["id", "source", "piece", "start", "n_tokens"])
                yield from (
                    kept.append_column("bin_id", pa.array(ids))
                    .append_column("bin_offset", pa.array(found[:, 1]))
                    .combine_chunks()
                    .to_batches()
                )

    return pack


def packed_bins(
    df: DataFrame,
    id_column: str,
    text_column: str,
    source_column: str,
    cluster: Column | None = None,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per piece: ``doc_id, source, piece, start, n_tokens, bin_id, bin_offset``.

    ``start`` is the piece's first token in its document. ``cluster`` is any hashable
    column; without one, documents with equal text are a cluster.
    """
    text = text_of(col(text_column))
    same = F.xxhash64(text) if cluster is None else F.xxhash64(cluster)
    known = F.lit(True) if cluster is None else cluster.isNotNull()
    rows = df.select(
        col(id_column).alias("id"),
        col(source_column).alias("source"),
        word_count(col(text_column)).alias("tokens"),
        same.alias("cluster"),
        known.alias("known"),
        F.rand(_SEED).alias("place"),
    )
    pieces = F.greatest(F.ceil(F.col("tokens") / capacity), F.lit(1)).cast("long")
    cut = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
    start = F.col("piece") * capacity
    narrow, _ = write_table(
        cut.select(
            "id",
            "source",
            F.when(F.col("source").isNotNull(), F.xxhash64("source")).alias("source_code"),
            F.when(F.col("known") & (F.col("tokens") > 0), F.col("cluster")).alias("cluster"),
            "piece",
            start.alias("start"),
            F.least(F.col("tokens") - start, F.lit(capacity)).cast("long").alias("n_tokens"),
            "place",
        ),
        "pieces",
    )
    shards = max(1, -(-narrow.count() // shard_rows))
    dealt = narrow.withColumn(
        "shard", F.pmod(F.xxhash64("place", "piece"), F.lit(shards))
    ).withColumn("part", F.lit(0))
    kinds = dict(narrow.dtypes)
    schema = (
        f"id {kinds['id']}, source {kinds['source']}, piece long, start long, "
        "n_tokens long, bin_id long, bin_offset long"
    )
    return (
        dealt.repartition("shard")
        .sortWithinPartitions("shard", F.desc("n_tokens"), "place")
        .mapInArrow(_pack(capacity, per_source), schema)
        .withColumnRenamed("id", "doc_id")
    )
