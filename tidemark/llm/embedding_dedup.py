"""Near-duplicate embeddings by counting collisions of one-dimensional projections.

Vectors of equal label and length are compared by cosine. Every unit vector is projected
on ``PROJECTIONS`` random directions. Each projection of a part of the rows is sorted; a
row's window on it is the stretch of the sorted values within ``WINDOW`` distances of its
own, found by two binary searches. Who is in a row's windows is counted per pair. A pair
at the cosine bound lies within the window of each projection with a known probability,
so the count that such a pair reaches with probability ``RECALL`` is the count from which
a pair is verified: exactly, in double precision, on the vectors themselves. These are
fetched for such pairs only; what is shuffled before are ids and rounded projections.

Which rows are a part: a window of one projection holds a fifth of all unit vectors of a
label, so pairs from windows over whole labels would grow with the square of a label.
The rows of a label are therefore sorted into cells by windows over a few of the
projections, in several rounds with other projections and shifts. The number of
projections per cell grows with the logarithm of the label's rows, so that a cell of
unrelated vectors keeps its size, and the number of rounds follows from the same recall.
A pair that shares cells in several rounds is counted in the first of them only. A
crowded cell is compared as pairs of blocks.

With ``recall=None`` nothing is left to chance: every pair of a label is compared, block
by block, which is quadratic in a label's rows.

Defined cases. A vector that is null, empty, zero, or holds a null or non-finite
component, and one without a label, links with nothing: no links, its own component.
Vectors of different lengths are never compared. Rows that share an id are rows of
their own; they link by their vectors and count each other. A component without any id
has a null id. An empty table gives no rows. Extra columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import WITHIN, dealt, runs, whole_parts
from tidemark.llm.components import components
from tidemark.llm.rows import col
from tidemark.workspace import may_broadcast, write_table

LEAST_COSINE = 0.93
PROJECTIONS = 64
#: Half a window, in distances of a pair at the cosine bound.
WINDOW = 1.0
#: A cell's width, in the same distances.
CELL = 4.0
#: Of pairs at the cosine bound, the share that shares a cell, and that is counted so.
RECALL = 0.995
#: Rows of one cell that are compared in one task.
BLOCK = 1024
#: Chance that unrelated unit vectors share a cell's window on one projection.
_FAR_CELL = 0.4
_SEED = 20
#: Projections are rounded to so many steps in the distance of a pair at the bound.
_STEPS = 256


def _normal_within(x: float) -> float:
    return math.erf(x / math.sqrt(2))


def least_collisions(projections: int, window: float, recall: float) -> int:
    """The most collisions that a pair at the bound still reaches with ``recall``."""
    p, tail = _normal_within(window), 0.0
    for count in range(projections, -1, -1):
        tail += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if tail >= recall:
            return count
    return 0


def _near_cell(cell: float) -> float:
    """Chance that a pair at the bound shares a randomly shifted cell of one projection."""
    rest = 2 / (math.sqrt(2 * math.pi) * cell) * (1 - math.exp(-cell * cell / 2))
    return _normal_within(cell) - rest


def _directions(length: int) -> np.ndarray:
    return np.random.default_rng([_SEED, length]).standard_normal((length, PROJECTIONS))


def _cells(projected: np.ndarray, width: float, per_cell: int, round_: int) -> np.ndarray:
    """The cell of each row in a round, as a 64-bit mix of its windows' numbers."""
    draw = np.random.default_rng([_SEED, per_cell, round_])
    axes = draw.choice(PROJECTIONS, size=per_cell, replace=False)
    shift = draw.random(per_cell) * width
    windows = np.floor((projected[:, axes] + shift) / width).astype(np.int64).view(np.uint64)
    mixed = np.full(len(projected), round_ + 1, dtype=np.uint64)
    for i in range(per_cell):
        mixed = (mixed ^ windows[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def _units(vectors: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    rows = flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, length)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _rounded(vectors: pa.Array, length: int, delta: float) -> np.ndarray:
    """Projections in steps; unit vectors keep them within 16 bits."""
    projected = _units(vectors, length) @ _directions(length)
    limit = np.iinfo(np.int16).max
    return np.clip(np.rint(projected * (_STEPS / delta)), -limit, limit).astype(np.int16)


def _in_cells(delta: float):
    """Each row once per round, with the cell it falls into and its projections."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            shape = np.column_stack([lengths, batch.column("per_cell").to_numpy()])
            for length, per_cell in np.unique(shape, axis=0).tolist():
                some = batch.take(pa.array(np.flatnonzero((shape == [length, per_cell]).all(axis=1))))
                rounded = _rounded(some.column("vector"), length, delta)
                sketch = pa.array([row.tobytes() for row in rounded], pa.binary())
                n, rounds = some.num_rows, int(some.column("rounds")[0].as_py())
                for round_ in range(rounds):
                    cell = _cells(rounded, CELL * _STEPS, per_cell, round_)
                    yield pa.RecordBatch.from_arrays(
                        [some.column("uid"), some.column("group"), pa.array(cell),
                         pa.array(np.full(n, round_, np.int32)),
                         pa.array(np.full(n, per_cell, np.int32)), sketch],
                        names=["uid", "group", "cell", "round", "per_cell", "sketch"],
                    )

    return place


_PLACED = "uid long, group long, cell long, round int, per_cell int, sketch binary"


class _Sorted:
    """Every projection of ``rows`` sorted, all of them one after the other in a line."""

    def __init__(self, rows: np.ndarray):
        self.n, axes = rows.shape
        self._offset = np.arange(axes, dtype=np.int64) * (1 << 20)
        order = np.argsort(rows, axis=0, kind="stable")
        self._line = (np.take_along_axis(rows, order, axis=0) + self._offset).T.ravel()
        self._first = np.arange(axes, dtype=np.int64) * self.n
        self._place = np.uint16 if self.n < 1 << 16 else np.uint32
        self._rank = np.empty((axes, self.n), self._place)
        np.put_along_axis(self._rank, order.T, np.arange(self.n, dtype=self._place), axis=1)

    def collisions(self, queries: np.ndarray, half: int) -> np.ndarray:
        """How many projections have each of the rows in the window around each query.

        A window is a stretch of a sorted projection, found by two binary searches; a row
        is in it if its place there is.
        """
        centre = queries.astype(np.int64) + self._offset
        low = np.searchsorted(self._line, (centre - half).ravel(), side="left")
        high = np.searchsorted(self._line, (centre + half).ravel(), side="right")
        start = (low.reshape(centre.shape) - self._first).astype(self._place)
        size = (high - low).reshape(centre.shape).astype(self._place)
        counts = np.zeros((len(queries), self.n), np.uint16)
        for axis, rank in enumerate(self._rank):
            # Places before a window wrap round and are past its end.
            counts += (rank - start[:, axis, None]) < size[:, axis, None]
        return counts


def _collisions(queries: np.ndarray, rows: np.ndarray, half: int) -> np.ndarray:
    return _Sorted(rows).collisions(queries, half)


def _candidates(recall: float):
    """Pairs of a part that reach the count, each in the first round they share a cell."""
    enough = least_collisions(PROJECTIONS, WINDOW, recall)
    half = int(WINDOW * _STEPS) + 1  # a step more than rounding takes

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_parts(batches, "key"):
            starts = runs(table, "key")
            for low, high in zip(starts, starts[1:]):
                if high - low > 1:
                    yield from _pairs_of(table.slice(low, high - low))

    def _pairs_of(part: pa.Table) -> Iterator[pa.RecordBatch]:
        sketch = b"".join(part["sketch"].to_pylist())
        rounded = np.frombuffer(sketch, dtype=np.int16).reshape(part.num_rows, -1)
        side, uid = part["side"].to_numpy(), part["uid"].to_numpy()
        cell, group = part["cell"].to_numpy(), part["group"].to_numpy()
        per_cell, rounds = part["per_cell"][0].as_py(), part["round"][0].as_py()
        earlier = [_cells(rounded, CELL * _STEPS, per_cell, r) for r in range(rounds)]
        left = np.flatnonzero(side != 1)
        within = side[0] == WITHIN
        right = left if within else np.flatnonzero(side == 1)
        ordered = _Sorted(rounded[right])
        for at in range(0, len(left), 128):
            tile = left[at : at + 128]
            i, j = np.nonzero(ordered.collisions(rounded[tile], half) >= enough)
            i, j = tile[i], right[j]
            fits = (group[i] == group[j]) & (cell[i] == cell[j])
            if within:
                fits &= i < j
            for cells in earlier:
                fits &= cells[i] != cells[j]
            if fits.any():
                yield _pairs(uid[i[fits]], uid[j[fits]])

    return compare


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


def _verified(least: float):
    """Pairs with their vectors: those at the bound."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            for length in np.unique(lengths).tolist():
                some = batch.take(pa.array(np.flatnonzero(lengths == length)))
                near = _cosines(
                    _units(some.column("vector"), length), _units(some.column("mate_vector"), length)
                ) >= least
                kept = some.filter(pa.array(near))
                yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    return verify


def _all_pairs(least: float):
    """The exact mode: all pairs of a part on their vectors."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_parts(batches, "key"):
            starts = runs(table, "key")
            for low, high in zip(starts, starts[1:]):
                part = table.slice(low, high - low)
                units = _units(part["vector"], part["length"][0].as_py())
                side, uid, group = (part[c].to_numpy() for c in ("side", "uid", "group"))
                left, within = np.flatnonzero(side != 1), side[0] == WITHIN
                right = left if within else np.flatnonzero(side == 1)
                # The product finds them but for its rounding, the sum per pair decides.
                i, j = np.nonzero(units[left] @ units[right].T >= least - 1e-9)
                i, j = left[i], right[j]
                fits = (group[i] == group[j]) & (_cosines(units[i], units[j]) >= least)
                if within:
                    fits &= i < j
                if fits.any():
                    yield _pairs(uid[i[fits]], uid[j[fits]])

    return compare


def _found_by_collisions(fit: DataFrame, least: float, block: int, recall: float) -> DataFrame:
    delta = math.sqrt(2 - 2 * least)
    sizes = fit.groupBy(F.col("group").alias("own_group")).agg(F.count("*").alias("rows"))
    per_cell = F.least(
        F.greatest(F.round(F.log(F.col("rows") / block) / math.log(1 / _FAR_CELL)), F.lit(0.0)),
        F.lit(16.0),
    )
    missed = 1 - F.pow(F.lit(_near_cell(CELL)), F.col("per_cell"))
    sizes = sizes.withColumn("per_cell", per_cell).select(
        "own_group",
        F.col("per_cell").cast("int").alias("per_cell"),
        F.when(F.col("per_cell") == 0, 1)
        .otherwise(F.ceil(math.log(1 - recall) / F.log(missed)))
        .cast("int")
        .alias("rounds"),
    )
    sizes, _ = write_table(sizes, "labels")
    side = F.broadcast(sizes) if may_broadcast(sizes.count(), 64) else sizes
    placed = fit.join(side, F.col("group") == F.col("own_group")).drop("own_group")
    cells, _ = write_table(
        placed.mapInArrow(_in_cells(delta), _PLACED).withColumn(
            "key", F.xxhash64("group", "round", "cell")
        ),
        "cells",
    )
    pairs, _ = write_table(
        dealt(cells, "key", "uid", block).mapInArrow(_candidates(recall), "a long, b long"), "pairs"
    )
    mates = fit.select(F.col("uid").alias("b"), F.col("vector").alias("mate_vector"),
                       F.col("group").alias("mate_group"))
    return (
        pairs.join(fit.withColumnRenamed("uid", "a"), "a")
        .join(mates, "b")
        .where("group = mate_group")
        .select("a", "b", "length", "vector", "mate_vector")
        .mapInArrow(_verified(least), "a long, b long")
    )


def near_vectors(
    df: DataFrame,
    id_column: str,
    vector_column: str,
    label_column: str,
    least: float = LEAST_COSINE,
    block: int = BLOCK,
    recall: float | None = RECALL,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    ``recall`` is the share of pairs at the bound that share a cell, and that of those
    which reach the count; closer pairs are found more often. None: all pairs.
    """
    vector = col(vector_column)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = col(label_column).isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)
    numbered, _ = write_table(
        df.select(
            F.monotonically_increasing_id().alias("uid"),
            col(id_column).alias("vec_id"),
            F.xxhash64(col(label_column), F.size(vector)).alias("group"),
            vector.alias("vector"),
            F.coalesce(fit, F.lit(False)).alias("fit"),
            F.size(vector).alias("length"),
        ),
        "vectors",
    )
    rows = numbered.where("fit").select("uid", "group", "length", "vector")
    if recall is None:
        found = dealt(rows.withColumn("key", F.col("group")), "key", "uid", block).mapInArrow(
            _all_pairs(least), "a long, b long"
        )
    else:
        found = _found_by_collisions(rows, least, block, recall)
    links, _ = write_table(found, "vector-links")
    both = links.select(F.col("a").alias("c_uid")).unionByName(links.select(F.col("b").alias("c_uid")))
    counts = both.groupBy("c_uid").agg(F.count("*").alias("n"))
    # A node is named so that the least of a component is the answer.
    node = F.struct(F.col("vec_id").isNull().alias("no_id"), "vec_id", "uid")
    own = numbered.select("uid", "vec_id", node.alias("node"))
    ends = own.select("uid", "node")
    named = links.join(ends.toDF("a", "x"), "a").join(ends.toDF("b", "y"), "b")
    parts = components(named, "x", "y").select(
        F.col("node.uid").alias("p_uid"), F.col("component.vec_id").alias("component_id")
    )
    return (
        own.join(counts, F.col("uid") == F.col("c_uid"), "left")
        .join(parts, F.col("uid") == F.col("p_uid"), "left")
        .select(
            "vec_id",
            F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("p_uid").isNull(), F.col("vec_id"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
