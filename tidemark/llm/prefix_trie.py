"""The trie of conversations' prefixes, from sorted neighbours and range minima.

A conversation is a path of turns; a turn is known by a digest of role and text. All
paths are sorted, by path and id. The common prefix of each path with its predecessor
(LCP) then says all about the trie: a path's prefix of depth d stands for a node, whose
members are the longest stretch around the path with no LCP below d in it. A path brings
the nodes deeper than its own LCP; these are the candidates, one for each node.

*Extents.* Over the LCPs lies a sparse table: row k holds the minimum of each 2^k
neighbours. Every candidate, and the parent of every candidate, binary-searches its left
and its right extent by itself in this table, all of them at once as arrays. Nothing is
carried from one to the next, no stack, no order. Members, the smallest id (a sparse table
over ids), children and sums over subtrees (differences of running sums, as a subtree is a
stretch of candidates) follow from the extents.

*Shards.* The sorted paths are range-partitioned by path and id, so equal paths are spread
too, and each task does the above for its shard. A stretch within a shard is complete. One
that touches its edge may go on: for each depth at the edge the shard gives one row of
partial counts. The first and last paths of all shards, with the LCPs between them, are a
sequence like the paths; the same extents over the same kind of table give the node of each
edge row. Edge rows are then added up by node, and one task links what is left: nodes that
cross the edge of a shard, some for each shard. What the driver gets is three numbers per
shard; a shard has about ``shard_rows`` paths.

*Ends.* The ids that end at a node follow each other in the sorted order. Nodes inside a
shard hash them there. For others each shard joins its ids to one text, and the digest
reads these one after the other; no list of ids is gathered.

Defined cases. Null roles and texts are empty. Turns stand by turn number, nulls first,
ties by the digest of role and text; repeated rows are turns of their own. Rows without
conversation id belong to no conversation. An empty table gives no nodes. A conversation's
path is one row of 36 bytes a turn, whatever its texts. Extra columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import col, text_of
from tidemark.session import shuffle_partitions
from tidemark.workspace import new_folder, write_table

#: Bytes of a turn's digest.
STEP = 16
SHARD_ROWS = 50_000

_EMPTY = hashlib.sha256(b"").hexdigest()
# Where a stretch touches the shard's edge.
_FIRST, _LAST, _WHOLE = 0, 1, 2


# -- paths -----------------------------------------------------------------------


def paths(
    df: DataFrame, id_column: str, turn_column: str, role_column: str, text_column: str
) -> DataFrame:
    """One row per conversation: ``conv_id, turns``, turns as ``step`` (hex) and ``chars``."""
    role, text = text_of(col(role_column)), text_of(col(text_column))
    told = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        col(turn_column).alias("turn"),
        F.substring(F.sha2(told, 256), 1, 2 * STEP).alias("step"),
        F.char_length(text).cast("long").alias("chars"),
    )
    return (
        df.where(col(id_column).isNotNull())
        .groupBy(col(id_column).cast("long").alias("conv_id"))
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: t.dropFields("turn")).alias("turns"))
    )


def rebuilt(own: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Paths whose first ``head`` turns are those of the conversation ``base``.

    ``base`` and ``head`` are expressions of ``conv_id``; a base is its own base, and no
    head is longer than ``most``. A base that is absent has no turns.
    """
    own, _ = write_table(own, "conversations")
    heads = own.where(base == F.col("conv_id")).select(
        F.col("conv_id").alias("base_id"), F.slice("turns", 1, most).alias("first")
    )
    return own.join(heads, base == F.col("base_id"), "left").select(
        "conv_id",
        F.concat(
            F.coalesce(F.slice("first", F.lit(1), head), F.slice("turns", 1, 0)),
            F.slice("turns", head + 1, F.greatest(F.size("turns"), F.lit(1))),
        ).alias("turns"),
    )


# -- extents ---------------------------------------------------------------------


class Minima:
    """A sparse table of range minima."""

    def __init__(self, values: np.ndarray):
        self.levels = [np.asarray(values, dtype=np.int64)]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            below, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least value from ``low`` to ``high``, both included."""
        out = np.empty(len(low), dtype=np.int64)
        kind = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        for k in np.unique(kind):
            own = kind == k
            level = self.levels[k]
            out[own] = np.minimum(level[low[own]], level[high[own] + 1 - (1 << int(k))])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """How far right from ``at`` no value is below ``depth``; values behind ``at`` count."""
        found, n = at.copy(), len(self.levels[0])
        for k in reversed(range(len(self.levels))):
            start = found + 1
            inside = start + (1 << k) <= n
            least = self.levels[k][np.where(inside, start, 0)]
            found = np.where(inside & (least >= depth), found + (1 << k), found)
        return found

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """How far left from ``at`` no value is below ``depth``; the value at ``at`` counts."""
        found = at.copy()
        for k in reversed(range(len(self.levels))):
            start = found + 1 - (1 << k)
            inside = start >= 1
            least = self.levels[k][np.where(inside, start, 0)]
            found = np.where(inside & (least >= depth), found - (1 << k), found)
        return found


def common_steps(a: bytes, b: bytes) -> int:
    """How many steps two paths share."""
    low, high = 0, min(len(a), len(b)) // STEP
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * STEP : middle * STEP] == b[low * STEP : middle * STEP]:
            low = middle
        else:
            high = middle - 1
    return low


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(values)))


# -- one shard --------------------------------------------------------------------

_NODE = (
    "shard int, depth long, conv_id long, parent_conv_id long, parent_side int, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
_EDGE = (
    "shard int, side int, depth long, least_id long, chars long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends string"
)
_SHARD = "shard int, inner long, first binary, last binary"
_KINDS = {"node": _NODE, "edge": _EDGE, "shard": _SHARD}
_ALL = "kind string, " + ", ".join(f"{k} struct<{v.replace(' ', ': ').replace(',:', ',')}>" for k, v in _KINDS.items())


def _ids(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def _shard(number: int, ids: np.ndarray, keys: list[bytes], chars: np.ndarray) -> dict[str, dict]:
    """Nodes, edge rows and the shard's own row, as columns. ``chars`` are those of all turns."""
    n = len(ids)
    size = np.array([len(k) // STEP for k in keys], dtype=np.int64)
    lcp = np.zeros(n, dtype=np.int64)
    lcp[1:] = [common_steps(a, b) for a, b in zip(keys, keys[1:])]
    minima, least_id = Minima(lcp), Minima(ids)
    starts, turn_at = _sums(size - lcp), _sums(size)
    # Candidates: the prefixes of each path that go deeper than its LCP, by path and depth.
    row = np.repeat(np.arange(n), size - lcp)
    depth = np.arange(len(row)) - starts[row] + lcp[row] + 1
    low, high = minima.left(row, depth), minima.right(row, depth)
    inside = (low > 0) & (high < n - 1)
    members = high - low + 1
    weight = np.where(inside, (members - 1) * chars[turn_at[row] + depth - 1], 0)
    # Parents are prefixes too: they search by themselves. A parent starts where it is new.
    above = depth - 1
    parent_low, parent_high = minima.left(row, above), minima.right(row, above)
    first, last = parent_low == 0, parent_high == n - 1
    open_side = np.where(first & last, _WHOLE, np.where(first, _FIRST, np.where(last, _LAST, -1)))
    parent = starts[parent_low] + above - lcp[parent_low] - 1
    own = inside & (open_side < 0)
    children = np.bincount(parent[own], minlength=len(row))
    leaf = inside & (children == 0)
    # No member of a node inside a shard is elsewhere, so its subtree is complete here.
    leaf_sums, saved_sums = _sums(leaf), _sums(weight)
    # Paths that are alike follow each other.
    alike = np.concatenate(([False], (lcp[1:] == size[1:]) & (size[1:] == size[:-1])))
    run_end = np.append(np.flatnonzero(~alike), n)
    run_end = run_end[np.searchsorted(run_end, np.arange(n), side="right")]

    picked = np.flatnonzero(inside)
    end, at = starts[high[picked] + 1], row[picked]
    ends = [
        hashlib.sha256(_ids(ids[i : run_end[i]]).encode()).hexdigest() if d == size[i] else _EMPTY
        for i, d in zip(at.tolist(), depth[picked].tolist())
    ]
    smallest = least_id.least(low[picked], high[picked])
    parent_smallest = least_id.least(parent_low[picked], parent_high[picked])
    is_open = open_side[picked] >= 0
    nodes = {
        "shard": np.full(len(picked), number),
        "depth": depth[picked],
        "conv_id": smallest,
        "parent_conv_id": np.ma.array(parent_smallest, mask=is_open),
        "parent_side": np.ma.array(open_side[picked], mask=~is_open),
        "n_convs": members[picked],
        "n_children": children[picked],
        "n_leaves": leaf_sums[end] - leaf_sums[picked],
        "saved_tokens": saved_sums[end] - saved_sums[picked],
        "ends_sha256": ends,
    }

    inner = int(lcp[1:].min()) if n > 1 else int(size[0])
    edges: dict[str, list] = {name.split()[0]: [] for name in _EDGE.split(", ")}
    for side, path, depths in (
        (_WHOLE, 0, np.arange(0, inner + 1)),
        (_FIRST, 0, np.arange(inner + 1, size[0] + 1)),
        (_LAST, n - 1, np.arange(inner + 1, size[n - 1] + 1)),
    ):
        at = np.full(len(depths), path)
        low, high = minima.left(at, depths), minima.right(at, depths)
        touching = np.bincount(
            depth[inside & (open_side == side)], minlength=int(size.max()) + 2
        )
        a, b = starts[low], starts[high + 1]
        last_turn = np.maximum(turn_at[low] + depths - 1, 0)
        for values in zip(
            [number] * len(depths),
            [side] * len(depths),
            depths.tolist(),
            least_id.least(low, high).tolist(),
            np.where(depths > 0, chars[last_turn] if len(chars) else 0, 0).tolist(),
            (high - low + 1).tolist(),
            touching[depths + 1].tolist(),
            (leaf_sums[b] - leaf_sums[a]).tolist(),
            (saved_sums[b] - saved_sums[a]).tolist(),
            [_ids(ids[i : run_end[i]]) if d == size[i] else None
             for i, d in zip(low.tolist(), depths.tolist())],
        ):
            for column, value in zip(edges.values(), values):
                column.append(value)
    shard = {"shard": [number], "inner": [inner], "first": [keys[0]], "last": [keys[-1]]}
    return {"node": nodes, "edge": edges, "shard": shard}


def _tagged(kind: str, columns: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of one kind as batches of the common schema."""
    own = schema.field(kind).type
    arrays = []
    for field in own:
        values = columns[field.name]
        if isinstance(values, np.ma.MaskedArray):
            arrays.append(pa.array(values.data, field.type, mask=np.ma.getmaskarray(values)))
        else:
            arrays.append(pa.array(values, field.type))
    rows = pa.StructArray.from_arrays(arrays, fields=list(own))
    for at in range(0, len(rows), 10_000):
        some = rows.slice(at, 10_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(some))]
            + [some if k == kind else pa.nulls(len(some), schema.field(k).type) for k in _KINDS],
            schema=schema,
        )


def _arrow(ddl: str) -> pa.DataType:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.struct([pa.field(n, kinds[t]) for n, t in (c.split() for c in ddl.split(", "))])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, keys, chars = [], [], []
    for batch in batches:
        ids.append(batch.column("conv_id").to_numpy())
        keys += batch.column("path").to_pylist()
        chars.append(batch.column("chars").flatten().to_numpy())
    if keys:
        schema = pa.schema(
            [pa.field("kind", pa.string())] + [pa.field(k, _arrow(v)) for k, v in _KINDS.items()]
        )
        number = TaskContext.get().partitionId()
        found = _shard(number, np.concatenate(ids), keys, np.concatenate(chars))
        for kind, columns in found.items():
            yield from _tagged(kind, columns, schema)


# -- nodes that cross the edge of a shard -------------------------------------------


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``shard, inner, before``: steps shared with the path that stands before the shard."""
    for batch in batches:
        before = [
            -1 if last is None else common_steps(last, first)
            for last, first in zip(batch.column("previous").to_pylist(), batch.column("first").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("shard"), batch.column("inner"), pa.array(before, pa.int64())],
            names=["shard", "inner", "before"],
        )


def _edge_nodes(numbers: list[int], lcps: list[int]):
    """Edge rows with their node's extents among the first and last paths of all shards."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima, shards = Minima(np.array(lcps)), np.array(numbers)
        for batch in batches:
            depth, side = batch.column("depth").to_numpy(), batch.column("side").to_numpy()
            at = 2 * np.searchsorted(shards, batch.column("shard").to_numpy()) + (side == _LAST)
            found = (minima.left(at, depth), minima.right(at, depth))
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(f, pa.int64()) for f in found],
                names=batch.schema.names + ["low", "high"],
            )

    return find


def _linked(lcps: list[int]):
    """Crossing nodes, all of them sorted by ``low`` and ``depth``, as complete nodes."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = list(batches)
        if not some:
            return
        table = pa.Table.from_batches(some)
        columns = {n: table.column(n).to_numpy() for n in table.schema.names}
        low, high, depth = columns["low"], columns["high"], columns["depth"]
        minima = Minima(np.array(lcps))
        at = low << 32 | depth  # sorted
        above = np.where(depth > 0, minima.left(low, depth - 1) << 32 | (depth - 1), 0)
        parent = np.searchsorted(at, above)
        below_root = depth > 0
        children = columns["n_children"] + np.bincount(parent[below_root], minlength=len(at))
        weight = (columns["n_convs"] - 1) * columns["chars"]
        leaf_sums, saved_sums = _sums(children == 0), _sums(weight)
        own, end = np.arange(len(at)), np.searchsorted(at, (high + 1) << 32)
        found = {
            "low": low,
            "depth": depth,
            "conv_id": columns["conv_id"],
            "parent_conv_id": np.ma.array(columns["conv_id"][parent], mask=~below_root),
            "n_convs": columns["n_convs"],
            "n_children": children,
            "n_leaves": columns["n_leaves"] + leaf_sums[end] - leaf_sums[own],
            "saved_tokens": columns["saved_tokens"] + saved_sums[end] - saved_sums[own],
        }
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ma.getdata(v), pa.int64(), mask=np.ma.getmaskarray(v)) for v in found.values()],
            names=list(found),
        )

    return link


_LINKED = (
    "low long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long"
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ids, whose parts come one after the other."""
    node, digest = None, None
    done: list[tuple] = []
    for batch in batches:
        for low, depth, ends in zip(*(batch.column(c).to_pylist() for c in ("low", "depth", "ends"))):
            if (low, depth) != node:
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = (low, depth), hashlib.sha256(ends.encode())
            else:
                digest.update(("," + ends).encode())
    if node:
        done.append((*node, digest.hexdigest()))
        columns = list(zip(*done))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2])],
            names=["e_low", "e_depth", "ends_sha256"],
        )


def nodes(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of the trie of :func:`paths`, the root included.

    ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.
    """
    spark = conversations.sparkSession
    sortable, _ = write_table(
        conversations.select(
            "conv_id",
            F.unhex(F.array_join("turns.step", "")).alias("path"),
            F.col("turns.chars").alias("chars"),
        ),
        "paths",
    )
    n = max(shuffle_partitions(spark), -(-sortable.count() // shard_rows))
    found = new_folder(spark, "trie")
    (
        sortable.repartitionByRange(n, "path", "conv_id")
        .sortWithinPartitions("path", "conv_id")
        .mapInArrow(_shards, _ALL)
        .write.partitionBy("kind")
        .parquet(found)
    )
    rows = spark.read.schema(_ALL).parquet(found)

    def kind(name: str) -> DataFrame:
        return rows.where(F.col("kind") == name).select(f"{name}.*")

    # One row per shard in one task, then three numbers per shard on the driver.
    by_shard = Window.orderBy("shard")
    shards = (
        kind("shard")
        .select("shard", "inner", "first", F.lag("last").over(by_shard).alias("previous"))
        .mapInArrow(_neighbours, "shard int, inner long, before long")
        .collect()
    )
    shards.sort()
    numbers = [s.shard for s in shards]
    lcps = [steps for s in shards for steps in (s.before, s.inner)]

    edges, _ = write_table(
        kind("edge").mapInArrow(_edge_nodes(numbers, lcps), f"{_EDGE}, low long, high long"),
        "edges",
    )
    # An edge row of a shard's last path counts once for its node, as does a whole shard.
    crossing = edges.groupBy("low", "depth").agg(
        F.max("high").alias("high"),
        F.min("least_id").alias("conv_id"),
        F.max("chars").alias("chars"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    linked, _ = write_table(
        crossing.repartition(1).sortWithinPartitions("low", "depth").mapInArrow(_linked(lcps), _LINKED),
        "linked",
    )
    ends = (
        edges.where("ends is not null")
        .select("low", "depth", "shard", "ends")
        .repartition("low", "depth")
        .sortWithinPartitions("low", "depth", "shard")
        .mapInArrow(_digests, "e_low long, e_depth long, ends_sha256 string")
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    across = linked.join(
        ends, (F.col("low") == F.col("e_low")) & (F.col("depth") == F.col("e_depth")), "left"
    ).select(*columns, F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))
    # The ids of parents that cross an edge, by the edge they touch.
    known = (
        edges.select("shard", "side", "depth", "low")
        .join(linked.select("low", "depth", "conv_id"), ["low", "depth"])
        .select(
            F.col("shard").alias("p_shard"),
            F.col("side").alias("p_side"),
            (F.col("depth") + 1).alias("p_depth"),
            F.col("conv_id").alias("p_conv_id"),
        )
    )
    own = kind("node")
    inside = (
        own.join(
            known,
            (F.col("shard") == F.col("p_shard"))
            & (F.col("parent_side") == F.col("p_side"))
            & (F.col("depth") == F.col("p_depth")),
            "left",
        )
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "p_conv_id"))
        .select(*columns, "ends_sha256")
    )
    return inside.unionByName(across)
