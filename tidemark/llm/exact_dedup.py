"""Exact deduplication of texts by Patricia tries.

Texts are equal when identical after each run of white space ``[\\x20\\x09-\\x0D]``
became one space. Rows are dealt out by length and content hash of that text. Each
task inserts the full byte strings into a compressed radix trie whose terminal
nodes keep the row with the smallest id and the number of rows. Before the shuffle
each task runs the same tries over its own input, so a text with millions of copies
leaves a task once. A trie beyond its budget spills its heaviest subtree to a scratch
file of the task and goes through that file afterwards with a trie of its own.

Defined cases. A null text counts as empty; texts of white space alone equal one
space, which differs from the empty text. A null id ranks last. Rows that share the
smallest id and the text are ordered by raw text, then by all columns; one of them
stays. Texts of any length are compared whole. An empty table gives no rows. Extra
columns may have any name.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.rows import col, packed, text_of

#: Bytes of rows and labels that a task's trie may hold before it gives some up.
TRIE_BYTES = 96 << 20
#: What a node takes beside its label, roughly.
NODE_BYTES = 200


def normalise(text: bytes) -> bytes:
    """``text`` with every run of white space as one space."""
    words = text.split()
    if not words:
        return b" " if text else b""
    return (b" " * text[:1].isspace()) + b" ".join(words) + (b" " * text[-1:].isspace())


class _Node:
    __slots__ = ("label", "children", "owner", "spill")

    def __init__(self, label: bytes, children: dict):
        self.label, self.children = label, children
        self.owner: list | None = None
        self.spill: _Spill | None = None


class _Spill:
    """Rows of a spilled subtree, in a scratch file of the task."""

    def __init__(self, path: str, schema: pa.Schema):
        self._path = path
        self._writer = pa.ipc.new_stream(path, schema)

    def add(self, rows: pa.RecordBatch) -> None:
        self._writer.write_batch(rows)

    def rows(self) -> Iterator[pa.RecordBatch]:
        self._writer.close()
        with pa.ipc.open_stream(self._path) as found:
            yield from found


class PatriciaTrie:
    """Byte strings with an owner each: its rank, the rows seen, the lowest-ranked row."""

    def __init__(self) -> None:
        self.root = _Node(b"", {})
        self.bytes = 0

    def find(self, key: bytes) -> _Node:
        """The node for ``key``, made where needed, or the spilled node on its way."""
        node, at = self.root, 0
        while at < len(key) and node.spill is None:
            child = node.children.get(key[at])
            if child is None:
                child = _Node(key[at:], {})
                node.children[key[at]] = child
                self.bytes += len(child.label) + NODE_BYTES
            elif not key.startswith(child.label, at):
                child = node.children[key[at]] = self._split(child, key[at : at + len(child.label)])
            node, at = child, at + len(child.label)
        return node

    def _split(self, child: _Node, rest: bytes) -> _Node:
        """A node above ``child`` for the bytes its label shares with ``rest``."""
        low, high = 1, len(rest)
        while low < high:
            middle = (low + high + 1) // 2
            if rest[:middle] == child.label[:middle]:
                low = middle
            else:
                high = middle - 1
        upper = _Node(child.label[:low], {child.label[low]: child})
        child.label = child.label[low:]
        self.bytes += NODE_BYTES
        return upper

    def claim(self, node: _Node, key, text: bytes, count: int, batch: pa.RecordBatch, i: int):
        """Count a row at its terminal node, which keeps it if it ranks lowest."""
        rank = (key is None, 0 if key is None else key, text)
        if node.owner is None:
            row = batch.take([i])
            node.owner = [rank, count, row]
            self.bytes += row.nbytes
            return
        node.owner[1] += count
        if rank < node.owner[0] or (
            rank == node.owner[0]
            and _written(batch.slice(i, 1)) < _written(node.owner[2])
        ):
            row = batch.take([i])
            self.bytes += row.nbytes - node.owner[2].nbytes
            node.owner[0], node.owner[2] = rank, row

    def nodes(self, top: _Node | None = None) -> Iterator[_Node]:
        pending = [top or self.root]
        while pending:
            node = pending.pop()
            yield node
            pending.extend(node.children.values())

    def rows(self, top: _Node | None = None) -> Iterator[pa.RecordBatch]:
        """The owners' rows with their counts, some thousand to a batch."""
        owners = (node.owner for node in self.nodes(top) if node.owner is not None)
        while some := list(islice(owners, 2000)):
            table = pa.Table.from_batches([row for _, _, row in some])
            at = table.schema.get_field_index("_count")
            counts = pa.array([count for _, count, _ in some], pa.int64())
            yield from table.set_column(at, table.schema.field(at), counts).to_batches()

    def spill(self, most: int, scratch: str) -> None:
        """Move heaviest subtrees to files until at most ``most`` bytes are left."""
        while self.bytes > most and (node := self._heaviest()) is not None:
            found = next(x.owner[2] for x in self.nodes(node) if x.owner is not None)
            spill = _Spill(f"{scratch}/{len(os.listdir(scratch))}", found.schema)
            for rows in self.rows(node):
                spill.add(rows)
            for gone in self.nodes(node):
                if gone.owner is not None:
                    self.bytes -= gone.owner[2].nbytes
                if gone is not node:
                    self.bytes -= len(gone.label) + NODE_BYTES
                if gone.spill is not None:
                    for rows in gone.spill.rows():
                        spill.add(rows)
            node.children, node.owner, node.spill = {}, None, spill

    def _heaviest(self) -> _Node | None:
        """The largest subtree with at most half the bytes, or the one heavy text; none
        where a single text is left."""
        order = list(self.nodes())
        weights: dict[int, int] = {}
        owners = 0
        for node in reversed(order):
            own = 0
            if node.owner is not None:
                owners += 1
                own = node.owner[2].nbytes + len(node.label)
            weights[id(node)] = own + sum(weights[id(c)] for c in node.children.values())
        if owners < 2:
            return None
        node = self.root
        while node is self.root or weights[id(node)] * 2 > weights[id(self.root)]:
            below = [c for c in node.children.values() if weights[id(c)]]
            if not below:
                break
            node = max(below, key=lambda c: weights[id(c)])
        return None if node is self.root else node


def _written(row: pa.RecordBatch) -> str:
    return repr(row.to_pylist())


def owners_of(
    batches: Iterator[pa.RecordBatch], budget: int, give_up: bool
) -> Iterator[pa.RecordBatch]:
    """Of equal texts the owner's row, with the number of rows.

    Beyond ``budget`` bytes the trie either gives all its owners up and begins anew
    (``give_up``, before a shuffle: copies meet again behind it), or spills subtrees.
    """
    trie = PatriciaTrie()
    with tempfile.TemporaryDirectory(prefix="trie-") as scratch:
        for batch in batches:
            ids = batch.column("_id").to_pylist()
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            counts = batch.column("_count").to_pylist()
            for i, (key, text, count) in enumerate(zip(ids, texts, counts)):
                node = trie.find(normalise(text))
                if node.spill is not None:
                    node.spill.add(batch.slice(i, 1))
                else:
                    trie.claim(node, key, text, count, batch, i)
            if trie.bytes > budget and give_up:
                yield from trie.rows()
                trie = PatriciaTrie()
            elif trie.bytes > budget:
                trie.spill(budget // 2, scratch)
        yield from trie.rows()
        spills = [node.spill for node in trie.nodes() if node.spill is not None]
        del trie
        for spill in spills:
            yield from owners_of(spill.rows(), budget, False)


def _partition_keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Length and content hash of each row's normalised text."""
    texts = [normalise(t) for t in batch.column("_text").cast(pa.binary()).to_pylist()]
    n = pa.array([len(t) for t in texts], pa.int64())
    h = pa.array([xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in texts], pa.int64())
    return batch.append_column("_n", n).append_column("_h", h)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [normalise(t) for t in batch.column("_text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.drop_columns(["_text"]).columns,
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            ],
            names=["_id", "n_bytes", "text_sha256"],
        )


def _owners(rows: DataFrame, budget: int) -> DataFrame:
    """Owners among rows ``_id``, ``_text`` and whatever else they carry."""
    counted = rows.withColumn("_count", F.lit(1).cast("long"))
    keyed = T.StructType([*counted.schema.fields]).add("_n", "long").add("_h", "long")

    def before(batches):
        return map(_partition_keys, owners_of(batches, budget, give_up=True))

    def after(batches):
        return owners_of(batches, budget, give_up=False)

    return (
        counted.mapInArrow(before, keyed)
        .repartition("_n", "_h")
        .drop("_n", "_h")
        .mapInArrow(after, counted.schema)
    )


def membership(
    df: DataFrame, id_column: str, text_column: str, budget: int = TRIE_BYTES
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Each row is matched to its owner by length and SHA-256 of the normalised text, in
    a join of narrow rows that adaptive execution may split. Of rows that share the
    smallest id, ``kept`` is true for each; :func:`first_copies` keeps one.
    """
    rows = df.select(col(id_column).alias("_id"), text_of(col(text_column)).alias("_text"))
    narrow = T.StructType([rows.schema["_id"]]).add("n_bytes", "long").add("text_sha256", "string")
    owners = (
        _owners(rows, budget)
        .select("_id", "_text", "_count")
        .mapInArrow(_owner_digests, T.StructType([*narrow.fields]).add("group_size", "long"))
        .withColumnRenamed("_id", "keep_id")
    )
    return (
        rows.mapInArrow(_digests, narrow)
        .join(owners, ["n_bytes", "text_sha256"])
        .select(
            F.col("_id").alias("doc_id"),
            "keep_id",
            "group_size",
            F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
            "n_bytes",
        )
    )


def _owner_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        plain = next(_digests(iter([batch.select(["_id", "_text"])])))
        yield plain.append_column("group_size", batch.column("_count"))


def first_copies(
    df: DataFrame, id_column: str, text_column: str, budget: int = TRIE_BYTES
) -> DataFrame:
    """The rows of ``df`` that own their text, with all their columns."""
    own = packed(df).select(
        F.col("row").getField(id_column).alias("_id"),
        text_of(F.col("row").getField(text_column)).alias("_text"),
        "row",
    )
    return _owners(own, budget).select("row.*")
