"""SimHash near-duplicates by deletion-variant signatures.

A text in lower case (A-Z only) is cut into words at ``[\\x20\\x09-\\x0D]+`` and into
shingles of consecutive words, repeats included. Bit *i* of its 64-bit fingerprint is
set where bit *i* of XXH64 (seed 42) is set in more than half of the shingles.

Fingerprints link at ``max_bits`` or fewer differing bits. They are cut into the fewest
segments that leave one with at most one differing bit (three for four bits). Each
segment is indexed once for every bit of it, that bit left out: two segments that
differ in one bit share the variant without it. Rows of equal variants meet, and
every pair of them is verified on all 64 bits. A task gives back links that span its
linked fingerprints, not all pairs of them, so near-copies by the thousand stay linear
in number. A variant with more fingerprints than a block holds is dealt out as pairs
of blocks, each a group of its own; no pair is left out.

Only distinct fingerprints take part: copies need no link among each other.

Defined cases. Fewer words than a shingle: the whole sequence is the one shingle. No
words, an empty or a null text: fingerprint zero, which links like any other. Texts of
any length are hashed whole. A null id ranks last. Rows that share an id are rows of
their own. An empty table gives no rows. Extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import WITHIN, dealt, runs, whole_parts
from tidemark.llm.components import components
from tidemark.llm.rows import col, field, packed, text_of
from tidemark.session import shuffle_partitions
from tidemark.workspace import write_table

SHINGLE_WORDS = 4
MAX_BITS = 4
#: Fingerprints of one variant that are compared within one group.
BLOCK = 2048

_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle_words + 1)
    last = ends[-1:] if len(words) < shingle_words else ends[shingle_words - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), last.tolist())]
    by_byte = np.array(hashes, dtype="<u8").view(np.uint8).reshape(n, 8)
    ones = [np.bincount(by_byte[:, i], minlength=256) @ _BITS_OF_BYTE for i in range(8)]
    bits = (np.concatenate(ones) * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprint_column(shingle_words: int):
    @F.arrow_udf("long")
    def of_texts(texts: pa.Array) -> pa.Array:
        found = [fingerprint(t, shingle_words) for t in texts.cast(pa.binary()).to_pylist()]
        return pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return of_texts


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """``(lowest bit, bits)`` of the fewest segments with one that differs in at most one bit."""
    n = max_bits // 2 + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def _variants(prints: DataFrame, max_bits: int) -> DataFrame:
    """``(variant, fp)``: a variant is one segment with one of its bits left out.

    The key holds the segment's other bits where they stand in the fingerprint; six
    of the bits that are free outside the segment tell which bit was left out.
    """
    keys = []
    for low, bits in _segments(max_bits):
        segment = ((1 << bits) - 1) << low
        free = 0 if low >= 6 else 58  # six bits outside the segment
        for bit in range(low, low + bits):
            kept = segment & ~(1 << bit)
            kept = kept - (1 << 64) if kept >> 63 else kept
            tag = bit << free
            tag = tag - (1 << 64) if tag >> 63 else tag
            keys.append(F.col("fp").bitwiseAND(F.lit(kept)).bitwiseOR(F.lit(tag)))
    return prints.select("fp", F.explode(F.array(*keys)).alias("variant"))


def _links_of_runs(starts: np.ndarray, fp: np.ndarray, side: np.ndarray, max_bits: int):
    """Spanning links of each part; ``starts`` ends with the number of rows."""
    sizes = np.diff(starts)
    first = starts[:-1]
    small = (sizes > 1) & (sizes <= 16) & (side[first] == WITHIN)
    # All pairs of the small parts at once, by their places in the part.
    at, count = first[small], sizes[small]
    for a in range(int(count.max(initial=0)) - 1):
        for b in range(a + 1, int(count.max())):
            fits = at[count > b]
            x, y = fp[fits + a], fp[fits + b]
            near = np.bitwise_count(x ^ y) <= max_bits
            if near.any():
                yield x[near], y[near]
    for run in np.flatnonzero((sizes > 1) & ~small):
        span = slice(starts[run], starts[run + 1])
        yield from _spanning(fp[span], side[span], max_bits)


def _spanning(fp: np.ndarray, side: np.ndarray, max_bits: int) -> Iterator[tuple]:
    """Links that connect whatever the verified pairs of a part connect."""
    within = side[0] == WITHIN
    unseen = np.ones(len(fp), dtype=bool)
    for root in range(len(fp)):
        if not unseen[root]:
            continue
        unseen[root] = False
        frontier = [root]
        while frontier:
            at = frontier.pop()
            near = np.flatnonzero(unseen if within else unseen & (side != side[at]))
            near = near[np.bitwise_count(fp[near] ^ fp[at]) <= max_bits]
            if len(near):
                unseen[near] = False
                frontier.extend(near.tolist())
                yield np.repeat(fp[at], len(near)), fp[near]


def linked(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: links that connect all fingerprints ``fp`` at ``max_bits`` or fewer bits."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_parts(batches, "variant"):
            fp, side = table["fp"].to_numpy().view(np.uint64), table["side"].to_numpy()
            for a, b in _links_of_runs(runs(table, "variant"), fp, side, max_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
                )

    # Few files hold the fingerprints; their variants are made by all tasks, once.
    spread = prints.repartition(shuffle_partitions(prints.sparkSession))
    variants, _ = write_table(_variants(spread, max_bits), "variants")
    return dealt(variants, "variant", "fp", block).mapInArrow(links, "a long, b long")


def _classes(prints: DataFrame, ids: str, max_bits: int) -> DataFrame:
    """``(class_fp, component_id)`` for the distinct fingerprints of ``prints``."""
    least = prints.groupBy("fp").agg(F.min(ids).alias("least"))
    distinct, _ = write_table(least, "fingerprints")
    links, _ = write_table(linked(distinct.select("fp"), max_bits), "links")
    # A node is named so that the least of a component is the answer.
    node = F.struct(F.col("least").isNull().alias("no_id"), "least", "fp")
    ends = distinct.select("fp", node.alias("node"))
    named = links.join(ends.toDF("a", "x"), "a").join(ends.toDF("b", "y"), "b")
    parts = components(named, "x", "y").select(
        F.col("node.fp").alias("p_fp"), F.col("component.least").alias("p_least")
    )
    named = distinct.join(parts, F.col("fp") == F.col("p_fp"), "left").select(
        F.col("fp").alias("class_fp"),
        F.when(F.col("p_fp").isNull(), F.col("least")).otherwise(F.col("p_least")).alias("component_id"),
    )
    # Written: rows then meet their class in a join of two plain shuffles, in which a
    # fingerprint that very many rows share is split.
    return write_table(named, "classes")[0]


def near_duplicates(
    df: DataFrame,
    id_column: str,
    text_column: str,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, fingerprint, component_id``.

    ``component_id`` is the smallest id in the row's component.
    """
    prints, _ = write_table(
        df.select(
            col(id_column).alias("doc_id"),
            _fingerprint_column(shingle_words)(text_of(col(text_column))).alias("fp"),
        ),
        "fingerprints",
    )
    classes = _classes(prints, "doc_id", max_bits)
    return prints.join(classes, F.col("fp") == F.col("class_fp")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def first_of_groups(
    df: DataFrame,
    id_column: str,
    text_column: str,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row of ``df`` per component, all columns kept: that with the smallest id.

    Of rows that share the smallest id and a component, the one with the smallest
    hash over all columns stays, and one of those where rows are repeated.
    """
    rows = packed(df)
    plain = "map<" not in rows.schema.simpleString()
    whole = F.xxhash64(F.col("row") if plain else F.to_json("row"))
    prints, _ = write_table(
        rows.select(
            F.struct(
                field(id_column).isNull().alias("no_id"),
                field(id_column).alias("id"),
                whole.alias("hash"),
            ).alias("key"),
            _fingerprint_column(shingle_words)(text_of(field(text_column))).alias("fp"),
        ),
        "fingerprints",
    )
    classes = _classes(prints, "key", max_bits)
    keys = classes.select(F.col("component_id").alias("key")).distinct()
    named = rows.withColumn("id", field(id_column)).withColumn("hash", whole)
    kept = named.join(
        keys,
        F.col("id").eqNullSafe(F.col("key.id")) & (F.col("hash") == F.col("key.hash")),
    )
    return kept.select("row", "key").groupBy("key").agg(F.first("row").alias("row")).select("row.*")
