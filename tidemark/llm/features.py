"""Hashed TF-IDF vectors of byte n-grams, in blocks of texts.

A text's n-grams are counted into a fixed number of buckets (a power of two), so a
vector has the same length for any corpus. Counting is done on whole texts by numpy,
block by block; a very long text is counted in slices that overlap by n - 1 bytes, so
each n-gram counts once. Document frequencies are summed over all rows of a table:
each task gives back one count per bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import text_of

_BLOCK_TEXTS = 256
_BLOCK_BYTES = 1 << 20


@dataclass(frozen=True)
class Grams:
    """What is counted: n-gram lengths, buckets as a power of two, and the bytes' folding."""

    lengths: tuple[int, ...]
    bits: int
    fold: bytes = bytes(range(256))

    @property
    def buckets(self) -> int:
        return 1 << self.bits


def letters_folded() -> bytes:
    """A table for ``bytes.translate``: A-Z lowered, other ASCII but letters as a space."""
    table = bytearray(range(256))
    for code in range(128):
        kept = chr(code).lower() if chr(code).isalpha() else " "
        table[code] = ord(kept)
    return bytes(table)


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and (i - start == _BLOCK_TEXTS or size + len(text) > _BLOCK_BYTES):
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def _count_into(counts: np.ndarray, texts: list[bytes], n: int, grams: Grams) -> None:
    data = np.frombuffer(b"".join(texts).translate(grams.fold), dtype=np.uint8)
    if len(data) < n:
        return
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    last = len(data) - n + 1
    code = data[:last].astype(np.uint32)
    for i in range(1, n):
        code = (code << np.uint32(8)) | data[i : last + i]
    code = (code + np.uint32(n)) * np.uint32(2654435761) >> np.uint32(32 - grams.bits)
    within = owner[:last] == owner[n - 1 :]
    at = (owner[:last] * grams.buckets + code)[within]
    counts += np.bincount(at, minlength=counts.size).reshape(counts.shape)


def counted(texts: list[bytes], grams: Grams) -> Iterator[tuple[int, np.ndarray]]:
    """``(first text, counts)`` block by block; one row of counts per text."""
    for start, block in _blocks(texts):
        counts = np.zeros((len(block), grams.buckets), dtype=np.int64)
        for n in grams.lengths:
            if len(block) == 1 and len(block[0]) > _BLOCK_BYTES:
                text = block[0]
                for at in range(0, len(text) - n + 1, _BLOCK_BYTES):
                    _count_into(counts, [text[at : at + _BLOCK_BYTES + n - 1]], n, grams)
            else:
                _count_into(counts, block, n, grams)
        yield start, counts


Extra = Callable[[list[bytes]], np.ndarray]


def term_counts(
    texts: list[bytes], grams: Grams, extra: Extra | None = None
) -> Iterator[tuple[int, np.ndarray]]:
    """As :func:`counted`, with the columns that ``extra`` makes of the texts added."""
    for start, counts in counted(texts, grams):
        if extra is not None:
            counts = np.hstack([counts, extra(texts[start : start + len(counts)])])
        yield start, counts


def tfidf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of unit length, or zero where nothing was counted."""
    weights = np.log1p(counts).astype(np.float32) * idf
    norms = np.linalg.norm(weights, axis=1, keepdims=True)
    return weights / np.where(norms > 0, norms, 1)


def as_bytes(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.binary()).to_pylist()


def inverse_frequencies(
    texts: DataFrame, column: str, grams: Grams, extra: Extra | None = None
) -> np.ndarray:
    """Smoothed IDF of every bucket over all rows of ``texts``; nulls count as empty.

    The driver gets one number per bucket and the number of rows.
    """
    width = grams.buckets + (extra([b""]).shape[1] if extra is not None else 0)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(width, dtype=np.int64), 0
        for batch in batches:
            for _, counts in term_counts(as_bytes(batch.column(0)), grams, extra):
                total += (counts > 0).sum(axis=0)
                rows += len(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width + 1)), pa.array(np.append(total, rows))],
            names=["bucket", "n"],
        )

    found = (
        texts.select(text_of(F.col(column)))
        .mapInArrow(frequencies, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros(width + 1)
    for row in found:
        counts[row.bucket] = row.n
    return (np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1).astype(np.float32)
