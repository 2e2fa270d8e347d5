"""Document quality by votes of the nearest labelled texts.

Texts become TF-IDF vectors over hashed byte trigrams and a few repetition terms (how
many of the words, and of the lines, are distinct). IDF covers all documents. A
truncated SVD of the labelled sample's vectors gives the latent-semantic space. The
labelled vectors, whose number and width are parameters, are broadcast; every document
gets its exact cosines to all of them, block by block as matrix products, and the
labels of its nearest ``neighbours`` are averaged by a power of their similarity.

The labelled sample holds at most about ``sample_per_label`` rows of each label, chosen
by a hash of the id; nothing else is bounded. The sample's ids go into a join, its
texts' vectors to the driver; never its texts.

Defined cases. A null or empty text, or one that shares no term with the sample, scores
zero. A document without an id, or with a null label, is never learned from. A document
with several labels counts with each. Without any labelled row every score is 0.5; with
one label only, that label. Repeated rows score alike. An empty table gives no rows.
Texts of any length are counted whole. Extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.features import (
    Grams,
    as_bytes,
    inverse_frequencies,
    term_counts,
    tfidf,
)
from tidemark.llm.rows import col, field, packed, text_of
from tidemark.workspace import may_broadcast

GRAMS = Grams(lengths=(3,), bits=11)
#: Labelled rows of each label that may vote, about; the bound of the sample.
SAMPLE_PER_LABEL = 2048
RANK = 32
NEIGHBOURS = 31
#: A neighbour's vote weighs its similarity to this power.
SHARPNESS = 8
#: Folds of the ids by CRC-32; the fold 0 is held out of learning.
FOLDS = 5
ACCEPTED = 0.3

_WORD_BUCKETS, _LINE_BUCKETS = 16, 8
#: How often a repetition term counts as found, so that it weighs against the n-grams.
_REPETITION_COUNT = 1000


def repetition_terms(texts: list[bytes]) -> np.ndarray:
    """One term for the share of distinct words, one for that of distinct lines."""
    found = np.zeros((len(texts), _WORD_BUCKETS + _LINE_BUCKETS), dtype=np.int64)
    for i, text in enumerate(texts):
        words, lines = text.split(), text.split(b"\n")
        if words:
            share = len(set(words)) / len(words)
            found[i, min(int(share * _WORD_BUCKETS), _WORD_BUCKETS - 1)] = _REPETITION_COUNT
        if len(lines) > 1:
            share = len(set(lines)) / len(lines)
            at = _WORD_BUCKETS + min(int(share * _LINE_BUCKETS), _LINE_BUCKETS - 1)
            found[i, at] = _REPETITION_COUNT
    return found


@dataclass
class Voters:
    """What a score needs: IDF, the latent space, the labelled vectors and labels."""

    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts))
        if not len(self.labels):
            return out + 0.5
        for start, counts in term_counts(texts, GRAMS, repetition_terms):
            latent = _unit(tfidf(counts, self.idf) @ self.space)
            near = latent @ self.vectors.T
            k = min(NEIGHBOURS, near.shape[1])
            top = np.argpartition(near, -k, axis=1)[:, -k:]
            weights = np.maximum(np.take_along_axis(near, top, 1), 0).astype(float) ** SHARPNESS
            total = weights.sum(axis=1)
            votes = (weights * self.labels[top]).sum(axis=1) / np.where(total > 0, total, 1)
            out[start : start + len(counts)] = votes
        out[[not t for t in texts]] = 0.0
        return np.clip(out, 0.0, 1.0)


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1)


def latent_space(rows: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors of ``rows``, by a seeded randomised range finder."""
    rank = min(rank, *rows.shape)
    start = np.random.default_rng(7).standard_normal((rows.shape[1], rank + 10))
    basis = start.astype(np.float32)
    for _ in range(5):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    _, _, right = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ right.T)[:, :rank].astype(np.float32)


def fold(ids: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(ids.cast("string").cast("binary")) % folds


def sampled(rows: DataFrame, ids: str, label: str, per_label: int) -> DataFrame:
    """About ``per_label`` ids of each label, or all it has, chosen by a hash of the id.

    Of rows that share id and label one is taken, so repeated rows cannot swell it.
    """
    shares = rows.groupBy(label).agg((F.lit(per_label) / F.count("*")).alias("_share"))
    side = F.broadcast(shares) if may_broadcast(shares.count(), 100) else shares
    draw = F.pmod(F.xxhash64(F.lit("sample"), ids), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = rows.join(side, label).where(draw < F.col("_share")).drop("_share")
    return drawn.dropDuplicates([ids, label])


def _learned(documents: DataFrame, labels: DataFrame, idf: np.ndarray, per_label: int) -> Voters:
    """``documents``: ``id, text``; ``labels``: ``id, label`` of 0 or 1."""
    rows = labels.where("label in (0, 1)").where(F.coalesce(fold(F.col("id"), FOLDS) != 0, F.lit(False)))
    chosen = sampled(rows, "id", "label", per_label)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("label").to_numpy()
            for start, counts in term_counts(as_bytes(batch.column("text")), GRAMS, repetition_terms):
                rows = tfidf(counts, idf).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found[start : start + len(rows)], pa.int32()),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                    ],
                    names=["label", "vector"],
                )

    # The sample has a bounded number of narrow rows.
    found = (
        documents.join(F.broadcast(chosen), "id")
        .dropDuplicates(["id", "label"])
        .select(F.col("label").cast("int").alias("label"), "text")
        .mapInArrow(vectors, "label int, vector binary")
        .toArrow()
        .sort_by([("label", "ascending"), ("vector", "ascending")])
    )
    width = len(idf)
    if not found.num_rows:
        return Voters(idf, np.zeros((width, 1), np.float32), np.zeros((0, 1)), np.zeros(0))
    rows = np.frombuffer(b"".join(found["vector"].to_pylist()), dtype=np.float16)
    rows = rows.reshape(-1, width).astype(np.float32)
    space = latent_space(rows, RANK)
    return Voters(idf, space, _unit(rows @ space), found["label"].to_numpy().astype(float))


def learn(
    documents: DataFrame,
    id_column: str,
    text_column: str,
    labels: DataFrame,
    label_id: str,
    label_column: str,
    sample_per_label: int = SAMPLE_PER_LABEL,
) -> Callable[[Column], Column]:
    """A column function that scores texts: 0 to 1, higher where label 1 is likelier."""
    plain = documents.select(
        col(id_column).alias("id"), text_of(col(text_column)).alias("text")
    )
    known = labels.select(col(label_id).alias("id"), col(label_column).alias("label"))
    idf = inverse_frequencies(plain, "text", GRAMS, repetition_terms)
    voters = documents.sparkSession.sparkContext.broadcast(
        _learned(plain, known, idf, sample_per_label)
    )

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(voters.value.scores(as_bytes(texts)), pa.float64())

    return lambda texts: score(text_of(texts))


def scored(documents: DataFrame, id_column: str, text_column: str, score) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    A document without an id counts as held out.
    """
    return documents.select(
        col(id_column).alias("doc_id"),
        F.coalesce(fold(col(id_column), FOLDS) == 0, F.lit(True)).alias("held_out"),
        score(col(text_column)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= ACCEPTED).cast("int"))


def accepted(documents: DataFrame, text_column: str, score) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    rows = packed(documents)
    return (
        rows.withColumn("score", score(field(text_column)))
        .where(F.col("score") >= ACCEPTED)
        .select("row.*")
    )
