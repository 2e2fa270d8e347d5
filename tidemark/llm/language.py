"""Language identification by nearest centroids.

Texts become normalised TF-IDF vectors over hashed byte 1- to 3-grams; ASCII letters are
lowered and other ASCII characters count as a space. Each language gets several
centroids, clustered by cosine from a bounded sample of its documents (``per_language``,
chosen by a hash of the id). IDF covers all documents that may be learned from. A text
takes the language of the centroid with the highest cosine; the cosine is its score. A
text farther from its centroid than nearly all of the texts learned there is marked as
``rejected``.

Learned from are only documents with a language whose CRC-32 of the id as text is not 1
modulo 3.

Defined cases. A null text, or one without a letter, is ``und`` with score 0. So is every
text where nothing could be learned. A document without an id or a language is never
learned from. Equal cosines: the language that sorts first. Repeated rows get equal
answers. An empty table gives no rows. Texts of any length are counted whole. Extra
columns may have any name.
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
    letters_folded,
    term_counts,
    tfidf,
)
from tidemark.llm.quality import fold, sampled
from tidemark.llm.rows import col, text_of

GRAMS = Grams(lengths=(1, 2, 3), bits=12, fold=letters_folded())
#: Documents of each language that centroids are clustered from, about.
PER_LANGUAGE = 512
CENTROIDS = 4
#: Share of a centroid's own texts that its distance bound may leave out.
REJECTED_SHARE = 0.002
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"


@dataclass
class Centroids:
    """Unit centroids, the language of each, and the lowest cosine it accepts."""

    idf: np.ndarray
    rows: np.ndarray
    languages: list[str]
    least: np.ndarray

    def nearest(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        at, cosine = np.zeros(len(texts), dtype=int), np.zeros(len(texts))
        for start, counts in term_counts(texts, GRAMS):
            near = tfidf(counts, self.idf) @ self.rows.T
            best = near.argmax(axis=1)
            at[start : start + len(best)] = best
            cosine[start : start + len(best)] = near[np.arange(len(best)), best]
        return at, np.clip(cosine, 0.0, 1.0)


def clustered(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means: unit centroids, begun from rows far from each other."""
    picked = [0]
    while len(picked) < min(k, len(rows)):
        nearest = (rows @ rows[picked].T).max(axis=1)
        picked.append(int(nearest.argmin()))
    centres = rows[picked]
    for _ in range(rounds):
        owner = (rows @ centres.T).argmax(axis=1)
        sums = np.vstack([rows[owner == i].sum(axis=0) for i in range(len(centres))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
    return centres


def _centroids_of(table: pa.Table) -> pa.Table:
    """The centroids of one language's sample: ``lang, number, vector, least``."""
    table = table.sort_by("vector")
    rows = np.frombuffer(b"".join(table["vector"].to_pylist()), dtype=np.float16)
    rows = rows.reshape(-1, GRAMS.buckets).astype(np.float32)
    rows = rows[np.linalg.norm(rows, axis=1) > 0]
    centres, least = np.zeros((0, GRAMS.buckets), np.float32), []
    if len(rows):
        centres = clustered(rows, CENTROIDS)
        cosines = rows @ centres.T
        for i in range(len(centres)):
            mine = cosines[cosines.argmax(axis=1) == i, i]
            least.append(float(np.quantile(mine, REJECTED_SHARE)) if len(mine) else 1.0)
    n = len(centres)
    return pa.table(
        {
            "lang": pa.array([table["lang"][0].as_py()] * n, pa.string()),
            "number": pa.array(range(n), pa.int32()),
            "vector": pa.array([c.astype(np.float32).tobytes() for c in centres], pa.binary()),
            "least": pa.array(least, pa.float64()),
        }
    )


def _learned(known: DataFrame, idf: np.ndarray, per_language: int) -> Centroids:
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("lang").to_pylist()
            for start, counts in term_counts(as_bytes(batch.column("text")), GRAMS):
                rows = tfidf(counts, idf).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found[start : start + len(rows)], pa.string()),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                    ],
                    names=["lang", "vector"],
                )

    # A group is one language's sample, bounded by ``per_language``; the driver gets the
    # model, a few vectors for each language.
    sample = sampled(known.where("lang is not null"), "id", "lang", per_language)
    found = (
        sample.select("lang", "text")
        .mapInArrow(vectors, "lang string, vector binary")
        .groupBy("lang")
        .applyInArrow(_centroids_of, "lang string, number int, vector binary, least double")
        .toArrow()
        .sort_by([("lang", "ascending"), ("number", "ascending")])
    )
    rows = np.frombuffer(b"".join(found["vector"].to_pylist()), dtype=np.float32)
    return Centroids(
        idf, rows.reshape(-1, GRAMS.buckets), found["lang"].to_pylist(), found["least"].to_numpy()
    )


def learn(
    documents: DataFrame,
    id_column: str,
    text_column: str,
    lang_column: str,
    per_language: int = PER_LANGUAGE,
) -> Callable[[Column], Column]:
    """A column function ``text -> (lang, score, rejected)``."""
    known = documents.select(
        col(id_column).alias("id"),
        text_of(col(text_column)).alias("text"),
        col(lang_column).cast("string").alias("lang"),
    ).where(F.coalesce(fold(F.col("id"), FOLDS) != HELD_OUT, F.lit(False)))
    idf = inverse_frequencies(known, "text", GRAMS)
    centroids = documents.sparkSession.sparkContext.broadcast(
        _learned(known, idf, per_language)
    )

    @F.arrow_udf("lang string, score double, rejected boolean")
    def identified(texts: pa.Array) -> pa.Array:
        model = centroids.value
        if not model.languages:
            n = len(texts)
            columns = [pa.array([UNKNOWN] * n), pa.array(np.zeros(n)), pa.array([True] * n)]
        else:
            at, cosine = model.nearest(as_bytes(texts))
            columns = [
                pa.array([model.languages[i] for i in at], pa.string()),
                pa.array(cosine, pa.float64()),
                pa.array(cosine < model.least[at]),
            ]
        return pa.StructArray.from_arrays(columns, names=["lang", "score", "rejected"])

    return lambda texts: identified(text_of(texts))


def predicted(documents: DataFrame, id_column: str, text_column: str, identify) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, rejected``.

    A document without an id counts as held out.
    """
    found = documents.select(
        col(id_column).alias("doc_id"),
        F.coalesce(fold(col(id_column), FOLDS) == HELD_OUT, F.lit(True)).alias("held_out"),
        text_of(col(text_column)).rlike(r"\p{L}").alias("lettered"),
        identify(col(text_column)).alias("found"),
    )
    return found.select(
        "doc_id",
        "held_out",
        F.when(F.col("lettered"), F.col("found.lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("lettered"), F.col("found.score")).otherwise(0.0).alias("score"),
        F.when(F.col("lettered"), F.col("found.rejected")).otherwise(True).alias("rejected"),
    )
