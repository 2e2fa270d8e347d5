"""From raw documents to packed training sequences.

Quality filter, exact deduplication, SimHash near-deduplication, mixing of the sources
and packing, each stage a table in the shared folder that the next one reads.

What a stage does with odd rows is what its operator does. In short: a null or empty
text, or one without a known term, has quality zero and goes in the first stage. Null
texts count as empty, equal texts keep the row with the smallest id (rows without an id
last), also where rows are repeated. Texts of any length are taken whole. A null source
is a source of its own, and rows without an id are drawn and packed like others. All
stages but the last return the columns of their input, whatever they are called. An
empty table gives an empty table at every stage, and no sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, mixing, packing, quality, simhash
from tidemark.workspace import write_table

#: Small sources are raised until one is repeated so often; the corpus keeps its size.
MIX = mixing.Target(max_repeats=1.25, budget=1.0)

#: Votes of labelled neighbours, random shards and packing have no SQL form.
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = quality.learn(docs, "doc_id", "text", labels, "doc_id", "quality")
    return quality.accepted(docs, "text", score)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.first_copies(docs, "doc_id", "text")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_groups(docs, "doc_id", "text")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.drawn_rows(docs, "doc_id", "text", "source", MIX)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_bins(docs, "doc_id", "text", "source")


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing sources", mixed_sources),
    ("best-fit packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
