"""Text-line sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(
    spark: SparkSession, path: str, *, streaming: bool = False, **options
) -> DataFrame:
    """One row per line in column ``value``; ``options`` go to the reader."""
    reader = spark.readStream if streaming else spark.read
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.text(path)
