"""Labelled text outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled(df: DataFrame, label: str, text: str = "report") -> DataFrame:
    """One line of text per row, ``label> text``."""
    return df.select(F.concat(F.lit(label + "> "), F.col(text)).alias("value"))


def record_text(df: DataFrame, name: str, fields: dict[str, str]) -> DataFrame:
    """Rows as ``Name(field=value, ...)``; ``fields`` maps printed names to columns."""
    parts = [
        F.concat(F.lit(f"{field}="), F.coalesce(F.col(c).cast("string"), F.lit("null")))
        for field, c in fields.items()
    ]
    return df.select(
        F.concat(F.lit(f"{name}("), F.concat_ws(", ", *parts), F.lit(")")).alias("report")
    )


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``value`` as text files, in parallel."""
    df.select("value").write.mode(mode).text(path)


def text_batches(path: str, transform=None):
    """Handler for ``foreachBatch``: every micro-batch's ``value`` as text files.

    A batch's folder is overwritten when the batch runs again. Nothing is left out.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch if transform is None else transform(batch)
        write_text(rows, f"{path}/batch_id={batch_id}")

    return handle
