"""Small helpers of the operators: whole rows as one column, text columns, word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words everywhere in this package.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """A column by its name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame) -> DataFrame:
    """Every row as one struct ``row``: added columns then cannot clash with its own."""
    return df.select(F.struct(*[col(c) for c in df.columns]).alias("row"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def field(name: str) -> Column:
    """A column inside ``row``."""
    return F.col("row").getField(name)


def text_of(column: Column) -> Column:
    """The text; a null counts as empty."""
    return F.coalesce(column.cast("string"), F.lit(""))


def word_count(column: Column) -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")
