"""Readable report blocks, one row per window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clock import ms_text

# Rulers and labels of the three report formats.
ITEM_RULER = "==============="
URL_OPENING_RULER = "================"
URL_CLOSING_RULER = "==============="
PV_RULER = "=================="
ITEM_LABEL = "  商品ID:"
URL_LABEL = "  UTL:"
VIEWS_LABEL = "  浏览量:"
PV_LABEL = "PV次数:"


def _block(
    ranked: DataFrame, key: str, label: str, opening: str, closing: str, *more: str
) -> DataFrame:
    # ``ranked`` holds at most N rows per window, so the list is bounded by N.
    entry: Column = F.concat(
        F.lit("No "),
        F.col("rk").cast("string"),
        F.lit(":" + label),
        F.col(key).cast("string"),
        F.lit(VIEWS_LABEL),
        F.col("count").cast("string"),
        F.lit("\n"),
    )
    lines = F.sort_array(F.collect_list(F.struct(F.col("rk"), entry.alias("line"))))
    return ranked.groupBy("window_end", *more).agg(lines.alias("lines")).select(
        "window_end",
        *more,
        F.concat(
            F.lit(opening + "\n"),
            ms_text(F.col("window_end")),
            F.lit("\n"),
            F.array_join(F.col("lines.line"), ""),
            F.lit(closing + "\n\n"),
        ).alias("report"),
    )


def item_report(ranked: DataFrame) -> DataFrame:
    return _block(ranked, "item_id", ITEM_LABEL, ITEM_RULER, ITEM_RULER)


def url_report(ranked: DataFrame, *more: str) -> DataFrame:
    """``more`` columns tell several rankings of a window apart."""
    return _block(ranked, "url", URL_LABEL, URL_OPENING_RULER, URL_CLOSING_RULER, *more)


def pv_report(totals: DataFrame) -> DataFrame:
    return totals.select(
        "window_end",
        F.concat(
            F.lit(PV_RULER + "\n"),
            ms_text(F.col("window_end")),
            F.lit(":\n" + PV_LABEL),
            F.col("count").cast("string"),
        ).alias("report"),
    )
