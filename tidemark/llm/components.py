"""Connected components of a link table, by alternating star contractions.

Each round is two joins against a grouped minimum. Minima are taken per task before
they are shuffled. The table of minima is broadcast while its counted size is small;
beyond that it is written out, so that adaptive execution may split the join's other
side: a node with very many links costs no single task more than its share. Every
round is a table in the shared folder; only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import remove_folder, write_table

#: Minima up to this size are broadcast; a row takes about so much in memory.
_SMALL_BYTES, _ROW_BYTES = 16 << 20, 64


def _directed(pairs: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end."""
    return (
        pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a > b")
        .distinct()
    )


def _with_least(links: DataFrame, least: DataFrame, rows: int, paths: list[str]) -> DataFrame:
    if rows * _ROW_BYTES <= _SMALL_BYTES:
        side = F.broadcast(least)
    else:
        side, path = write_table(least, "minima")
        paths.append(path)
    return links.join(side, F.col("a") == F.col("c"))


def _large_star(links: DataFrame, rows: int, paths: list[str]) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("c"), F.least("a", "m").alias("m")
    )
    joined = _with_least(both, least, 2 * rows, paths)
    return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame, rows: int, paths: list[str]) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), "m")
    joined = _with_least(links, least, rows, paths)
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select(F.col("c").alias("a"), F.col("m").alias("b"))
    )


def _state(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)``: the smallest node reachable, for each linked node.

    ``pairs`` holds links in either direction; repeated links, links of a node to
    itself and links with a null end are of no effect. A node without links gets
    no row: it is its own component.
    """
    spark = pairs.sparkSession
    plain = pairs.select(F.col(a).alias("a"), F.col(b).alias("b"))
    links, path = write_table(_directed(plain), "links")
    state = _state(links)
    while True:
        gone = [path]
        rows = state[0]
        larger, middle = write_table(_directed(_large_star(links, rows, gone)), "links")
        gone.append(middle)
        # A contraction never adds links beyond twice their number.
        smaller, after = write_table(_directed(_small_star(larger, 2 * rows, gone)), "links")
        for folder in gone:
            remove_folder(spark, folder)
        links, path, before, state = smaller, after, state, _state(smaller)
        if state == before:
            break
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
