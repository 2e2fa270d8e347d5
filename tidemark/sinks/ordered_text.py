"""Text output in order: files joined in the order of their manifest are sorted text.

A single task that prints in time order does not scale; plain parallel output has no
order. Here rows are range-partitioned by the order columns and sorted within their
range, so each file is a stretch of the whole and files follow each other. When a batch's
files are all there its manifest names them in order. A reader takes only files that
manifests name, manifests in the order of their batches: a batch that failed half-way is
not seen, one that runs again replaces its files, then its manifest.

On a stream whose windows close in time order, batches follow each other in time too.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions

_MANIFESTS = "_manifests"


def _files(spark: SparkSession, path: str):
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    return top, top.getFileSystem(spark._jsc.hadoopConfiguration())


def write_in_order(df: DataFrame, path: str, by: Sequence[str], batch_id: int = 0) -> None:
    """``value`` of each row as text, sorted by the columns ``by``."""
    spark = df.sparkSession
    folder = f"{path}/batch_id={batch_id}"
    (
        df.repartitionByRange(shuffle_partitions(spark), *by)
        .sortWithinPartitions(*by)
        .select("value")
        .write.mode("overwrite")
        .text(folder)
    )
    top, files = _files(spark, folder)
    # Part files are numbered by their range.
    names = sorted(
        s.getPath().getName() for s in files.listStatus(top)
        if s.getPath().getName().startswith("part-")
    )
    manifest, files = _files(spark, f"{path}/{_MANIFESTS}/{batch_id:019d}.json")
    out = files.create(manifest, True)
    try:
        out.write(bytearray(json.dumps([f"batch_id={batch_id}/{n}" for n in names]), "utf-8"))
    finally:
        out.close()


def ordered_text_batches(
    path: str, by: Sequence[str], transform: Callable[[DataFrame], DataFrame] = lambda batch: batch
):
    """Handler for ``foreachBatch``: each micro-batch's ``value`` in order."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_in_order(transform(batch), path, by, batch_id)

    return handle


def files_in_order(spark: SparkSession, path: str) -> list[str]:
    """The files of all complete batches, to be read one after the other."""
    top, files = _files(spark, f"{path}/{_MANIFESTS}")
    if not files.exists(top):
        return []
    rows = spark.read.text(f"{path}/{_MANIFESTS}/*.json").select(
        "value", F.col("_metadata.file_name").alias("name")
    )
    return [
        f"{path}/{file}"
        for row in sorted(rows.collect(), key=lambda r: r.name)
        for file in json.loads(row.value)
    ]


def lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    """``line_number`` (from 1) and ``line`` of all files joined in their order."""
    names = files_in_order(spark, path)
    if not names:
        return spark.createDataFrame([], "line_number long, line string")
    order = spark.createDataFrame(
        [(i, "/".join(n.split("/")[-2:])) for i, n in enumerate(names)], "file long, name string"
    )
    lines = spark.read.text(names).select(
        F.col("value").alias("line"),
        F.substring_index("_metadata.file_path", "/", -2).alias("line_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),  # rises within a block
    )
    # A path in a URI has "=" as it is or escaped.
    lines = lines.withColumn("line_name", F.replace("line_name", F.lit("%3D"), F.lit("=")))
    placed = lines.join(F.broadcast(order), F.col("line_name") == F.col("name"))
    counts = placed.groupBy("file").agg(F.count("*").alias("n"))
    # One row per file.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("file").alias("s_file"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("file").orderBy("block", "at")
    return placed.join(F.broadcast(starts), F.col("file") == F.col("s_file")).select(
        (F.col("start") + F.row_number().over(within)).cast("long").alias("line_number"), "line"
    )
