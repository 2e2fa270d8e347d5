"""Prefix sums over groups of any size, without a task that sees a whole group.

Rows of a group are spread over buckets by the leading bits of their order key, so that
a bucket holds some hundred rows. Sums within a bucket, over the buckets of a span of
buckets, and over spans then add up. Equal order keys fall into one bucket; they are
told apart by the tie columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bits of an order key, and of the part of it that buckets are cut from.
KEY_BITS, BUCKET_BITS = 60, 30
ROWS_PER_BUCKET = 256
BUCKETS_PER_SPAN = 2048


def before(
    rows: DataFrame, group: list[str], key: str, ties: list[str], value: str, size: str
) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over earlier rows of the group.

    ``key`` is a long of 60 random bits; ``size`` holds the number of rows of the group.
    """
    n = F.greatest(F.ceil(F.col(size) / ROWS_PER_BUCKET), F.lit(1)).cast("long")
    # Buckets are numbered in the order of the keys.
    bucket = F.shiftright(F.shiftright(key, KEY_BITS - BUCKET_BITS) * n, BUCKET_BITS)
    placed = rows.withColumn("bucket", bucket)
    totals = placed.groupBy(*group, "bucket").agg(F.sum(value).alias("total"))
    spanned = totals.withColumn("span", F.floor(F.col("bucket") / BUCKETS_PER_SPAN))
    sums = spanned.groupBy(*group, "span").agg(F.sum("total").alias("span_total"))
    span_starts = sums.select(
        *group, "span",
        F.coalesce(
            F.sum("span_total").over(
                Window.partitionBy(*group).orderBy("span")
                .rowsBetween(Window.unboundedPreceding, -1)
            ), F.lit(0)).alias("span_start"),
    )
    starts = (
        spanned.withColumn(
            "in_span",
            F.coalesce(F.sum("total").over(
                Window.partitionBy(*group, "span").orderBy("bucket")
                .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .join(span_starts, [*group, "span"])
        .select(*group, "bucket", (F.col("in_span") + F.col("span_start")).alias("start"))
    )
    within = (
        Window.partitionBy(*group, "bucket").orderBy(key, *ties)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.withColumn("within", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(starts, [*group, "bucket"])
        .withColumn("before", F.col("within") + F.col("start"))
        .drop("bucket", "within", "start")
    )
