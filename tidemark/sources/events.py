"""The ``events`` table seen as behavior records and as an access log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import pin_utc

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_events(
    spark: SparkSession, sf_dir: str, *, streaming: bool = False, **options
) -> DataFrame:
    """``events`` with ``ts`` as TIMESTAMP (UTC); ``options`` go to the reader.

    On a stream ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound a micro-batch.
    """
    pin_utc(spark)
    reader = (spark.readStream if streaming else spark.read).schema(EVENTS).options(**options)
    # A pattern, because a stream takes a plain path for a folder.
    events = reader.parquet(f"{sf_dir}/events.parque{'[t]' if streaming else 't'}")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


# Event types that become page views and GET requests.
VIEW_TYPES = ("view", "pv")
GET_TYPES = ("view", "click")


def of_types(events: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """Only events of ``types``, as a predicate the file scan takes.

    The filters on the derived behavior and method columns keep the same rows but
    are conditional expressions by then. For batch jobs that need no other rows.
    """
    return events.where(F.col("event_type").isin(*types))


def _item() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def as_behavior(events: DataFrame, *extra: str) -> DataFrame:
    """Behavior records; event type ``view`` counts as ``pv``."""
    return events.select(
        "user_id",
        _item().alias("item_id"),
        F.pmod(_item(), F.lit(10)).cast("int").alias("category_id"),
        F.when(F.col("event_type") == "view", "pv")
        .otherwise(F.col("event_type"))
        .alias("behavior"),
        F.unix_seconds("ts").alias("timestamp"),
        *extra,
    )


def as_access_log(events: DataFrame, *extra: str) -> DataFrame:
    """Access-log records with whole-second times."""
    return events.select(
        F.concat(F.lit("10.0.0."), F.pmod("user_id", F.lit(256)).cast("string")).alias("ip"),
        F.col("user_id").cast("string").alias("user_id"),
        (F.unix_seconds("ts") * 1000).alias("event_time"),
        F.when(F.col("event_type").isin("view", "click"), "GET")
        .when(F.col("event_type").isin("purchase", "signup"), "POST")
        .otherwise("HEAD")
        .alias("method"),
        F.concat(F.lit("/p/"), _item().cast("string")).alias("url"),
        *extra,
    )


def behavior_lines(behavior: DataFrame) -> DataFrame:
    """Behavior records as comma-separated lines."""
    return behavior.select(
        F.concat_ws(
            ",",
            F.col("user_id").cast("string"),
            F.col("item_id").cast("string"),
            F.col("category_id").cast("string"),
            "behavior",
            F.col("timestamp").cast("string"),
        ).alias("value")
    )


def access_log_lines(log: DataFrame) -> DataFrame:
    """Access-log records as space-separated lines."""
    return log.select(
        F.concat_ws(
            " ",
            "ip",
            "user_id",
            F.lit("-"),
            F.date_format(F.timestamp_millis("event_time"), "dd/MM/yyyy:HH:mm:ss"),
            F.lit("+0000"),
            "method",
            "url",
        ).alias("value")
    )
