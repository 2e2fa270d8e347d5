"""Record and result schemas."""

from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

BEHAVIOR = StructType(
    [
        StructField("user_id", LongType()),
        StructField("item_id", LongType()),
        StructField("category_id", IntegerType()),
        StructField("behavior", StringType()),
        StructField("timestamp", LongType()),  # epoch seconds
    ]
)

ACCESS_LOG = StructType(
    [
        StructField("ip", StringType()),
        StructField("user_id", StringType()),
        StructField("event_time", LongType()),  # epoch milliseconds
        StructField("method", StringType()),
        StructField("url", StringType()),
    ]
)

ITEM_COUNT = StructType(
    [
        StructField("window_end", LongType()),
        StructField("item_id", LongType()),
        StructField("count", LongType()),
    ]
)

URL_COUNT = StructType(
    [
        StructField("window_end", LongType()),
        StructField("url", StringType()),
        StructField("count", LongType()),
    ]
)

PV_COUNT = StructType(
    [
        StructField("window_end", LongType()),
        StructField("salt_key", StringType()),
        StructField("count", LongType()),
    ]
)

UPSERT_ROW = StructType(
    [
        StructField("endtime1", LongType(), False),
        StructField("rk", IntegerType(), False),
        StructField("url2", StringType(), False),
        StructField("counts2", LongType(), False),
    ]
)

RETRACT_ROW = StructType(
    [
        StructField("is_add", BooleanType(), False),
        StructField("counts", LongType()),
        StructField("endtime", LongType()),
    ]
)

REPORTS = StructType(
    [StructField("window_end", LongType()), StructField("report", StringType())]
)
