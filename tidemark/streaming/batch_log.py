"""Results of a stream, kept per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from ..workspace import remove_folder


class BatchLog:
    """Parquet folder with one partition ``batch_id`` per micro-batch.

    A batch that runs again after a failure overwrites its own partition, and a
    reader that asks for earlier batches never sees a later attempt's rows.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        # An empty first partition: the folder can be read before any batch ran.
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(
            f"{self.path}/batch_id=-1"
        )

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.select(*self.schema.names).write.mode("overwrite").parquet(
            f"{self.path}/batch_id={batch_id}"
        )

    def read(self) -> DataFrame:
        typed = StructType([*self.schema.fields, StructField("batch_id", LongType())])
        return self.spark.read.schema(typed).parquet(self.path).where("batch_id >= 0")

    def of(self, *batch_ids: int) -> DataFrame:
        """The rows of these batches, by their paths: no other partition is listed."""
        paths = [f"{self.path}/batch_id={b}" for b in batch_ids or (-1,)]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def remove(self, batch_id: int) -> None:
        if batch_id >= 0:
            remove_folder(self.spark, f"{self.path}/batch_id={batch_id}")

    def rows(self) -> DataFrame:
        return self.read().select(*self.schema.names)
