"""Appending measurements batch by batch: the bounded pipeline's create-then-append as a stream of micro-batches.

The reference semantics have no windows, watermarks or late data, and none
are added: rows of a batch are appended once, and rollups are made from the
whole table afterwards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType


def append_stream(spark: SparkSession, source: str, schema: StructType, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Transform each new file of ``source`` and write it to ``target``, exactly once per batch; stops when all is read.

    A batch is written to a folder of its own number and replaces what a
    failed attempt at it has left.
    """

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).format(fmt).load(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def appended(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).withColumn("batch", F.col("batch").cast("long"))
