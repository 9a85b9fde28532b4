"""Tables that a job writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used where the session names no shared folder (tests, one machine).
LOCAL_SHARED = "file:///tmp/checkpoints"
#: Rows up to which Spark may broadcast a written table. Its files' size says little: repeated values pack a hundredfold.
FEW = 100_000
#: What is shuffled for a table is deleted once the table is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or LOCAL_SHARED where that is unset and all run on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = LOCAL_SHARED
        spark.conf.set("spark.checkpoint.dir", named)
        own = f"{named.removeprefix('file://')}/{spark.sparkContext.applicationId}"
        atexit.register(shutil.rmtree, own, ignore_errors=True)
    return named.rstrip("/")


def release(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder; results not yet written elsewhere can then not be read."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{context.applicationId}")
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run meanwhile go at its end; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it back.

    Lost executors then cost a re-read, not a recomputation, and every later
    use sees the same rows. A table of more than ``FEW`` rows joins by merge
    unless the other side is broadcast: by its files' size Spark would
    broadcast tables that fill the driver and a task once unpacked.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    with _shuffles_deleted(spark):
        df.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    return written if written.count() <= FEW else written.hint("merge")


def materialize_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``materialize``, in buckets of a column: grouping and joining by it later move none of these rows.

    The buckets are as many as the session's shuffle partitions. The table's
    name leaves the catalog at once; its files stay as those of others do.
    """
    spark = df.sparkSession
    called = f"{re.sub(r'[^a-z0-9]', '_', name.lower())}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{called}"
    with _shuffles_deleted(spark):
        df.write.option("compression", "zstd").option("path", path).bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).saveAsTable(called, format="parquet")
    written = spark.table(called)
    spark.sql(f"DROP TABLE {called}")
    return written


def few(df: DataFrame, limit: int = FEW) -> DataFrame:
    """df, to be broadcast if it has at most ``limit`` rows; counted, so best of a written table."""
    return F.broadcast(df) if df.count() <= limit else df
