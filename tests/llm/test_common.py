from __future__ import annotations

from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

from sparvane.llm import common
from sparvane.sources import shared as written


def test_tables_are_written_to_the_shared_folder_and_released(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")) / spark.sparkContext.applicationId
    df = common.materialize(spark.range(3), "numbers")
    assert df.count() == 3 and list(shared.glob("numbers-*/*.parquet"))
    common.release(spark)
    assert not shared.exists()
    assert common.materialize(spark.range(0), "none").count() == 0


def test_large_tables_that_pack_well_are_not_broadcast(spark):
    """A file of one repeated value is tiny; unpacked it would fill the driver."""
    n = common.FEW + 1
    large, few = (common.materialize(spark.range(k).select((F.col("id") * 0).alias("k"), F.lit(1.5).alias("v")), "repeated") for k in (n, 3))
    other = spark.range(5).withColumnRenamed("id", "k").repartition(2)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan(other.join(large, "k")) and "SortMergeJoin" in plan(large.where("v > 1").join(other, "k"))
    assert "BroadcastHashJoin" in plan(other.join(few, "k")) and other.join(large, "k").count() == n
    assert "BroadcastHashJoin" in plan(large.join(common.few(few), "k"))


def test_slices_by_bytes():
    batch = pa.record_batch({"x": pa.array(range(7)), "t": pa.array(["abc", "abc", "é", None, "x" * 50, "", "y"])})
    parts = [p.column(0).to_pylist() for p in common.slices(batch.slice(1), batch.slice(1).column(1), 10)]
    assert sum(parts, []) == list(range(1, 7)) and len(parts) > 1
    assert list(common.slices(batch.slice(0, 0), batch.slice(0, 0).column(1), 10)) == []


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    """Else the disk holds the shuffles of all steps at once."""
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {p for d in folders for p in Path(d).rglob("shuffle_*.data")}
    before = files()
    made = common.materialize(spark.range(20_000).selectExpr("id % 7919 AS k", "id").groupBy("k").agg(F.max("id").alias("m")), "made")
    assert len(folders) > 0 and not {p for p in files() - before if p.stat().st_size > 1_000}  # of the table's rows; a count leaves a few bytes
    assert made.count() == 7919
    assert spark.conf.get(written.CLEANUP) == "false"


def test_buckets_are_not_shuffled_again(spark):
    left = common.materialize_by(spark.range(100).selectExpr("id % 9 AS k", "id"), "left", "k")
    right = spark.range(50).selectExpr("id % 9 AS k", "id AS v")
    met = left.groupBy("k").cogroup(right.groupBy("k")).applyInArrow(lambda a, b: pa.table({"n": [a.num_rows * b.num_rows]}), "n long")
    assert met._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sum(r.n for r in met.collect()) == sum(len(range(k, 100, 9)) * len(range(k, 50, 9)) for k in range(9))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("left_")]
