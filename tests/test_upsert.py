from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparvane.sources import upsert

BY, ON = ["Z", "Reaction"], ["measurement_id", "Z", "Reaction"]


@pytest.fixture
def made(spark, tmp_path):
    path = f"file://{tmp_path}/measurements"
    df = spark.range(400).select(F.col("id").alias("measurement_id"), (F.col("id") % 10).cast("int").alias("Z"), F.when(F.col("id") % 7 != 0, "N,G").alias("Reaction"), (F.col("id") * 1.0).alias("Data"), F.lit(None).cast("double").alias("dData"), F.lit("quantile").alias("source"))
    upsert.create(df, path, BY, 16)
    return path


def rows(spark, path):
    return {r.measurement_id: (r.Z, r.Reaction, r.Data, r.dData, r.source) for r in upsert.read(spark, path).collect()}


def files(spark, path):
    return set(upsert.read(spark, path).inputFiles())


def changes(spark, wanted):
    return spark.createDataFrame([(i, i % 10, "N,G" if i % 7 else None, float(v)) for i, v in wanted], "measurement_id long, Z int, Reaction string, dData double").withColumn("source", F.lit("nlp"))


def update(spark, path, wanted):
    return upsert.update(spark, path, changes(spark, wanted), ON, BY, 16)


def test_only_changed_partitions_are_rewritten(spark, made):
    before, old = rows(spark, made), files(spark, made)
    assert len(before) == 400
    touched = update(spark, made, [(3, 0.5), (13, 0.6), (7, 0.7), (9999, 1.0)])
    after = rows(spark, made)
    assert len(touched) == 2 and len(after) == 400
    assert {i for i in before if before[i] != after[i]} == {3, 13, 7} and after[3][3:] == (0.5, "nlp") and after[7][3:] == (0.7, "nlp")
    kept = old & files(spark, made)
    assert kept == {f for f in old if not any(f"{upsert.PART}={p}/" in f for p in touched)} and len(kept) < len(old)
    # new predictions: one channel of the two differs
    assert len(update(spark, made, [(3, 0.5), (13, 0.9), (7, 0.7)])) == 1
    assert rows(spark, made)[13][3] == 0.9 and rows(spark, made)[3][3] == 0.5
    # a second run of the same changes touches no file
    again = files(spark, made)
    assert update(spark, made, [(3, 0.5), (13, 0.9), (7, 0.7)]) == [] and files(spark, made) == again


def test_a_run_that_dies_leaves_the_old_table(spark, made):
    before, old = rows(spark, made), files(spark, made)
    fails = changes(spark, [(3, 0.5), (13, 0.6)]).withColumn("dData", F.when(F.col("measurement_id") == 13, F.raise_error(F.lit("killed")).cast("double")).otherwise(F.col("dData")))
    with pytest.raises(Exception, match="killed"):
        upsert.update(spark, made, fails, ON, BY, 16)
    # and one that dies while the table's own files are written
    broken = spark.read.parquet(made).withColumn("Data", F.when(F.col("measurement_id") == 399, F.raise_error(F.lit("killed")).cast("double")).otherwise(F.col("Data")))
    with pytest.raises(Exception, match="killed"):
        upsert._write(broken, made)
    assert rows(spark, made) == before and files(spark, made) == old
    assert update(spark, made, [(3, 0.5)]) and rows(spark, made)[3][3] == 0.5


def test_nothing(spark, made, tmp_path):
    assert upsert.update(spark, made, changes(spark, [(3, 0.5)]).limit(0), ON, BY, 16) == []
    with pytest.raises(ValueError, match="channel"):
        upsert.update(spark, made, changes(spark, [(3, 0.5)]), ["measurement_id"], BY, 16)
