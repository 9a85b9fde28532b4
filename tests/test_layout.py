from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparvane.sources import layout


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('layout')}/m"
    h = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n)).cast("int")
    df = spark.range(60_000).select(F.col("id"), h(1, 90).alias("Z")).withColumn("A", (F.col("Z") * 2 + h(2, 6)).cast("int")).withColumn("MT", F.element_at(F.array(*[F.lit(x) for x in (1, 2, 4, 102)]), h(3, 4) + 1))
    df = df.withColumn("Energy", F.pow(F.lit(10.0), h(4, 1_000_000) / 1e5 - 3)).withColumn("Energy", F.when(F.col("id") % 97 != 0, F.col("Energy")))
    layout.write(df, path, 1024)
    return df, path


def same(a, b):
    return sorted(r.id for r in a.select("id").collect()) == sorted(r.id for r in b.select("id").collect())


def test_a_channel_reads_few_files(spark, made):
    df, path = made
    total = len(layout.files_for(spark, path))
    assert total > 900
    for z in (5, 26, 80):
        files = layout.files_for(spark, path, Z=(z, z), A=(2 * z + 3, 2 * z + 3), MT=(102, 102))
        assert 0 < len(files) < total / 10
        assert same(layout.look_up(spark, path, Z=(z, z), A=(2 * z + 3, 2 * z + 3), MT=(102, 102)), df.where(f"Z = {z} and A = {2 * z + 3} and MT = 102"))


def test_an_energy_range_reads_few_files(spark, made):
    df, path = made
    total = len(layout.files_for(spark, path))
    for low, high in ((0.5, 0.6), (1e3, 1.2e3), (1e6, 1.1e6)):
        files = layout.files_for(spark, path, Energy=(low, high))
        assert 0 < len(files) < total / 10
        assert same(layout.look_up(spark, path, Energy=(low, high)), df.where(f"Energy between {low} and {high}"))


def test_whole_table_and_nothing(spark, made, tmp_path):
    df, path = made
    assert spark.read.parquet(path).count() == df.count() == layout.look_up(spark, path).count()
    assert layout.look_up(spark, path, Z=(1000, 2000)).count() == 0
    small = f"file://{tmp_path}/s"
    layout.write(df.where("id < 3").withColumn("MT", F.lit(None).cast("int")), small, 4)
    assert spark.read.parquet(small).count() == 3 and layout.look_up(spark, small, MT=(0, 999)).count() == 0
