from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from sparvane.operators import asof, interp


def slow(asked, series):
    """Neighbours by looking at every row."""
    out = set()
    for k, x in asked:
        if k is None or x is None:
            continue
        rows = sorted((a, y) for c, a, y in series if c == k and a is not None)
        lower = [r for r in rows if r[0] <= x]
        upper = [r for r in rows if r[0] > x]
        out.add((k, x, lower[-1] if lower else None, upper[0] if upper else None))
    return out


@pytest.mark.parametrize("stretch", [10**6, 20, 0])
def test_neighbours(spark, stretch):
    rng = random.Random(stretch)
    series = [(rng.choice("abc"), rng.choice([None, *[rng.randint(0, 60) / 2] * 12]), rng.random()) for _ in range(150)]
    series += [("only grid", 1.0, 1.0), (None, 1.0, 1.0), ("low", 5.0, 0.5), ("high", -5.0, 0.5), ("far", 1.0, 0.1), ("far", 2.0, 0.2)]
    asked = [(rng.choice(["a", "b", "c", None, "no curve"]), rng.choice([None, *[rng.randint(-8, 140) / 4] * 12])) for _ in range(300)]
    asked += [("low", x / 10) for x in range(40)] + [("high", x / 10) for x in range(40)] + [("far", x / 10) for x in range(40)] + [("a", 7.25)] * 500
    s = spark.createDataFrame(series, "k string, gx double, y double")
    a = spark.createDataFrame(asked, "k string, x double")
    got = asof.between(a.repartition(3), s, ["k"], "x", "gx", ["y"], stretch=stretch)
    pair = lambda v: None if v is None else (v.x, v.y)
    rows = [(r.k, r.x, pair(r.lower), pair(r.upper)) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == slow(asked, series)


def test_a_dense_curve_takes_time_linear_in_its_rows(spark):
    """All points and grid points of one curve in one decade: no task sees the whole curve."""
    n = 160_000
    grid = spark.range(n).select(F.lit("c").alias("k"), (1 + F.col("id") / n).alias("gx"), (F.col("id") % 7).cast("double").alias("gy"))
    points = spark.range(n).select(F.lit("c").alias("k"), (1 + (F.col("id") * 7919 % n + 0.5) / n).alias("x"))
    began = time.time()
    out = interp.interpolate(points, grid, ["k"], "x", "gx", "gy", "v")
    total = out.agg(F.count("v"), F.sum("v")).first()
    assert total[0] == n and time.time() - began < 40
    i = (n * (F.col("x") - 1)).cast("long")  # the grid point below
    wrong = out.where(F.col("x") < 2 - 1 / n).where(F.abs(F.col("v") - (i % 7 + (i + 1) % 7) / 2) > 1e-6)
    assert wrong.count() == 0


def test_odd_inputs(spark):
    points = spark.createDataFrame([("a", 1.0), ("a", float("nan")), (None, 1.0), ("a", None), ("b", 1.0)], "k string, x double")
    none = spark.createDataFrame([], "k string, gx double, gy double")
    assert [r.v for r in interp.interpolate(points, none, ["k"], "x", "gx", "gy", "v").collect()] == [None] * 5
    grid = spark.createDataFrame([("a", 1.0, 3.0)], "k string, gx double, gy double")
    rows = interp.interpolate(points, grid, ["k"], "x", "gx", "gy", "v").collect()
    assert sorted((r.k or "", str(r.x), r.v) for r in rows) == [("", "1.0", None), ("a", "1.0", 3.0), ("a", "None", None), ("a", "nan", 0.0), ("b", "1.0", None)]
    assert interp.interpolate(points.limit(0), grid, ["k"], "x", "gx", "gy", "v").collect() == []
