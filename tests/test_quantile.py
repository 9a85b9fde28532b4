from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparvane.operators import impute
from sparvane.operators import quantile as module
from sparvane.operators.quantile import quantile


def rows_of(seed):
    rng = random.Random(seed)
    kinds = [lambda: rng.random(), lambda: float(rng.randint(0, 3)), lambda: 7.0, lambda: -(10.0 ** rng.randint(-9, 9)), lambda: rng.choice([None, rng.random()])]
    return [(f"g{i}" if i else None, kind()) for i, kind in enumerate(kinds) for _ in range(rng.choice([1, 2, 1000, 1501]))] + [("none", None)]


def expected(rows, q):
    out = {}
    for k in {k for k, _ in rows}:
        values = [v for c, v in rows if c == k and v is not None]
        out[k] = float(np.quantile(values, q)) if values else None
    return out


@pytest.mark.parametrize(("q", "whole"), [(0.9, 0), (0.5, 0), (0.0, 0), (1.0, 0), (0.9, 500), (0.123, 10**9)])
def test_quantiles_are_numpys(spark, q, whole):
    for seed in (1, 2):
        rows = rows_of(seed)
        df = spark.createDataFrame(rows, "k string, v double").repartition(5)
        got = {r.k: r.x for r in quantile(df, ["k"], F.col("v"), q, "x", whole).collect()}
        want = expected(rows, q)
        assert got.keys() == want.keys()
        for k, v in want.items():
            assert got[k] == v if v is None else abs(got[k] - v) <= 1e-9 * max(1, abs(v)), (k, seed)


def test_no_keys_and_nothing(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    for whole in (0, 1000):
        assert quantile(df, [], F.col("v"), 0.9, "x", whole).collect()[0].x == 90.0
        assert [r.x for r in quantile(df.limit(0), [], F.col("v"), 0.9, "x", whole).collect()] == [None]
    assert quantile(df.limit(0).withColumn("k", F.lit(1)), ["k"], F.col("v"), 0.9, "x").collect() == []


def test_a_bracket_that_misses_is_mended(spark, monkeypatch):
    """With an accuracy the sketch does not keep, and a sketch that is wrong altogether."""
    rows = [("a", random.Random(3).random()) for _ in range(4000)] + [("b", float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v double")
    monkeypatch.setattr(module.F, "percentile_approx", lambda c, ends, accuracy: F.array(F.max(c), F.max(c)))
    got = {r.k: r.x for r in quantile(df, ["k"], F.col("v"), 0.9, "x", 0).collect()}
    want = expected(rows, 0.9)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_a_hot_group_is_ordered_within_its_bracket_only(spark):
    n = 400_000
    df = spark.range(n).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % n / n).alias("v"))
    assert abs(quantile(df, ["k"], F.col("v"), 0.9, "x").first().x - 0.9 * (n - 1) / n) < 1e-9
    rows = df.select(F.col("k"), F.col("v").alias("__v"))
    ends = rows.groupBy("k").agg(F.percentile_approx("__v", [0.9 - 2 / module.ACCURACY, 0.9 + 2 / module.ACCURACY], module.ACCURACY).alias("s")).first().s
    assert rows.where(F.col("__v").between(*ends)).count() < 20 * n / module.ACCURACY


def test_rows_of_a_channel_need_not_meet(spark):
    """Quantiles and fractions go to the rows: no task sorts or builds a table of a hot channel."""
    df = spark.range(150_000).select((F.col("id") % 2).alias("c"), F.lit(2.0).alias("Data"), F.when(F.col("id") % 3 > 0, 1.0).alias("dData"))
    out = impute.assume_errors(df, ["c"], ["dData"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BuildLeft" not in plan
    assert {(r.c, r.dData_assumed) for r in out.distinct().collect()} == {(0, 1.0), (1, 1.0)}
