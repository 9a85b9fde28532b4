"""Exact quantiles by rank selection, in fixed memory a task.

A sketch of each large group's values, which merges, brackets the wanted ranks
closely. One pass then counts the values below the bracket and each value in
it, and only what lies in the bracket is put in order. Small groups, whose
values fit a task, are counted value by value as a whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparvane.sources.shared import few, materialize

#: Rows up to which a group is counted as a whole, and the sketch's accuracy: a bracket holds some 4 / ACCURACY of a group's rows.
WHOLE, ACCURACY = 20_000, 10_000
BELOW = float("-inf")


def _same(a: DataFrame, b: DataFrame, keys: list[str], prefix: str) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"{prefix}{k}"]) for k in keys], F.lit(True))


def quantile(df: DataFrame, keys: list[str], value: Column, q: float, name: str, whole: int = WHOLE) -> DataFrame:
    """(keys, name): the exact quantile of each group, linear between ranks; null where a group has no value; one row where there are no keys.

    Values must be finite; nulls take no part. The values are written once,
    so that all passes see the same.
    """
    spark, own = df.sparkSession, [f"__k{i}" for i in range(len(keys))] or ["__all"]
    named = [F.col(k).alias(o) for k, o in zip(keys, own, strict=False)] or [F.lit(0).alias("__all")]
    rows = materialize(df.select(*named, value.cast("double").alias("__v")), "values")
    sizes = materialize(rows.groupBy(*own).agg(F.count("__v").alias("__n")), "sizes")
    large = sizes.where(F.col("__n") > whole)
    if large.isEmpty():
        out = rows.groupBy(*own).agg(F.percentile("__v", q).alias(name))
    else:
        names = few(large.select(*[F.col(o).alias(f"l{o}") for o in own], F.col("__n")))
        some, rest = (rows.join(names, _same(rows, names, own, "l"), how).select(rows["*"]) for how in ("left_semi", "left_anti"))
        selected = _select(some.where("__v is not null"), large, own, q, name)
        counted = rest.groupBy(*own).agg(F.percentile("__v", q).alias(name))
        out = selected.unionByName(counted)
    if not keys:  # one row, of an empty table too
        return spark.range(1).select(F.lit(0).alias("__all")).join(out, "__all", "left").select(name)
    return out.select(*[F.col(o).alias(k) for k, o in zip(keys, own, strict=True)], name)


def _select(rows: DataFrame, sizes: DataFrame, keys: list[str], q: float, name: str) -> DataFrame:
    """The quantile of large groups: brackets, counts, order within the brackets."""
    at = F.lit(q) * (F.col("__n") - 1)
    ranks = sizes.select(*keys, F.floor(at).cast("long").alias("__low"), F.ceil(at).cast("long").alias("__high"), (at - F.floor(at)).alias("__part"))
    ends = [max(0.0, q - 2 / ACCURACY), min(1.0, q + 2 / ACCURACY)]
    sketch = rows.groupBy(*keys).agg(F.percentile_approx("__v", ends, ACCURACY).alias("s"))
    brackets = materialize(sketch.select(*keys, F.col("s")[0].alias("__a"), F.col("s")[1].alias("__b")), "brackets")
    found = materialize(_picked(rows, brackets, ranks, keys), "quantiles")
    missed = (F.coalesce("__lo", F.lit(BELOW)) == BELOW) | F.col("__hi").isNull()
    # a sketch that is off its bound costs another pass, with all values of the group in the bracket
    again = materialize(found.where(missed).select(*keys, F.lit(BELOW).alias("__a"), F.lit(float("inf")).alias("__b")), "missed")
    if not again.isEmpty():
        found = found.where(~missed).unionByName(_picked(rows, again, ranks, keys))
    return found.select(*keys, ((1 - F.col("__part")) * F.col("__lo") + F.col("__part") * F.col("__hi")).alias(name))


def _picked(rows: DataFrame, brackets: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, __part, __lo, __hi): the values at two ranks; BELOW or null where a rank is not in the bracket."""
    # one row for each group of very many rows goes out; the rows stay where they are
    b = few(brackets.select(*[F.col(k).alias(f"b{k}") for k in keys], "__a", "__b"))
    # what lies below a bracket is one value; equal values are combined before they move
    inside = rows.join(b, _same(rows, b, keys, "b")).where("__v <= __b").groupBy(*[rows[k] for k in keys], F.when(F.col("__v") >= F.col("__a"), F.col("__v")).otherwise(BELOW).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    upto = F.sum("__c").over(Window.partitionBy(*keys).orderBy("__v"))
    r = few(ranks.select(*[F.col(k).alias(f"r{k}") for k in keys], "__low", "__high", "__part"))
    placed = inside.withColumn("__upto", upto)
    met = placed.join(r, _same(placed, r, keys, "r"))
    pick = lambda rank: F.min(F.when(F.col("__upto") > F.col(rank), F.col("__v")))
    return met.groupBy(*[placed[k] for k in keys], "__part").agg(pick("__low").alias("__lo"), pick("__high").alias("__hi"))
