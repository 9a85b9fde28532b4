"""Interpolation join of measured points with reference curves, and metrics against them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparvane.functions.clean import finite
from sparvane.operators.asof import between


def interpolate(points: DataFrame, grid: DataFrame, keys: list[str], x: str, grid_x: str, grid_y: str, value: str, outside: str = "zero") -> DataFrame:
    """points with ``value``: the curve of their keys at x, linear between grid points.

    Null where there is no curve or no x; outside the grid 0, null or the
    nearest end ("zero", "null", "clamp"). The different (keys, x) of the
    points are merged with the grid in order, and the values join the points
    by equality: points that share an x are looked up once.
    """
    near = between(points, grid.select(*keys, grid_x, F.col(grid_y).alias("y")), keys, x, grid_x, ["y"])
    at, lower, upper = F.col(x), F.col("lower"), F.col("upper")
    beyond: Column = F.lit(None).cast("double")
    if outside == "zero":
        beyond = F.lit(0.0)
    elif outside == "clamp":
        beyond = F.coalesce(lower["y"], upper["y"])
    line = lower["y"] + F.coalesce(F.try_divide((at - lower["x"]) * (upper["y"] - lower["y"]), upper["x"] - lower["x"]), F.lit(0.0))
    inside = lower.isNotNull() & (upper.isNotNull() | (at == lower["x"]))
    values = near.select(*[F.col(k).alias(f"__{k}") for k in keys], at.alias("__at"), F.when(inside, line).when(lower.isNotNull() | upper.isNotNull(), beyond).alias(value))
    on = reduce(lambda a, b: a & b, [points[k] == values[f"__{k}"] for k in keys], points[x] == values["__at"])
    return points.join(values, on, "left").select(points["*"], values[value])


def chi_squared(data: Column, curve: Column, error: Column, squared_error: bool = False) -> Column:
    """(data - curve)**2 / error; squared_error divides by error**2."""
    return F.try_divide(F.pow(data - curve, F.lit(2.0)), error * error if squared_error else error)


def relative_error(data: Column, curve: Column) -> Column:
    """In per cent of the curve; null where that is 0."""
    return finite(F.try_divide(data - curve, curve)) * 100


def with_metrics(df: DataFrame, evaluation: str, data: str = "Data", error: str = "dData_assumed") -> DataFrame:
    """df with <evaluation>_chi_squared and <evaluation>_relative_error."""
    curve = F.col(f"`{evaluation}`")
    return df.withColumn(f"{evaluation}_chi_squared", chi_squared(F.col(data), curve, F.col(error))).withColumn(f"{evaluation}_relative_error", relative_error(F.col(data), curve))
