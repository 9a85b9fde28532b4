"""Rollups of measurements to subentries, entries and channels, and summaries of completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparvane.operators.quantile import quantile


def _joined(rows: Column, order: str, value: str, separator: str) -> Column:
    """Values of the group's rows that pass, in their order, joined."""
    seen = F.array_sort(F.collect_list(F.when(rows, F.struct(F.col(order).alias("o"), F.col(value).alias("v")))))
    return F.array_join(F.transform(seen, lambda s: s["v"]), separator)


def subentries(df: DataFrame, key: str, firsts: list[str], order: str, energy: str = "Energy", error: str = "dData") -> DataFrame:
    """One row per key: first values in row order, range and median of the energy, and counts.

    Medians are by rank selection where a key has very many rows.
    """
    median = quantile(df, [key], F.col(energy), 0.5, "E_median").withColumnRenamed(key, "__key")
    rolled = df.groupBy(key).agg(
        *[F.min_by(c, order).alias(c) for c in firsts],
        F.min(energy).alias("E_min"),
        F.max(energy).alias("E_max"),
        F.count(F.lit(1)).alias("num_measurements"),
        F.count(error).alias("num_measurements_uncertainty"),
    )
    return rolled.join(median, rolled[key].eqNullSafe(median["__key"])).select(key, *firsts, "E_min", "E_max", "E_median", "num_measurements", "num_measurements_uncertainty")


def entries(df: DataFrame, key: str, sets: dict[str, tuple[str, str]], subentry: str, order: str, error: str = "dData") -> DataFrame:
    """One row per key: different values joined in first-seen order, and counts.

    sets: new column -> (column, separator). All sets go through one scan:
    values are reduced to one row per key, set and value before they are
    gathered, so that a key with very many rows gathers only its different
    values.
    """
    counts = df.groupBy(key).agg(
        F.count_distinct(subentry).alias("Num_Subentries"),
        F.count(F.lit(1)).alias("Num_Measurements"),
        F.count_if(F.col(error).isNull()).alias("Num_Missing_Uncertainty"),
        F.bool_and(F.col(error).isNotNull()).alias("Uncertainty_Complete"),
    )
    if not sets:
        return counts
    each = F.array(*[F.struct(F.lit(i).alias("i"), F.col(column).cast("string").alias("v")) for i, (column, _) in enumerate(sets.values())])
    values = df.select(F.col(key).alias("__key"), F.col(order).alias("__order"), F.inline(each).alias("__set", "__value")).where("__value is not null")
    once = values.groupBy("__key", "__set", "__value").agg(F.min("__order").alias("__first"))
    joined = once.groupBy("__key").agg(*[_joined(F.col("__set") == i, "__first", "__value", separator).alias(name) for i, (name, (_, separator)) in enumerate(sets.items())])
    out = counts.join(joined, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
    return out.withColumns({name: F.coalesce(name, F.lit("")) for name in sets})


def channel_summary(df: DataFrame, channel: list[str], flags: dict[str, Column]) -> DataFrame:
    """One row per channel with rows, and whether any of them has each flag."""
    return df.groupBy(*channel).agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in flags.items()])


def distinct_first(df: DataFrame, keys: list[str], values: list[str], order: str) -> DataFrame:
    """One row per key with the values of its first row."""
    return df.groupBy(*keys).agg(*[F.min_by(v, order).alias(v) for v in values])


def null_fraction(df: DataFrame, key: str, column: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(F.col(column).isNull().cast("double")).alias("null_fraction"))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """(bin, count) for bins of equal width, closed on the right, the least value in the first; empty bins are kept."""
    ends = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    number = F.when(width == 0, F.lit(1)).otherwise(F.least(F.greatest(F.ceil(F.try_divide(F.col(column) - F.col("lo"), width)), F.lit(1)), F.lit(bins))).cast("int")
    counted = df.where(F.col(column).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))  # ends is one row
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("count"))


def completeness(df: DataFrame, entry: str, subentry: str, error: str = "dData") -> DataFrame:
    """One row: totals, missing errors and their share in per cent to a tenth, entries and subentries."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(error).isNull()).alias("missing"),
        F.count_distinct(entry).alias("entries"),
        F.count_distinct(subentry).alias("subentries"),
    ).withColumn("missing_percent", F.round(F.try_divide(F.col("missing") * 100.0, F.col("total")), 1))
