"""A layout for look-ups by channel and by energy: Morton order with statistics of each file.

A channel's number puts Z before A before MT (A follows Z so closely that
bits of both would say the same twice). Channel and energy are turned into
ranks among quantiles of the table, and the bits of the two ranks interleaved.
Rows in order of that number are cut into files, so a file holds a narrow box
of channels and energies, and its least and greatest values say whether a
look-up needs it: what an index over several columns is for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a rank: quantiles are 2 ** BITS - 1.
BITS = 6
#: The columns of a channel, each below 1,000, and the energy.
CHANNEL, ENERGY = ["Z", "A", "MT"], "Energy"
STATS = "_stats"


def _order(ranks: list[Column], bits: int) -> Column:
    """The interleaved bits, highest first."""
    number = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for r in ranks:
            number = number * 2 + F.shiftright(r, bit).bitwiseAND(F.lit(1))
    return number


def _rank(value: Column, steps: list[float]) -> Column:
    """How many of the steps are no greater than the value."""
    if not steps:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(float(s)) for s in steps]), lambda s: s <= value)), F.lit(0))


def write(df: DataFrame, path: str, files: int, energy: str = ENERGY, bits: int = BITS) -> None:
    """Parquet in Morton order in about ``files`` files, with their statistics beside them. Nulls are the lowest rank."""
    channel = F.lit(0.0)
    for c in CHANNEL:
        channel = channel * 1000 + F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    values = [F.col(energy).cast("double"), channel]
    ends = [i / 2**bits for i in range(1, 2**bits)]
    quantiles = df.agg(*[F.percentile_approx(v, ends, 50 * 2**bits).alias(n) for n, v in zip("ec", values, strict=True)]).first()  # a few numbers
    ordered = df.withColumn("__order", _order([_rank(v, q or []) for v, q in zip(values, quantiles, strict=True)], bits))
    by = ["__order", *CHANNEL, energy]  # rows of one number are in order too, and can be several files
    ordered.repartitionByRange(files, *by).sortWithinPartitions(*by).drop("__order").write.mode("overwrite").parquet(path)
    named = df.sparkSession.read.parquet(path).withColumn("file", F.input_file_name())
    stats = [f(c).alias(f"{n}_{c}") for c in [*CHANNEL, energy] for n, f in (("min", F.min), ("max", F.max))]
    named.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *stats).coalesce(1).write.mode("overwrite").parquet(f"{path}/{STATS}")


def files_for(spark: SparkSession, path: str, **ranges: tuple[object, object]) -> list[str]:
    """The files that may hold rows with each column within its (least, greatest)."""
    stats = spark.read.parquet(f"{path}/{STATS}")
    may = [(F.col(f"min_{c}") <= F.lit(high)) & (F.col(f"max_{c}") >= F.lit(low)) for c, (low, high) in ranges.items()]
    return [r.file for r in stats.where(reduce(lambda a, b: a & b, may, F.lit(True))).select("file").collect()]


def look_up(spark: SparkSession, path: str, **ranges: tuple[object, object]) -> DataFrame:
    """Rows with each column within its (least, greatest); only files that may hold some are read. Null is within no range."""
    files = files_for(spark, path, **ranges)
    table = spark.read.parquet(path)
    found = spark.read.schema(table.schema).parquet(*files) if files else table.limit(0)
    return found.where(reduce(lambda a, b: a & b, [F.col(c).between(*r) for c, r in ranges.items()], F.lit(True)))
