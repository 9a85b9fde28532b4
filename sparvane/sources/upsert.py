"""Updating written measurements by label: only the partitions that change are rewritten.

A table is Parquet in folders by the hash of its channel columns. An update
finds the partitions whose values differ, writes their new rows to the shared
folder, and replaces these partitions alone (dynamic partition overwrite). New
files appear when the job commits, so a run that dies before leaves the table
as it was, and one that is repeated finds nothing to change. All other columns,
row ids among them, stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparvane.sources.shared import materialize

#: The partition column, and how many values it has.
PART, PARTS = "channel_part", 64
CHANNEL = ["Z", "A", "Reaction"]


def _dealt(df: DataFrame, by: list[str], parts: int) -> DataFrame:
    return df.withColumn(PART, F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int"))


def _write(df: DataFrame, path: str) -> None:
    # rebalanced by size: a partition with very many rows is several tasks' and files
    df.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def create(df: DataFrame, path: str, by: list[str] | None = None, parts: int = PARTS) -> None:
    """Write a new table; by: the columns whose values stay together."""
    _write(_dealt(df, by or CHANNEL, parts), path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)


def update(spark: SparkSession, path: str, changes: DataFrame, on: list[str], by: list[str] | None = None, parts: int = PARTS) -> list[int]:
    """Set the columns of ``changes`` in the rows with the same ``on``, and return the partitions that were rewritten.

    changes: ``on``, which are unique in it and include ``by``, and columns of
    the table. A row without a partner changes nothing. by and parts are
    those of ``create``.
    """
    by = by or CHANNEL
    if not set(by) <= set(on):
        raise ValueError(f"changes must name the channel columns {by}")
    table, sets = spark.read.parquet(path), [c for c in changes.columns if c not in on]
    new = materialize(_dealt(changes, by, parts), "changes")
    touched = [r[PART] for r in new.select(PART).distinct().collect()]  # numbers below ``parts``
    files = table.where(F.col(PART).isin(touched))  # prunes the others' folders
    values = new.select(*[F.col(c).alias(f"__on_{c}") for c in on], *[F.col(c).cast(table.schema[c].dataType).alias(f"__new_{c}") for c in sets], F.lit(True).alias("__hit"))
    same, differs = F.lit(True), F.lit(False)
    for c in on:
        same = same & files[c].eqNullSafe(values[f"__on_{c}"])
    for c in sets:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"__new_{c}"))
    joined = files.join(values, same, "left")
    changed = sorted(r[PART] for r in joined.where(F.col("__hit") & differs).select(PART).distinct().collect())
    if changed:
        updated = joined.where(F.col(PART).isin(changed)).select(*[F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in sets else F.col(c) for c in table.columns])
        _write(materialize(updated, "updated"), path)  # written aside first, as it is read from the folders it replaces
    return changed
