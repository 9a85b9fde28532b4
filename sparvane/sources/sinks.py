"""Writers: tables, layouts for channel look-ups, CSV exports, vectors as bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANNEL_LAYOUT = ["Z", "A", "MT", "Projectile"]


def replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_by_channel(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Parquet in order of the channel, so that a look-up by it skips the files and row groups of other channels: what an index is for."""
    by = [c for c in (by or CHANNEL_LAYOUT) if c in df.columns]
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def bucketed(df: DataFrame, table: str, n: int, by: list[str]) -> None:
    """A catalogue table bucketed and sorted by ``by``: joins and rollups on it need no shuffle."""
    df.write.mode("overwrite").bucketBy(n, *by).sortBy(*by).format("parquet").saveAsTable(table)


def write_csv(df: DataFrame, path: str, null: str = "", partition: list[str] | None = None) -> None:
    """CSV with a header; null spells nulls, partition makes folders."""
    writer = df.write.mode("overwrite").option("header", True).option("nullValue", null)
    (writer.partitionBy(*partition) if partition else writer).csv(path)


def grid_csv(grid: DataFrame, path: str) -> None:
    """Curves on a grid, a folder for each evaluation; missing values are spelt nan."""
    named = grid.withColumnsRenamed({"energy": "grid_energy(eV)", "xs": "grid_xs(b)"})
    write_csv(named, path, null="nan", partition=["evaluation"])


def subset(df: DataFrame, **equal: object) -> DataFrame:
    """Rows with the given values, e.g. one channel for tests."""
    for c, v in equal.items():
        df = df.where(F.col(c) == F.lit(v))
    return df


def _float_bytes(values):  # noqa: ANN001, ANN202
    import numpy as np

    return values.map(lambda v: None if v is None else np.asarray(v, dtype="<f4").tobytes())


def _bytes_floats(values):  # noqa: ANN001, ANN202
    import numpy as np

    return values.map(lambda b: None if b is None else np.frombuffer(b, dtype="<f4"))


def vector_to_blob(c: Column) -> Column:
    """float32 bytes, for stores without arrays."""
    return F.pandas_udf(_float_bytes, "binary")(c)


def blob_to_vector(c: Column) -> Column:
    return F.pandas_udf(_bytes_floats, "array<float>")(c)
