"""Tables and Arrow helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparvane.sources.shared import FEW, few, materialize, materialize_by, release, shared_dir

__all__ = ["FEW", "column_bytes", "documents", "few", "grouped", "materialize", "materialize_by", "pages", "release", "shared_dir", "slices", "table", "utf8", "without"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def utf8(text: str = "text") -> Column:
    """The text's UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def column_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary column, without copying."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_binary())
    _, offs, data = array.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def without(df: DataFrame, names: set[str]) -> list[Column]:
    """The columns of df but those of the given lower-case names."""
    return [df[f"`{c}`"] for c in df.columns if c.lower() not in names]


def slices(batch: pa.RecordBatch, column: pa.Array, limit: int) -> Iterator[pa.RecordBatch]:
    """Stretches of rows with about ``limit`` bytes of a binary column, one row at least."""
    if not batch.num_rows:
        return
    group = np.cumsum(np.diff(column_bytes(column)[0])) // limit
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])).tolist()
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def table(columns: dict[str, pa.Array | np.ndarray | list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def grouped(batches: Iterable[pa.RecordBatch], key: str, limit: int) -> Iterator[tuple[pa.Table, bool]]:
    """Cut sorted batches at changes of an integer key.

    Yields (rows, False) with complete groups of at most ``limit`` rows, and
    (rows, True) with rows of a group that has more. No more than one batch
    and ``limit`` rows are held.
    """
    carry: pa.Table | None = None
    over: int | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rows.num_rows == 0:
            continue
        if over is not None:
            keys = rows.column(key).to_numpy()
            n = int(np.searchsorted(keys != over, True)) if keys[-1] != over else len(keys)
            if n:
                yield rows.slice(0, n), True
                rows = rows.slice(n)
            if rows.num_rows == 0:
                continue
            over = None
        if carry is not None:
            rows = pa.concat_tables([carry, rows])
            carry = None
        keys = rows.column(key).to_numpy()
        change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        starts = np.concatenate([[0], change])
        ends = np.concatenate([change, [len(keys)]])
        large = ends[:-1] - starts[:-1] > limit
        at = 0
        for k in np.flatnonzero(large):
            if starts[k] > at:
                yield rows.slice(at, int(starts[k]) - at), False
            yield rows.slice(int(starts[k]), int(ends[k] - starts[k])), True
            at = int(ends[k])
        last = int(starts[-1])
        if last > at:
            yield rows.slice(at, last - at), False
        tail = rows.slice(last)
        if tail.num_rows > limit:
            over = int(keys[-1])
            yield tail, True
        else:
            carry = tail
    if carry is not None and carry.num_rows:
        yield carry, False
