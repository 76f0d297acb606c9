"""Helpers of the vector searches: clean vectors, blocks of rows as matrices, the best scores of every query."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there, has components, and all of them are finite numbers."""
    doubles = vector.cast("array<double>")
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equally long lists as a matrix, without a Python object per component."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches joined into tables of at least ``rows`` rows (but the last)."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def best(rows: DataFrame, k: int, by: list[Column], query: str = "query_id") -> DataFrame:
    """The first ``k`` rows of each query in the given order, with their ``rank`` from 1. The limit applies on both sides
    of the shuffle, so a query sends at most ``k`` rows per task."""
    rank = F.row_number().over(Window.partitionBy(query).orderBy(*by))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)
