"""Helpers shared by the document operators: Arrow batches, global running sums, components of links."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.session import cut_lineage, written

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
ROWS = 512  # documents that a task turns into Python objects at a time, whatever the session's Arrow batch is


def partitions(df: DataFrame) -> int:
    """Partitions of a range shuffle: the session's own count."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def packed(df: DataFrame, text: str, id: str) -> DataFrame:
    """``doc_id``, ``text`` and, in one struct, all other columns, so that no name can clash with the operator's own."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != text]
    return df.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), F.struct(*rest).alias("rest"))


def unpacked(df: DataFrame, like: DataFrame, text: str, new_text: str = "text") -> DataFrame:
    """The columns of ``like`` in their order, from the struct that ``packed`` made."""
    return df.select(*[F.col(new_text).alias(c) if c == text else F.col("rest").getField(c).alias(c) for c in like.columns])


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a bounded number of documents."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of every text; a null is empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def schema_of(df: DataFrame, **added: str) -> T.StructType:
    """The frame's schema with added columns, given as DDL types."""
    out = T.StructType(list(df.schema.fields))
    for name, kind in added.items():
        out = out.add(name, T._parse_datatype_string(kind))
    return out


def running_total(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Add the running sum of ``value`` over all rows in one global order, the row itself included.

    The rows are range-partitioned by the order, written once, summed per range, and every range adds the sum
    of those before it. The only table in one task is that of the ranges. Rows that share one value of the
    whole order may change places with each other. No rows give no rows.
    """
    ranged = df.repartitionByRange(partitions(df), *order).withColumn("_range", F.spark_partition_id())
    rows = written(ranged, "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("_range").agg(F.sum(value).alias("_sum"))
    starts = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per range: the broadcast side has as many rows as the session has shuffle partitions.
    out = rows.join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + F.sum(value).over(inside))
    return out.drop("_range", "_start")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node that it reaches) of all linked nodes.

    Alternating large and small stars: every node hangs its larger neighbours, then its smaller ones, on the
    least of them, until nothing changes. A round is a few aggregations and joins over the links, written to
    the shared folder; the driver sees one number a round. Null ends are no links.
    """
    def least(edges, at, other):
        return edges.groupBy(F.col(at).alias("_at")).agg(F.min(other).alias("_least"))

    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
    edges, seen = cut_lineage(edges.distinct()), None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        mins = least(both, "u", "v").select("_at", F.least("_at", "_least").alias("_least"))
        large = both.filter("v > u").join(mins, F.col("u") == F.col("_at")).select(F.col("v").alias("u"), F.col("_least").alias("v"))
        # Every edge hangs its larger end, so the large star has an edge for each; the small star turns to the smaller ends.
        large = large.distinct()
        mins = least(large, "u", "v")
        joined = large.join(mins, F.col("u") == F.col("_at"))
        small = joined.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("_least").alias("v")), F.struct(F.col("u"), F.col("_least").alias("v")))).alias("e"))
        edges = cut_lineage(small.select("e.*").filter("u != v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = tuple(now)


def shares(values: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of every run of equal values in a sorted array."""
    if not len(values):
        return []
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    bounds = [0, *cuts.tolist(), len(values)]
    return list(zip(bounds[:-1], bounds[1:]))
