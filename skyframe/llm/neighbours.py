"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing, exact reranking of what the probes find."""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyframe.llm.vectors import best, finite, matrix
from skyframe.session import written

SLICE = 16384  # index rows in one packed slice
CHUNK = 1024  # queries in one packed chunk
PIECE = 256  # queries scored at a time: PIECE x SLICE scores


@dataclass(frozen=True)
class Hashing:
    """``tables`` hash tables of ``functions`` p-stable functions floor((a . x + b) / width) of unit vectors, and how many
    perturbed buckets of a table a query visits. Gaussian ``a`` are stable for the Euclidean distance, which orders unit
    vectors as the cosine does."""

    tables: int = 2
    functions: int = 8
    width: float = 2.0
    probes: int = 1500
    seed: int = 1
    shifts: np.ndarray = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "shifts", np.int64(1) << (np.arange(self.functions, dtype=np.int64) * (62 // self.functions)))

    def project(self, unit: np.ndarray, table: int) -> np.ndarray:
        rng = np.random.default_rng([self.seed, table, unit.shape[1]])
        a, b = rng.standard_normal((unit.shape[1], self.functions)), rng.random(self.functions)
        return unit @ a / self.width + b

    def codes(self, unit: np.ndarray, table: int) -> np.ndarray:
        return np.floor(self.project(unit, table)).astype(np.int64) @ self.shifts

    def visited(self, unit: np.ndarray, table: int) -> np.ndarray:
        """Codes of the buckets that each query visits, in estimated order of success: a perturbation crosses the upper or
        lower boundary of some functions, and is the likelier, the smaller the sum of its squared distances to them."""
        steps = perturbations(self.functions)
        place = self.project(unit, table)
        base = np.floor(place)
        up, down = (1 - (place - base)) ** 2, (place - base) ** 2
        cost = up @ (steps.T == 1) + down @ (steps.T == -1)
        n = min(self.probes, len(steps))
        order = np.argpartition(cost, n - 1, axis=1)[:, :n] if n < len(steps) else np.argsort(cost, axis=1)
        return (base.astype(np.int64) @ self.shifts)[:, None] + (steps.astype(np.int64) @ self.shifts)[order]


def perturbations(functions: int) -> np.ndarray:
    """All ways to step down, stay or step up in every function; beyond eight functions at most four of them move."""
    if functions <= 8:
        return np.array(list(itertools.product((-1, 0, 1), repeat=functions)), np.int8)
    out = [np.zeros(functions, np.int8)]
    for moved in range(1, 5):
        for where in itertools.combinations(range(functions), moved):
            for signs in itertools.product((-1, 1), repeat=moved):
                step = np.zeros(functions, np.int8)
                step[list(where)] = signs
                out.append(step)
    return np.array(out)


def units(values: np.ndarray) -> np.ndarray:
    return values / np.sqrt((values * values).sum(axis=1))[:, None]


def shard_of(codes: np.ndarray, table: int, shards: int) -> np.ndarray:
    """The shard of a bucket."""
    mixed = (codes.astype(np.uint64) + np.uint64(table)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(shards)).astype(np.int64)


def packed_parts(rows: DataFrame, size: int, names: list[str]) -> DataFrame:
    """Rows of a shard in packed parts of about ``size``: a crowded shard is cut by a hash of the id, so that no part grows."""
    counts = rows.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / size).alias("_parts"))
    cut = rows.join(counts, "shard").withColumn("_part", F.pmod(F.xxhash64("id"), F.col("_parts")))

    def pack(table):
        table = table.sort_by([("id", "ascending")])
        columns = [pa.array([table.column(c).to_numpy().astype(np.int64).tobytes()], pa.binary()) for c in names]
        values = np.ascontiguousarray(matrix(table.column("v")), np.float64)
        return pa.table({"shard": table.column("shard")[:1], **dict(zip(names, columns)), "v": pa.array([values.tobytes()], pa.binary())})

    kind = "shard long, " + ", ".join(f"{c} binary" for c in names) + ", v binary"
    return cut.groupBy("shard", "_part").applyInArrow(pack, kind)


def search(rows: DataFrame, is_query: str, k: int, hashing: Hashing | None = None, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: of the rows whose condition ``is_query`` on ``id`` holds, the ``k``
    nearest found among all other rows, by cosine in double precision.

    Every row is in one bucket of each table. A query visits its likeliest buckets in every table and takes all their rows
    as candidates; their cosines are computed exactly, and the best of all tables are merged. Buckets lie in shards that
    are packed in parts of bounded size; a query is sent to the shards that it visits.

    Of rows with one and the same vector the ``k + 1`` smallest ids are indexed: no other can be among ``k`` results, as ties
    go to the smaller id. Null, zero, empty and non-finite vectors take no part, nor null ids, nor vectors whose length
    differs from the most common one's. Rows that repeat an id count once (the smallest vector). A query that finds
    fewer than ``k`` rows in its buckets visits all buckets, so fewer candidates than ``k`` all come back. Empty tables and no queries give no rows. Other columns are not read.
    """
    hashing = hashing or Hashing()
    spark = rows.sparkSession
    doubles = F.col(f"`{vector}`").cast("array<double>")
    some = F.exists(doubles, lambda x: x != 0)
    clean = rows.filter(finite(F.col(f"`{vector}`"))).filter(some & F.col(f"`{id}`").isNotNull())
    clean = written(clean.groupBy(F.col(f"`{id}`").cast("long").alias("id")).agg(F.min(doubles).alias("v")), "vectors")
    widths = clean.groupBy(F.size("v").alias("w")).count().orderBy(F.col("count").desc(), "w").first()
    if widths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    clean = clean.filter(F.size("v") == widths["w"])
    shards = max(1, math.ceil(widths["count"] * hashing.tables / SLICE))
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    kept = clean.withColumn("_copy", place).filter(F.col("_copy") <= k + 1).drop("_copy")

    def index(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = units(matrix(batch.column("v")))
            for t in range(hashing.tables):
                code = hashing.codes(unit, t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard_of(code, t, shards)), batch.column("id"), pa.array(np.full(len(code), t, np.int64)), pa.array(code), batch.column("v")],
                    names=["shard", "id", "t", "code", "v"])

    def route(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, PIECE):
                part = batch.slice(start, PIECE)
                unit = units(matrix(part.column("v")))
                to = np.concatenate([shard_of(hashing.visited(unit, t), t, shards) for t in range(hashing.tables)], axis=1)
                pairs = np.unique(np.repeat(np.arange(len(to)), to.shape[1]) * shards + to.ravel())
                row = pa.array(pairs // shards)
                yield pa.RecordBatch.from_arrays([pa.array(pairs % shards), part.column("id").take(row), part.column("v").take(row)], names=["shard", "id", "v"])

    indexed = packed_parts(kept.mapInArrow(index, "shard long, id long, t long, code long, v array<double>"), SLICE, ["id", "t", "code"])
    asked = packed_parts(clean.filter(F.expr(is_query)).mapInArrow(route, "shard long, id long, v array<double>"), CHUNK, ["id"])
    def results(asked, everywhere):
        pairs = indexed.join(asked.select("shard", F.col("id").alias("q"), F.col("v").alias("qv")), "shard")
        found = pairs.mapInArrow(scored(hashing, k, everywhere), "query_id long, vec_id long, score double").dropDuplicates(["query_id", "vec_id"])
        return best(found, k, [F.col("score").desc(), F.col("vec_id")]).select("query_id", "rank", "vec_id", "score")

    indexed = written(indexed, "index")
    found = written(results(asked, False), "found")
    # A query whose buckets hold too few rows goes to all shards and all their buckets.
    have = found.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("_n"))
    short = clean.filter(F.expr(is_query)).join(have, "id", "left").filter(F.coalesce("_n", F.lit(0)) < min(k, widths["count"] - 1)).select("id", "v")
    if not short.limit(1).count():
        return found
    everywhere = short.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).select("shard", "id", "v")
    again = results(packed_parts(everywhere, CHUNK, ["id"]), True)
    return found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(again)


def scored(hashing: Hashing, k: int, everywhere: bool):
    """For a slice of index rows and a chunk of queries: the ``k`` best of every query in the buckets that it visits."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, tables, codes, queries = (np.frombuffer(row[c], np.int64) for c in ("id", "t", "code", "q"))
                x, y = np.frombuffer(row["v"]).reshape(len(ids), -1), np.frombuffer(row["qv"]).reshape(len(queries), -1)
                nx, ny = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
                for start in range(0, len(queries), PIECE):
                    q = slice(start, start + PIECE)
                    near = (y[q] @ x.T) / (ny[q, None] * nx[None, :])
                    hit = np.full(near.shape, everywhere)
                    for t in () if everywhere else np.unique(tables):
                        own = np.flatnonzero(tables == t)
                        buckets, bucket = np.unique(codes[own], return_inverse=True)
                        probes = hashing.visited(y[q] / ny[q, None], t)
                        at = np.minimum(np.searchsorted(buckets, probes), len(buckets) - 1)
                        open_ = np.zeros((len(probes), len(buckets)), bool)
                        who, which = np.nonzero(buckets[at] == probes)
                        open_[who, at[who, which]] = True
                        hit[:, own] = open_[:, bucket]
                    near[~hit | (queries[q, None] == ids[None, :])] = -np.inf
                    top = min(k * hashing.tables, near.shape[1])  # a row may be there once per table
                    least = np.partition(near, near.shape[1] - top, axis=1)[:, near.shape[1] - top]
                    # What lies within rounding of the k-th is kept too and computed again in one fixed order of summation.
                    a, b = np.nonzero((near >= least[:, None] - 1e-9) & (near > -np.inf))
                    exact = (y[q][a] * x[b]).sum(axis=1) / (ny[q][a] * nx[b])
                    order = np.lexsort((ids[b], -exact, a))
                    a, b, exact = a[order], b[order], exact[order]
                    keep = np.arange(len(a)) - np.searchsorted(a, a) < k * hashing.tables
                    yield pa.RecordBatch.from_arrays([pa.array(queries[q][a[keep]]), pa.array(ids[b[keep]]), pa.array(exact[keep])],
                                                     names=["query_id", "vec_id", "score"])

    return run
