"""Exact top-k by inner product: three-phase uniform threshold over lists of partial scores."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import partitions
from skyframe.llm.vectors import best, finite, matrix
from skyframe.session import written

QUERY_BLOCK = 1024  # queries whose scores one task holds at a time
ROW_BLOCK = 8192  # rows of a block
PIECE = 2048  # rows that meet a query block at a time; a task holds QUERY_BLOCK x PIECE scores of a list
LISTS = 2  # pieces of a vector, each with a score list of its own
OWN = -(1 << 61)  # below every entry
DEPTH = 3  # entries that a local list sends first, as a multiple of the wanted results
TILE = 1 << 22  # components of a task's row blocks, and of its query blocks
PAIRS = 16  # pairs of blocks for which a task of its own is worth while


def blocks(rows: DataFrame, key: str, vector: str, count: int, name: str) -> DataFrame:
    """Rows dealt by hash into ``count`` blocks and cut into ``LISTS`` pieces of their vectors: ``name`` (block),
    ``part``, ids and pieces as packed arrays of numbers of ``size`` bytes. One row of the result is one block's one list."""
    dealt = rows.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.pmod(F.xxhash64(key), F.lit(count)).cast("int").alias(name))

    def pack(table):
        table = table.sort_by([("id", "ascending")])
        ids, values = table.column("id").to_numpy(), matrix(table.column("v"))
        low, high = int(values.min(initial=0)), int(values.max(initial=0))
        size = next(n for n in (1, 2, 4, 8) if -(1 << 8 * n - 1) <= low and high < 1 << 8 * n - 1)
        edges = np.linspace(0, values.shape[1], LISTS + 1).astype(int)
        block = table.column(name)[0].as_py()
        return pa.table({
            name: pa.array([block] * LISTS, pa.int32()), "part": pa.array(range(LISTS), pa.int32()), "ids": pa.array([ids.tobytes()] * LISTS, pa.binary()),
            "values": pa.array([values[:, a:b].astype(f"<i{size}").tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
            "size": pa.array([size] * LISTS, pa.int32())})

    return dealt.groupBy(name).applyInArrow(pack, f"{name} int, part int, ids binary, values binary, size int")


def unpack(ids: bytes, values: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(values, f"<i{size}").reshape(len(ids), -1)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point, and as such numbers, while every sum is exact there."""
    most = [float(max(-int(x.min(initial=0)), int(x.max(initial=0)))) for x in (a, b)]
    bound = most[0] * most[1] * max(1, a.shape[1])
    kind = np.float32 if bound < 2.0**23 else np.float64 if bound < 2.0**52 else np.int64
    return a.astype(kind) @ b.astype(kind).T


def entries(q: np.ndarray, a: np.ndarray, r: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of one list, the partial scores of queries and rows. A query's own row is no entry: it is below all. ``r`` rises."""
    s = product(a, b)
    at = np.minimum(np.searchsorted(r, q), len(r) - 1)
    own = r[at] == q
    s[own, at[own]] = OWN if s.dtype == np.int64 else -np.inf
    return s


def in_tiles(left: DataFrame, right: DataFrame, across: int, down: int) -> DataFrame:
    """Row blocks and query blocks, dealt into ``across`` times ``down`` tiles: every pair of blocks meets in one tile,
    and one task gets a tile, its row blocks first. Blocks are copied once a tile, not once a pair."""
    a = left.select(F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("_other"), F.lit(0).alias("side"), F.col("r").alias("block"), "part", "ids", "values", "size",
                    F.lit(None).cast("array<long>").alias("cut_ids"), F.lit(None).cast("array<long>").alias("cuts"))
    b = right.select(F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("_other"), F.lit(1).alias("side"), F.col("q").alias("block"), "part", "ids", "values", "size", "cut_ids", "cuts")
    tile = F.when(F.col("side") == 0, F.col("block") % across * down + F.col("_other")).otherwise(F.col("_other") * down + F.col("block") % down)
    both = a.unionByName(b).withColumn("tile", tile.cast("int")).drop("_other")
    return both.repartitionById(across * down, "tile").sortWithinPartitions("tile", "side", "block", "part")


def tiles_of(batches):
    """Of every query block in a tile: its ids and lists, its cutoffs by id, and ids and lists of the tile's rows by rising id."""
    tile, blocks, lists, rows = None, [], [], None
    for batch in batches:
        for row in batch.to_pylist():
            if row["tile"] != tile:
                tile, blocks, rows = row["tile"], [], None
            ids, values = unpack(row["ids"], row["values"], row["size"])
            lists.append(values)
            if row["part"] < LISTS - 1:
                continue
            if row["side"] == 0:
                blocks.append((ids, lists))
            elif blocks:
                if rows is None:
                    r = np.concatenate([x for x, _ in blocks])
                    order = np.argsort(r)
                    rows = r[order], [np.concatenate(x)[order] for x in zip(*(x for _, x in blocks))]
                yield ids, lists, dict(zip(row["cut_ids"] or (), row["cuts"] or ())), *rows
            lists = []


def firsts(x: np.ndarray, by: tuple[np.ndarray, ...], k: int) -> np.ndarray:
    """Where the first ``k`` of every ``x`` stand, ``x`` by ``x`` and in order of ``by`` (the last key counts most)."""
    order = np.lexsort((*by, x))
    x = x[order]
    return order[np.arange(len(x)) - np.searchsorted(x, x) < k]


def heads(q: np.ndarray, a: np.ndarray, r: np.ndarray, b: np.ndarray, depth: int, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Of one list, queries and rows of the ``depth`` best entries of every query."""
    found, held, least = [], 0, np.full(len(q), -np.inf)

    def trimmed():
        x, y, s = (np.concatenate(v) for v in zip(*found))
        kept = firsts(x, (-s,), depth)
        x, y, s = x[kept], y[kept], s[kept]
        last = np.flatnonzero(np.arange(len(x)) - np.searchsorted(x, x) == depth - 1)
        least[x[last]] = s[last]
        return x, y, s

    for start in range(0, len(r), piece):
        s = entries(q, a, r[start:start + piece], b[start:start + piece])
        s = s if s.dtype != np.int64 else np.where(s == OWN, -np.inf, s)  # heads only name rows; their scores are exact later
        over = s > least.astype(s.dtype)[:, None]
        if not found and depth < s.shape[1]:
            over = s >= np.partition(s, s.shape[1] - depth, axis=1)[:, -depth][:, None]
        x, y = np.nonzero(over)
        found.append((x, y + start, s[x, y].astype(np.float64)))
        held += len(x)
        if start == 0 or held > 4 * depth * len(q):
            found = [trimmed()]
            held = len(found[0][0])
    return trimmed()[:2]


def exact_scores(a: list[np.ndarray], b: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The sums of the lists' entries of queries ``x`` and rows ``y``."""
    total = np.zeros(len(x), np.int64)
    for start in range(0, len(x), 1 << 15):
        some = slice(start, start + (1 << 15))
        for q, r in zip(a, b):
            total[some] += np.einsum("ij,ij->i", q[x[some]].astype(np.int64), r[y[some]].astype(np.int64))
    return total


def result(q: np.ndarray, r: np.ndarray, x: np.ndarray, y: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q[x], pa.int64()), pa.array(r[y], pa.int64()), pa.array(total, pa.int64())], names=["query_id", "vec_id", "score"])


def local_lists(tiles: DataFrame, k: int, depth: int) -> DataFrame:
    """Phase 1: of every tile the ``depth`` best entries of every list of every query, and of the rows that they name the
    ``k`` of the best exact scores."""
    def run(batches):
        for q, a, _, r, b in tiles_of(batches):
            named = [x * len(r) + y for x, y in (heads(q, c, r, d, depth, PIECE) for c, d in zip(a, b))]
            codes = np.unique(np.concatenate(named))
            x, y = codes // len(r), codes % len(r)
            total = exact_scores(a, b, x, y)
            kept = firsts(x, (y, -total), k)
            yield result(q, r, x[kept], y[kept], total[kept])

    return tiles.mapInArrow(run, "query_id long, vec_id long, score long")


def sufficient(s: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phase 2: every entry of a list at or above the query's cutoff divided by the number of lists.

    A result's score is the sum of its entries, so at least one of them is no smaller than that share of it. The share is
    rounded up to a whole number, as the entries are whole.
    """
    share = -(-cuts // LISTS)
    x, y = np.nonzero(s >= share.astype(s.dtype)[:, None])
    return x, y, s[x, y].astype(np.int64)


def resolved(a: list[np.ndarray], b: list[np.ndarray], found: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phase 3: candidates of all lists with their exact scores; entries that a list has not given are computed."""
    n = len(b[0])
    codes = np.unique(np.concatenate([x * n + y for x, y, _ in found]))
    total = np.zeros(len(codes), np.int64)
    for q, r, (x, y, s) in zip(a, b, found):
        known = np.searchsorted(codes, x * n + y)
        missing = np.ones(len(codes), bool)
        missing[known] = False
        total[known] += s
        rest = codes[missing]
        total[missing] += exact_scores([q], [r], rest // n, rest % n)
    return codes // n, codes % n, total


def results(tiles: DataFrame, k: int) -> DataFrame:
    """Phases 2 and 3 in every tile: the ``k`` best rows of every query whose scores reach its cutoff."""
    def run(batches):
        for q, a, cut, r, b in tiles_of(batches):
            bar = np.array([cut.get(i, OWN) for i in q.tolist()], np.int64)
            x, y, total = (np.zeros(0, np.int64) for _ in range(3))
            for start in range(0, len(r), PIECE):
                there, rows = r[start:start + PIECE], [d[start:start + PIECE] for d in b]
                at, row, score = resolved(a, rows, [sufficient(entries(q, c, there, d), bar) for c, d in zip(a, rows)])
                good = score >= bar[at]
                x, y, total = (np.concatenate(v) for v in ((x, at[good]), (y, row[good] + start), (total, score[good])))
                kept = firsts(x, (y, -total), k)
                x, y, total = x[kept], y[kept], total[kept]
                # Ids rise from piece to piece: beside k rows a later one has to be better.
                full = np.flatnonzero(np.arange(len(x)) - np.searchsorted(x, x) == k - 1)
                bar[x[full]] = np.maximum(bar[x[full]], total[full] + 1)
            yield result(q, r, x, y, total)

    return tiles.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(rows: DataFrame, is_query: str, k: int, id: str = "vec_id", vector: str = "vector") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for every query row the ``k`` other rows of greatest inner product.

    ``vector`` is an array of longs, ``is_query`` a condition on ``id``. Every vector is cut into ``LISTS`` pieces; a list holds the partial scores of one
    piece. Phase 1 gathers the heads of all local lists; the exact scores of what they name give, per query, a cutoff that
    is no higher than its k-th best score. Phase 2 sends every block that cutoff and collects all entries that a result
    must have one of. Phase 3 computes the entries that these still lack, and so their exact scores. ``LISTS`` times a score
    must fit 64 bits. Blocks of rows and of queries meet in tiles, one to a task: its memory does not depend on the number
    of either, and no pair of blocks is broadcast or shuffled.

    Ties go to the smaller id. Rows with a null id or vector take no part; nor do null components or vectors of another
    length than the first query's (there is no product). Rows that repeat an id count once (one of them, if they differ:
    the smallest vector). Fewer candidates than ``k`` all come back. Empty tables and no queries give no rows.
    """
    good = F.col(id).isNotNull() & F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull()) & (F.size(vector) > 0)
    rows = written(rows.filter(good).groupBy(F.col(id).cast("long").alias("id")).agg(F.min(vector).alias("v")), "vectors")
    wanted = F.expr(is_query)
    facts = rows.agg(F.count(F.lit(1)), F.count(F.when(wanted, 1)), F.min_by(F.size("v"), F.when(wanted, F.col("id")))).first()
    n, n_queries, width = facts[0], facts[1], facts[2] or 0
    rows = rows.filter(F.size("v") == width)
    queries = rows.filter(wanted)
    n_r, n_q = max(1, math.ceil(n / ROW_BLOCK)), max(1, math.ceil(n_queries / QUERY_BLOCK))
    # Every row block meets every query block: the stated queries against all rows, in tiles of a bounded size.
    most_r, most_q = (max(1, TILE // (size * max(1, width))) for size in (ROW_BLOCK, QUERY_BLOCK))
    across = math.ceil(n_r / most_r)
    down = max(math.ceil(n_q / most_q), min(n_q, math.ceil(min(partitions(rows), 1 + n_r * n_q // PAIRS) / across)))
    left = written(blocks(rows, "id", "v", n_r, "r"), "row_blocks")
    right = written(blocks(queries, "id", "v", n_q, "q"), "query_blocks")
    without = right.withColumns({c: F.lit(None).cast("array<long>") for c in ("cut_ids", "cuts")})
    first = local_lists(in_tiles(left, without, across, down), k, DEPTH * k)
    kth = best(first, k, [F.col("score").desc(), F.col("vec_id")]).filter(F.col("rank") == k)
    # A block of queries has a bounded number of cutoffs; they travel with it. Without k heads there is no cutoff.
    sent = kth.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(n_q)).cast("int").alias("q")).agg(F.collect_list(F.struct("query_id", "score")).alias("c"))
    sent = written(sent.select("q", F.col("c.query_id").alias("cut_ids"), F.col("c.score").alias("cuts")), "cutoffs")
    last = results(in_tiles(left, right.join(sent, "q", "left"), across, down), k)
    return best(last, k, [F.col("score").desc(), F.col("vec_id")]).select("query_id", "rank", "vec_id", "score")


def as_integers(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """``vec_id`` and ``vector``: floor(scale * component) of every finite vector; others are left out."""
    whole = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * F.lit(scale)).cast("long"))
    return rows.filter(finite(F.col(vector))).select(F.col(id).cast("long").alias("vec_id"), whole.alias("vector"))
