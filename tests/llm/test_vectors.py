"""Vector searches against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyframe.llm import exact_search, neighbours

KIND = "vec_id long, embedding array<float>, score double, rank int, v string"


def some(n=400, width=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).astype(np.float32)
    x[100:160] = x[100]
    x[200:230] = x[200] + rng.normal(size=(30, width)).astype(np.float32) * 0.01
    rows = [(int(i), [float(c) for c in v], None, 1, "v") for i, v in enumerate(x)]
    bad = [(n, None), (n + 1, [0.0] * width), (n + 2, [float("nan")] + [1.0] * (width - 1)), (n + 3, [float("inf")] * width), (n + 4, [None] + [1.0] * (width - 1)), (n + 5, []),
           (None, [1.0] * width)]
    return x.astype(np.float64), rows + [(i, v, None, None, None) for i, v in bad]


@pytest.fixture
def vectors(spark):
    x, rows = some()
    return x, spark.createDataFrame(rows + [rows[7]], KIND).repartition(4)


def test_neighbours(vectors, spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SLICE", 64)
    monkeypatch.setattr(neighbours, "CHUNK", 5)
    monkeypatch.setattr(neighbours, "PIECE", 3)
    x, frame = vectors
    norm = np.sqrt((x * x).sum(axis=1))
    got = neighbours.search(frame, "id % 10 = 0", 5).collect()
    hits = 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(0, 400, 10):
        s = (x[q] * x).sum(axis=1) / (norm[q] * norm)
        want = [i for i in np.lexsort((np.arange(400), -s)) if i != q][:5]
        found = sorted(by[q])
        assert [k for k, _, _ in found] == list(range(1, len(found) + 1))
        assert all(sc == s[i] for _, i, sc in found)
        assert [(-sc, i) for _, i, sc in found] == sorted((-sc, i) for _, i, sc in found)
        hits += len(set(want) & {i for _, i, _ in found})
    assert set(by) == set(range(0, 400, 10))
    assert hits >= 0.9 * 200


def test_all_buckets_give_all_neighbours(vectors):
    x, frame = vectors
    norm = np.sqrt((x * x).sum(axis=1))
    hashing = neighbours.Hashing(tables=2, functions=3, width=50.0, probes=27)
    for r in neighbours.search(frame, "id % 50 = 0", 3, hashing).collect():
        s = (x[r.query_id] * x).sum(axis=1) / (norm[r.query_id] * norm)
        assert [i for i in np.lexsort((np.arange(400), -s)) if i != r.query_id][r.rank - 1] == r.vec_id


def test_probes_come_by_rising_cost():
    hashing = neighbours.Hashing(functions=4, probes=10)
    unit = neighbours.units(np.random.default_rng(1).normal(size=(20, 8)))
    visited, own = hashing.visited(unit, 0), hashing.codes(unit, 0)
    assert visited.shape == (20, 10) and all(c in v for c, v in zip(own, visited))


def test_few_and_no_vectors(spark):
    empty = spark.createDataFrame([], KIND)
    assert neighbours.search(empty, "id % 2 = 0", 5).collect() == []
    assert exact_search.top_k(exact_search.as_integers(empty), "id % 2 = 0", 5).collect() == []
    three = spark.createDataFrame([(i, [1.0, float(i)], None, None, None) for i in range(3)], KIND)
    assert len(neighbours.search(three, "id = 0", 5).collect()) == 2
    assert [tuple(r) for r in exact_search.top_k(exact_search.as_integers(three), "id = 0", 5).collect()] == [(0, 1, 1, 4096), (0, 2, 2, 4096)]
    assert exact_search.top_k(exact_search.as_integers(three), "id > 9", 5).collect() == []


@pytest.mark.parametrize("blocks", [(16, 8, 4), (8192, 1024, 2048)])
def test_exact_top_k(vectors, blocks, monkeypatch):
    for name, value in zip(("ROW_BLOCK", "QUERY_BLOCK", "PIECE"), blocks):
        monkeypatch.setattr(exact_search, name, value)
    x, frame = vectors
    whole = np.floor(64 * x).astype(np.int64)
    whole = np.concatenate([whole, np.zeros((1, 16), np.int64)])
    ids = np.array([*range(400), 401])  # the zero vector takes part
    got = exact_search.top_k(exact_search.as_integers(frame), "id % 20 = 0", 20)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(0, 400, 20):
        s = whole @ whole[q]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        assert sorted(found[q]) == [(k + 1, int(ids[i]), int(s[i])) for k, i in enumerate(order)]
    assert set(found) == set(range(0, 401, 20)) - {400}


def test_large_numbers_stay_exact():
    a = np.array([[3_000_000_019, -7], [1, 2]], np.int64)
    assert exact_search.product(a, a).tolist() == [[3_000_000_019**2 + 49, 3_000_000_019 - 14], [3_000_000_019 - 14, 5]]


def test_vectors_of_other_lengths(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0]), (3, [0.0, 1.0])]
    frame = spark.createDataFrame([(*r, None, None, None) for r in rows], KIND)
    assert {r.vec_id for r in neighbours.search(frame, "id = 0", 5).collect()} == {1, 3}
    assert {r.vec_id for r in exact_search.top_k(exact_search.as_integers(frame), "id = 0", 5).collect()} == {1, 3}
    assert frame.select(F.col("vec_id")).count() == 4


def integers(spark, values, kept):
    return spark.createDataFrame([(i, [int(c) for c in v]) for i, v in enumerate(values)], "vec_id long, vector array<long>").filter(kept).repartition(3)


def plain_top(values, queries, k):
    out = []
    for q in queries:
        s = [sum(int(a) * int(b) for a, b in zip(values[q], v)) for v in values]
        order = sorted((i for i in range(len(values)) if i != q), key=lambda i: (-s[i], i))[:k]
        out += [(q, n, i, s[i]) for n, i in enumerate(order, 1)]
    return out


@pytest.mark.parametrize("most", [3, 100, 40_000, 600_000_000])
def test_top_k_in_many_tiles(spark, monkeypatch, most):
    for name, value in (("ROW_BLOCK", 16), ("QUERY_BLOCK", 8), ("PIECE", 7), ("TILE", 200), ("PAIRS", 1)):
        monkeypatch.setattr(exact_search, name, value)
    rng = np.random.default_rng(most % 97)
    values = rng.integers(-most, most, (150, 5), endpoint=True)
    values[60:110] = values[60]  # ties beyond k
    values[120:] //= 1000
    got = exact_search.top_k(integers(spark, values, "true"), "id % 6 = 0", 7)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == plain_top(values, range(0, 150, 6), 7)


def test_pairs_of_blocks_are_neither_broadcast_nor_shuffled(spark, monkeypatch):
    """Packed query blocks look small enough to broadcast, but there was one copy of them for every row block."""
    plans, keep = [], exact_search.written
    monkeypatch.setattr(exact_search, "written", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or keep(df, name))
    for name, value in (("ROW_BLOCK", 16), ("QUERY_BLOCK", 8)):
        monkeypatch.setattr(exact_search, name, value)
    values = np.random.default_rng(1).integers(-50, 50, (300, 4))
    out = exact_search.top_k(integers(spark, values, "true"), "id % 5 = 0", 3)
    assert "Join" not in dict(plans)["cutoffs"]
    joins = [line for line in out._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in line]
    assert len(joins) == 1, joins  # the cutoffs, once a block of queries
    assert out.count() == 180
