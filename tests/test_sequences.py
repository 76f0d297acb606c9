import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyframe.operators import sequences as sq
from skyframe.operators.quantiles import exact_quantiles


@pytest.fixture
def rows(spark):
    rng = random.Random(1)
    data = [("hot" if i % 3 else f"k{i % 4}", rng.randrange(300), i, rng.choice([None, 1, 2, 3])) for i in range(400)]
    return data, spark.createDataFrame(data, "k string, t long, i long, v int")


def _frame(data):
    return pd.DataFrame(data, columns=["k", "t", "i", "v"]).sort_values(["k", "t", "i"])


def test_previous_running_and_ordinal(rows, cut_keys):
    data, df = rows
    want = _frame(data)
    want["p"] = want.groupby("k").i.shift()
    want["s"] = want.groupby("k").i.cumsum()
    want["o"] = want.groupby("k").cumcount()
    got = sq.with_previous(df, ["k"], ["t", "i"], ["i"]).toPandas().set_index("i").sort_index()
    assert got.prev_i.fillna(-1).tolist() == want.set_index("i").sort_index().p.fillna(-1).tolist()
    got = sq.with_running(df, ["k"], ["t", "i"], F.col("i"), "s").toPandas().set_index("i").sort_index()
    assert got.s.tolist() == want.set_index("i").sort_index().s.tolist()
    got = sq.with_ordinal(df, ["k"], ["t", "i"]).toPandas().set_index("i").sort_index()
    assert got.ordinal.tolist() == want.set_index("i").sort_index().o.tolist()


def test_running_max_excludes_the_row(rows, cut_keys):
    data, df = rows
    want = _frame(data)
    want["m"] = want.groupby("k").i.transform(lambda s: s.cummax().shift())
    got = sq.with_running_max(df, ["k"], ["t", "i"], "i", "m").toPandas().set_index("i").sort_index()
    assert got.m.fillna(-1).tolist() == want.set_index("i").sort_index().m.fillna(-1).tolist()


@pytest.mark.parametrize("bounded", [False, True])
def test_neighbours(rows, cut_keys, bounded):
    data, df = rows
    want = _frame(data)
    want["last"] = want.groupby("k").v.ffill()
    want["nxt"] = want.groupby("k").v.bfill()
    got = sq.with_neighbours(df, ["k"], ["t", "i"], "v", "last", "nxt", bounded=bounded).toPandas().set_index("i").sort_index()
    want = want.set_index("i").sort_index()
    assert got["last"].fillna(-1).tolist() == want["last"].fillna(-1).tolist()
    assert got["nxt"].fillna(-1).tolist() == want["nxt"].fillna(-1).tolist()


def test_asof_both_ways(spark, cut_keys):
    rng = random.Random(2)
    left = [("a", rng.randrange(1000), i) for i in range(150)]
    right = [("a", t) for t in sorted({rng.randrange(1000) for _ in range(60)})]
    a, b = spark.createDataFrame(left, "k string, w long, i int"), spark.createDataFrame(right, "k string, h long")
    got = {r.i: r.hit for r in sq.asof_latest(a, b, ["k"], "w", "h", [], ["h"], tolerance_us=20).collect()}
    for _, w, i in left:
        best = max((h for _, h in right if w - 20 <= h <= w), default=None)
        assert (got[i].h if got[i] else None) == best
    got = {r.i: r.hit for r in sq.asof_nearest(a, b, ["k"], "w", "h", ["h"], 15).collect()}
    for _, w, i in left:
        best = min((h for _, h in right if abs(h - w) <= 15), key=lambda h: (abs(h - w), h), default=None)
        assert (got[i].h if got[i] else None) == best


@pytest.mark.parametrize("cut", [False, True])
def test_exact_quantiles(spark, cut, request):
    if cut:
        request.getfixturevalue("cut_keys")
    rng = np.random.default_rng(3)
    data = [("a", float(v)) for v in rng.normal(size=333)] + [("b", float(v)) for v in rng.integers(0, 4, 57)] + [("c", 5.0), ("d", None)]
    df = spark.createDataFrame(data, "k string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.98, 1.0]
    got = {r.k: r for r in exact_quantiles(df, ["k"], F.col("v"), probs, [f"q{i}" for i in range(6)]).collect()}
    for key in "abc":
        want = np.quantile([v for k, v in data if k == key], probs)
        assert np.allclose([got[key][f"q{i}"] for i in range(6)], want)
    assert got["d"].q3 is None
    few = {r.k: r for r in exact_quantiles(df, ["k"], F.col("v"), probs, [f"q{i}" for i in range(6)], bounded=True).collect()}
    assert few["b"].q2 == pytest.approx(got["b"].q2)
    assert exact_quantiles(df, [], F.col("v"), [0.5], ["m"]).first().m == pytest.approx(np.median([v for _, v in data if v is not None]))


def test_null_keys_are_keys(spark, cut_keys):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0), ("a", None)], "k string, v double")
    got = {r.k: r.m for r in exact_quantiles(df, ["k"], F.col("v"), [0.5], ["m"]).collect()}
    assert got == {None: 2.0, "a": 2.0}
    runs = sq.with_running(spark.createDataFrame([(None, i, i) for i in range(50)], "k string, o long, v long"), ["k"], ["o"], F.col("v"), "s", total="t")
    assert {(r.o, r.s, r.t) for r in runs.collect()} == {(i, i * (i + 1) // 2, 1225) for i in range(50)}


def test_a_third_of_the_rows_in_one_key(spark, cut_keys):
    """One scan equals the plain window, whatever the sizes of the keys."""
    from pyspark.sql import Window

    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).alias("k"), F.xxhash64("id").alias("o"), (F.col("id") % 11).alias("v"))
    plain = Window.partitionBy("k").orderBy("o")
    want = df.select("k", "o", F.sum("v").over(plain.rowsBetween(Window.unboundedPreceding, 0)).alias("s"), F.lag("v").over(plain).alias("prev_v"))
    got = sq.with_previous(sq.with_running(df, ["k"], ["o"], F.col("v"), "s"), ["k"], ["o"], ["v"]).select("k", "o", "s", "prev_v")
    assert got.exceptAll(want).count() == 0 and got.count() == 6000


ELEMENTS = "k string, t timestamp_ntz, g string, a array<struct<b: int, o: string, n: long>>, i int"


def _elements(seed, instants, keys, n=300):
    """Scans with nulls everywhere, empty arrays, repeats, and bands whose origins come in another order than their scans' least ones."""
    from datetime import datetime, timedelta

    rng = random.Random(seed)
    rows = [("none", datetime(2024, 1, 1), "g", None, -1), ("none", None, "g", [], -2)]
    for i in range(n):
        found = [(rng.choice([1, 2, 3, None]), rng.choice([None, f"o{rng.randrange(200)}"]), i) for _ in range(rng.randint(1, 4))]
        at = rng.randrange(instants + 1)
        rows.append((rng.choice(keys), datetime(2024, 1, 1) + timedelta(minutes=at) if at else None, "g", found, i))
    return rows + rows[5:8]


@pytest.mark.parametrize("instants,keys", [(1, ["a"]), (2, ["a", None]), (40, ["a", "b", None]), (10_000, ["a"]), (300, [str(i) for i in range(250)]), (0, ["a", "b"])])
@pytest.mark.parametrize("groups", [1 << 18, 0])
def test_elements_are_numbered_like_by_a_window(spark, cut_keys, monkeypatch, instants, keys, groups):
    from pyspark.sql import Window

    monkeypatch.setattr(sq, "GROUPS", groups)
    df = spark.createDataFrame(_elements(instants, instants, keys), ELEMENTS).repartition(3)
    at = F.unix_micros(F.col("t").cast("timestamp"))
    got = sq.with_element_ordinal(df, ["k"], at, "a", "b", "o", "nth", ("g", "changed"))
    plain = df.select("k", "t", "i", F.size("a").alias("_size"), F.explode("a").alias("_element"))
    w = Window.partitionBy("k", "_element.b").orderBy(F.unix_micros(F.col("t").cast("timestamp")), "_element.o")
    # Elements alike in instant and order may change places.
    told = lambda d: sorted(((r.k, r._element.b, r.nth, r.t, r._element.o) for r in d.collect()), key=str)
    assert told(got) == told(plain.withColumn("nth", F.row_number().over(w) - 1))
    rest = lambda d: sorted(((r.k, r.t, r.i, r._size, tuple(r._element)) for r in d.collect()), key=str)
    assert rest(got) == rest(plain)


def test_one_instant_lies_in_several_ranges(spark, cut_keys):
    df = spark.createDataFrame(_elements(3, 0, ["a"], 900), ELEMENTS).repartition(3)
    ranges = sq.ranged(df, [F.col("k"), F.col("t"), F.array_min(F.transform("a", lambda x: x["o"]))])
    held = ranges.filter("k = 'a'").groupBy("_block").count().collect()
    assert len(held) > 4 and max(r["count"] for r in held) < 450
    # The rows are dealt once: what reads them again has the same ranges and reads no table.
    assert sorted(map(tuple, ranges.filter("k = 'a'").groupBy("_block").count().collect())) == sorted(map(tuple, held))
    assert "Exchange" not in ranges._jdf.queryExecution().executedPlan().toString()


def test_elements_are_shuffled_once_and_not_written(spark, monkeypatch):
    tables, keep = [], sq.written
    monkeypatch.setattr(sq, "written", lambda df, name: tables.append((name, df.columns)) or keep(df, name))
    df = spark.createDataFrame(_elements(4, 500, ["a", "b"]), ELEMENTS).repartition(3)
    sq.with_element_ordinal(df, ["k"], F.unix_micros(F.col("t").cast("timestamp")), "a", "b", "o")
    assert [name for name, _ in tables] == ["edges", "counted", "ranges"] and "_element" not in tables[0][1] + tables[1][1]
    with pytest.raises(Exception, match="changed"):
        other = df.unionByName(df.limit(1).withColumn("g", F.lit("h")))
        sq.with_element_ordinal(other, ["k"], F.unix_micros(F.col("t").cast("timestamp")), "a", "b", "o", unchanged=("g", "changed")).collect()
