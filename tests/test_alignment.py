import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyframe.operators import alignment as al

T0 = datetime(2024, 1, 31, 20)


def _obs(spark, seed, n, span_minutes=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        variable = rng.choice(["abi13c", "refc"])
        end = T0 + timedelta(seconds=rng.choice([0, 0, 30, 120, 300, 599]) + 60 * rng.randrange(span_minutes))
        if rng.random() < 0.4:
            end = end.replace(minute=end.minute // 10 * 10, second=0)
        rows.append((f"a{i:04d}", variable, end - timedelta(seconds=rng.choice([0, 60, 90])), end, 600 if variable == "abi13c" else 300))
    return rows, spark.createDataFrame(rows, "asset_id string, variable string, time timestamp_ntz, end_time timestamp_ntz, tolerance_s int")


def _sequential(rows, start, end):
    """Slots in order, newest unused finished observation, as plain Python."""
    chosen = {}
    for variable in ("abi13c", "refc"):
        free = [r for r in rows if r[1] == variable]
        slot = start - timedelta(minutes=50)
        while slot < end:
            fit = [r for r in free if timedelta(0) <= slot - r[3] <= timedelta(seconds=r[4])]
            if fit:
                best = max(fit, key=lambda r: (r[3], r[2], r[0]))
                free.remove(best)
                chosen[variable, slot] = best[0]
            slot += timedelta(minutes=10)
    return chosen


@pytest.mark.parametrize("seed,n", [(1, 40), (2, 150), (3, 400)])
def test_causal_alignment_matches_the_sequential_rule(spark, seed, n):
    rows, df = _obs(spark, seed, n)
    start, end = T0 + timedelta(hours=2), T0 + timedelta(hours=6)
    got = {(r.variable, r.slot_time): r.asset_id for r in al.causal_align(df, start.isoformat(), end.isoformat()).collect()}
    assert got == _sequential(rows, start, end)
    assert len(set(got.values())) == len(got)


def test_windows_over_a_month_end(spark):
    start, end = datetime(2024, 1, 31, 23), datetime(2024, 2, 1, 1)
    slots = [start - timedelta(minutes=50) + timedelta(minutes=10 * i) for i in range(17)]
    rows = [(f"g{i}", "abi13c", s - timedelta(minutes=5), s - timedelta(seconds=20), 600) for i, s in enumerate(slots)]
    rows += [(f"m{i}", "refc", s - timedelta(minutes=1), s - timedelta(minutes=1), 300) for i, s in enumerate(slots)]
    schema = "asset_id string, variable string, time timestamp_ntz, end_time timestamp_ntz, tolerance_s int"

    def windows(data):
        aligned = al.causal_align(spark.createDataFrame(data, schema), start.isoformat(), end.isoformat())
        return al.window_index(aligned, start.isoformat(), end.isoformat(), 2).orderBy("time").collect()

    whole = windows(rows)
    assert len(whole) == 12 and all(w.eligible for w in whole)
    holed = windows([r for r in rows if r[0] != "m8"])
    assert [w.missing_observations for w in holed].count(1) == 6
    changed = [w.window_id != h.window_id for w, h in zip(whole, holed)]
    assert changed == [not h.eligible for h in holed]


def _greedy(assets, slots, tolerance, nearest):
    used, out = set(), {}
    for slot in slots:
        fit = [a for a in assets if a not in used and (abs(a[0] - slot) <= tolerance if nearest else timedelta(0) <= slot - a[0] <= tolerance)]
        if fit:
            best = min(fit, key=lambda a: (abs(a[0] - slot), a[0] > slot, a[1]))
            used.add(best)
            out[slot] = best[1]
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("method,tolerance", [("previous", 5), ("nearest", 4), ("nearest", 5)])
def test_slot_matching_matches_greedy(spark, seed, method, tolerance):
    rng = random.Random(seed)
    assets = [(T0 + timedelta(minutes=5 * rng.randrange(60) + rng.choice([0, 0, 0, 1, 2, 3])), f"k{i:03d}") for i in range(45)]
    start, end = T0 + timedelta(minutes=30), T0 + timedelta(hours=4)
    slots = [start + timedelta(minutes=10 * i) for i in range(21)]
    df = spark.createDataFrame([("x", *a) for a in assets], "series string, time timestamp_ntz, key string")
    fn = al.match_previous if method == "previous" else al.match_nearest
    got = {r.slot_time: r.key for r in fn(df, start.isoformat(), end.isoformat(), 10, tolerance, ["series"]).collect()}
    assert got == _greedy(assets, slots, timedelta(minutes=tolerance), method == "nearest")


def test_hour_matching_example(spark):
    day = datetime(2024, 5, 1)
    df = spark.createDataFrame([("x", day.replace(hour=16, minute=58), "a"), ("x", day.replace(hour=18, minute=2), "b")], "s string, time timestamp_ntz, key string")
    args = (df, "2024-05-01T17:00:00", "2024-05-01T19:00:00", 60, 5, ["s"])
    only = al.match_previous(*args).collect()
    assert [(r.key, r.offset_seconds) for r in only] == [("a", -120.0)]
    assert al.match_previous(*args, exact=True).count() == 0
    assert al.match_nearest(*args).count() == 2
    with pytest.raises(ValueError):
        al.match_previous(*args[:4], 31, ["s"])


def test_decimation_examples(spark):
    def run(minutes, n, bands=(1,)):
        rows = [(b, T0 + timedelta(minutes=m), f"k{b}-{m:02d}") for b in bands for m in minutes]
        df = spark.createDataFrame(rows, "band int, time timestamp_ntz, key string")
        return sorted((r.band, r.time.minute) for r in al.decimate(df, n, ["band"]).collect())

    full = (2, 11, 28, 41, 50, 58)
    assert run(full, 1) == [(1, 2)]
    assert run(full, 2) == [(1, 2), (1, 28)]
    assert run(full, 6) == [(1, m) for m in full]
    assert run((5, 40), 6) == [(1, 5), (1, 40)]
    assert run(full, 1, (1, 2)) == [(1, 2), (2, 2)]


@pytest.mark.parametrize("seed,n", [(1, 3), (2, 6)])
def test_decimation_of_crowded_hours(spark, seed, n):
    rng = random.Random(seed)
    rows = [(1, T0 + timedelta(seconds=rng.randrange(7200)), f"k{i:03d}") for i in range(60)]
    want = set()
    for hour in (T0, T0 + timedelta(hours=1)):
        left = [r for r in rows if hour <= r[1] < hour + timedelta(hours=1)]
        for i in range(n):
            mark = hour + timedelta(minutes=60 * i / n)
            if left:
                best = min(left, key=lambda r: (abs(r[1] - mark), r[1], r[2]))
                left.remove(best)
                want.add(best[2])
    df = spark.createDataFrame(rows, "band int, time timestamp_ntz, key string")
    assert {r.key for r in al.decimate(df, n, ["band"]).collect()} == want


def test_height_match_example(spark):
    day = datetime(2024, 5, 1)
    heights = spark.createDataFrame([(16, day.replace(hour=11, minute=59), "past"), (16, day.replace(hour=12, minute=9), "future")],
                                    "satellite int, end_time timestamp_ntz, height_id string")
    records = spark.createDataFrame([("a", 16, day.replace(hour=12)), ("b", 19, day.replace(hour=12)), ("c", 16, day.replace(hour=13))],
                                    "id string, satellite int, end_time timestamp_ntz")
    got = {r.id: (r.height_id, r.height_age_seconds) for r in al.height_match(records, heights).collect()}
    assert got == {"a": ("past", 60.0), "b": (None, None), "c": (None, None)}


def test_lookup_fails_without_an_observation(spark):
    obs = spark.createDataFrame([("v", T0)], "variable string, time timestamp_ntz")
    ask = spark.createDataFrame([("v", T0 + timedelta(hours=1))], "variable string, time timestamp_ntz")
    with pytest.raises(Exception, match="No observation"):
        al.latest_at(ask, obs, ["variable"], 10, strict=True).collect()
    assert al.latest_at(ask, obs, ["variable"], 60, strict=True).first().hit is not None


def test_hybrid_band_needs_one_grid(spark):
    one = spark.createDataFrame([(1, "a", "g1")], "k int, key string, grid_hash string")
    many = spark.createDataFrame([(1, "b", "g2"), (2, "c", "g2")], "k int, key string, grid_hash string")
    wanted = spark.createDataFrame([(2,)], "k int")
    assert al.hybrid_band(wanted, one, many, ["k"], "key").first().origin == "multiband"
    with pytest.raises(Exception, match="different grids"):
        al.hybrid_band(wanted.union(spark.createDataFrame([(1,)], "k int")), one, many, ["k"], "key").collect()


def test_tolerance_beyond_the_step_is_refused(spark):
    df = spark.createDataFrame([("a", "v", T0, T0, 900)], "asset_id string, variable string, time timestamp_ntz, end_time timestamp_ntz, tolerance_s int")
    with pytest.raises(Exception, match="tolerance"):
        al.causal_align(df, T0.isoformat(), (T0 + timedelta(hours=1)).isoformat()).filter(F.lit(True)).collect()
