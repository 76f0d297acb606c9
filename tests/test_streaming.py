import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyframe.streaming import ingest as ig
from skyframe.streaming import rates as rt

MB = 1_000_000


def _snapshots(spark, rows):
    return spark.createDataFrame(rows, rt.SNAPSHOT)


def _watch(spark, root, *batches):
    """Each batch is one arrival of files and one run of the stream."""
    for rows in batches:
        _snapshots(spark, rows).write.mode("append").json(f"{root}/in")
        stream = rt.watch_rates(ig.read_folder(spark, f"{root}/in", rt.SNAPSHOT))
        ig.drain(stream, f"{root}/ck", lambda df, i: df.write.mode("overwrite").parquet(f"{root}/out/batch={i}"), mode="update")
    out = spark.read.parquet(f"{root}/out")
    return {(r.task_id, r.snapshot_at): (r.elapsed_seconds, r.average_mbps) for r in out.collect()}


def test_watch_window_over_several_runs(spark, tmp_path):
    got = _watch(
        spark, tmp_path,
        [("all", "a", "r1", "fetching", 100 * MB, None, 0.0), ("all", "q", "r1", "queued", 5, None, 0.0)],
        [("all", "a", "r1", "fetching", 110 * MB, None, 10.0), ("all", "done", "r1", "complete", 9, None, 10.0)],
        [("all", "a", "r1", "complete", 120 * MB, None, 20.0), ("all", "a", "r1", "complete", 120 * MB, None, 90.0)],
        [("all", "a", "r2", "fetching", 3 * MB, None, 100.0)])
    assert got == {("a", 0.0): (0.0, None), ("a", 10.0): (10.0, 8.0), ("a", 20.0): (20.0, 8.0), ("a", 90.0): (20.0, 8.0), ("a", 100.0): (0.0, None)}


def _tasks(at, **counters):
    return [("all", name, "r", "fetching", value * MB, start, at) for name, (value, start) in counters.items()]


def test_bandwidth_sums_steps_and_resets(spark, tmp_path):
    first = _tasks(0.0, a=(100, 0.0), b=(50, 0.0)) + _tasks(10.0, a=(110, 0.0), b=(70, 0.0))
    later = _tasks(20.0, a=(120, 0.0), b=(95, 0.0), c=(5, 15.0))

    def batch(rows):
        return rt.recent_bandwidth(rt.interval_parts(rt.counter_steps_batch(_snapshots(spark, rows)))).first()

    row = batch(first)
    assert (row.intervals, row.recent_average_mbps, row.recent_median_mbps) == (1, 24.0, 24.0)
    row = batch(first + later)
    assert (row.intervals, row.recent_average_mbps, row.recent_median_mbps) == (2, 28.0, 28.0)
    unknown = batch(first + _tasks(20.0, a=(120, 0.0), b=(95, 0.0), c=(5, 5.0)))
    assert unknown.intervals == 0 and unknown.recent_average_mbps is None
    shrunk = batch(first + _tasks(20.0, a=(1, 0.0), b=(95, 0.0)) + _tasks(30.0, a=(11, 0.0), b=(95, 0.0)))
    assert (shrunk.intervals, shrunk.recent_average_mbps) == (1, 8.0)
    assert batch(first + _tasks(20.0, a=(120, 0.0))).intervals == 0  # b vanished

    for i, rows in enumerate((first, later)):
        _snapshots(spark, rows).write.mode("append").json(f"{tmp_path}/in")
        ig.bandwidth_intervals(ig.read_folder(spark, f"{tmp_path}/in", rt.SNAPSHOT), f"{tmp_path}/parts", f"{tmp_path}/ck")
    streamed = rt.recent_bandwidth(spark.read.parquet(f"{tmp_path}/parts").drop("batch")).first()
    assert (streamed.intervals, streamed.recent_average_mbps, streamed.recent_median_mbps) == (2, 28.0, 28.0)
    runs = spark.createDataFrame([("r", 0.0, 10.0)], "run_id string, run_started_at double, run_until double")
    assert rt.run_average(_snapshots(spark, first), runs).first().run_average_mbps == pytest.approx(144.0)


def test_rerun_of_a_batch_replaces_it(spark, tmp_path):
    rows = spark.range(10).withColumn("v", F.col("id") * 2)
    write = ig.batch_writer(f"{tmp_path}/out", ["id", "v"])
    write(rows, 0)
    write(rows, 0)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 10


def test_display_status(spark):
    tasks = spark.createDataFrame(
        [("a", "run", "checkpointed", "s", "p", "m", 4, 4, 9.0), ("b", "run", "fetching", "s", "p", "m", 4, 1, 1.0), ("c", "dead", "fetching", "s", "p", "n", 4, 1, None),
         ("d", "dead", "fetching", "s", "p", "m", 4, 1, None), ("e", "dead", "complete", "s", "p", "m", 4, 4, None)],
        "task_id string, run_id string, status string, source string, product string, month string, selected long, checkpointed long, attempt_started_at double")
    runs = spark.createDataFrame([("run", "running", 5.0, True), ("dead", "failed", 1.0, False)], "run_id string, run_status string, run_started_at double, process_alive boolean")
    got = {r.task_id: r.display_status for r in rt.display_status(tasks, runs).collect()}
    assert got == {"a": "unpublished", "b": "waiting", "c": "failed", "d": "waiting", "e": "complete"}


def test_month_twice_in_the_state_fails(spark, tmp_path):
    rows = spark.createDataFrame([("RadarQualityIndex_00.00", 0.5, 1, "2022-01", 1, True), ("RadarQualityIndex_00.00", 0.5, 1, "2022-02", 1, False)],
                                 "product string, raw double, bitmap int, month string, cell long, month_complete boolean")
    write = ig.month_writer(f"{tmp_path}/state")
    write(rows, 0)
    assert [(r.cell, r.rqi_count) for r in ig.year_cells(spark, f"{tmp_path}/state").collect()] == [(1, 1)]
    write(rows, 1)
    with pytest.raises(Exception, match="twice"):
        ig.year_cells(spark, f"{tmp_path}/state").collect()


def test_listings_survive_retries_and_late_scans(spark, tmp_path):
    """A second listing of a scan adds nothing, a newer processing does, and an old scan may come last."""
    schema = "asset_id string, scan string, key string"
    batches = [[("a", "2024-03-01", "k2"), ("a", "2024-03-01", "k2"), ("b", "2024-03-01", "k1")], [("a", "2024-03-01", "k2"), ("c", "2024-01-01", "k0")], [("d", "2024-03-01", "k3"), ("e", None, "k9")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = ig.newer_listings(ig.read_folder(spark, f"{tmp_path}/in", schema, "parquet"), ["scan"])
        write = ig.folder_writer(f"{tmp_path}/archive")
        ig.drain(stream, f"{tmp_path}/checkpoint", lambda df, n: (write(df, n), write(df, n)), mode="update")
    held = spark.read.parquet(f"{tmp_path}/archive")
    assert sorted(r.asset_id for r in held.collect()) == ["a", "c", "d", "e"]
    assert {r.scan: r.key for r in ig.current_listing(spark, f"{tmp_path}/archive", ["scan"]).collect()} == {"2024-01-01": "k0", "2024-03-01": "k3"}  # a scan without a time has no newest


def _watch_loop(rows, state):
    """Plain rule, one snapshot after the other."""
    out = []
    for run, status, count, at in rows:
        if state is None and status == "complete":
            continue
        if state is None or state[0] != run or count < state[3] or (state[5] and status not in rt.ENDED):
            state = (run, at, count, count, at, False)
        if not state[5]:
            state = (*state[:3], count, at, status in rt.ENDED)
        elapsed = max(0.0, state[4] - state[1])
        out.append((at, elapsed, (state[3] - state[2]) * 8 / elapsed / 1e6 if elapsed > 0 else None))
    return out, state


def test_watch_windows_follow_the_plain_rule():
    chance = random.Random(5)
    for _ in range(400):
        known = wanted = None
        for _ in range(3):
            at, rows = chance.randint(0, 3), []
            for _ in range(chance.randint(0, 9)):
                at += chance.randint(1, 5)
                rows.append((chance.choice("rs"), chance.choice(["fetching", "complete", "paused", "running"]), chance.randint(0, 6), float(at)))
            want, wanted = _watch_loop(rows, wanted)
            frame = pd.DataFrame(rows, columns=["run_id", "status", "read_bytes", "snapshot_at"]).astype(
                {"run_id": "category", "status": "category", "read_bytes": "int64", "snapshot_at": "float64"})
            got, known = rt.watch_windows(frame, known)
            assert known == wanted
            shown = [(a, e, None if pd.isna(r) else r) for a, e, r in got[["snapshot_at", "elapsed_seconds", "average_mbps"]].itertuples(index=False)]
            assert shown == [(a, e, pytest.approx(r) if r is not None else None) for a, e, r in want]


def test_many_snapshots_of_one_task_stay_small():
    """The arrays of a batch, not a Python object for every snapshot."""
    n = 2_000_000
    chunks = (pd.DataFrame({"run_id": "r", "status": "fetching", "read_bytes": np.arange(i, i + 100_000), "snapshot_at": np.arange(i, i + 100_000, dtype="float64"), "started_at": 0.0})
              for i in range(0, n, 100_000))
    rows = rt._in_order(chunks, ["run_id", "status"])
    assert rows.memory_usage(deep=True).sum() < 40 * n
    out, state = rt.watch_windows(rows, None)
    assert state == ("r", 0.0, 0, n - 1, float(n - 1), False) and len(out) == n
    assert rt.counter_changes(rows, (-1.0, -5))["change"].iloc[0] == 5


def test_batch_and_stream_agree_on_a_task_first_seen_complete(spark, tmp_path):
    rows = [("all", "a", "r", "complete", 5 * MB, None, 0.0), ("all", "a", "r", "fetching", 6 * MB, None, 10.0), ("all", "a", "r", "complete", 7 * MB, None, 20.0), ("all", "b", "r", "complete", 7, None, 20.0)]
    streamed = _watch(spark, tmp_path, rows)
    batch = {(r.task_id, r.snapshot_at): (r.elapsed_seconds, r.average_mbps) for r in rt.watch_rates_batch(_snapshots(spark, rows)).collect()}
    assert streamed == batch == {("a", 10.0): (0.0, None), ("a", 20.0): (10.0, 0.8)}


def test_a_month_in_three_batches_with_a_rerun(spark, tmp_path):
    schema = "product string, raw double, bitmap int, month string, cell long, month_complete boolean"
    quality = "RadarQualityIndex_00.00"
    batches = [[(quality, 0.5, 1, "2022-01", 1, False), (quality, 0.25, 1, "2022-02", 1, False)], [(quality, 0.75, 1, "2022-01", 1, False)],
               [(quality, 1.0, 1, "2022-01", 2, False), (quality, None, 0, "2022-01", None, True)]]
    write = ig.month_writer(f"{tmp_path}/state")
    for i, rows in enumerate(batches):
        write(spark.createDataFrame(rows, schema), i)
        if i < 2:
            assert ig.year_cells(spark, f"{tmp_path}/state").collect() == []
    for i in (1, 2):
        write(spark.createDataFrame(batches[i], schema), i)  # both run again
    want = [(1, 1.25, 2), (2, 1.0, 1)]
    assert sorted((r.cell, r.rqi_sum, r.rqi_count) for r in ig.year_cells(spark, f"{tmp_path}/state").collect()) == want
    write(spark.createDataFrame(batches[1], schema), 3)  # rows of a month that is closed
    with pytest.raises(Exception, match="twice"):
        ig.year_cells(spark, f"{tmp_path}/state").collect()


def test_listings_need_no_python_worker(spark, tmp_path):
    spark.createDataFrame([("a", "s", "k")], "asset_id string, scan string, key string").write.parquet(f"{tmp_path}/in")
    stream = ig.newer_listings(ig.read_folder(spark, f"{tmp_path}/in", "asset_id string, scan string, key string", "parquet"), ["scan"])
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "max_by" in plan


def test_tasks_of_one_bucket_do_not_meet():
    """Many tasks in one call, with names and runs that may be null, give what each gives on its own; so do their states."""
    chance, kinds = random.Random(9), {"read_bytes": "int64", "snapshot_at": "float64"}
    for _ in range(150):
        names, own_window, own_last = ["a", "b", "c", None], {}, {}
        windows, newest = rt._state(rt.WINDOWS, []), rt._state(rt.NEWEST, [])
        for _ in range(3):
            told = [("all", chance.choice(names), chance.choice(["r", "s", None]), chance.choice(["fetching", "complete", "paused"]), chance.randint(0, 6), float(chance.randint(0, 30)), 0.0)
                    for _ in range(chance.randint(0, 14))]
            rows = pd.DataFrame(told, columns=["scope", "task_id", "run_id", "status", "read_bytes", "snapshot_at", "started_at"]).astype(
                {**kinds, "started_at": "float64", **{c: "category" for c in ("scope", "task_id", "run_id", "status")}})
            rows = rows.sort_values("snapshot_at", kind="stable", ignore_index=True)
            got, windows = rt.watch_tasks(rows, windows)
            steps, newest = rt.task_changes(rows, newest)
            for name in names:
                mine = rows["task_id"].isna() if name is None else rows["task_id"] == name
                want, own_window[name] = rt.watch_windows(rows[mine].reset_index(drop=True), own_window.get(name))
                same = got["task_id"].isna() if name is None else got["task_id"] == name
                shown = ["snapshot_at", "elapsed_seconds", "average_mbps"]
                np.testing.assert_array_equal(got[same][shown].to_numpy("float64"), want[shown].to_numpy("float64"))
                for run in ("r", "s", None):
                    here = mine & (rows["run_id"].isna() if run is None else rows["run_id"] == run)
                    mine_too = (steps["task_id"].isna() if name is None else steps["task_id"] == name) & (steps["run_id"].isna() if run is None else steps["run_id"] == run)
                    last, want = own_last.get((name, run)), []
                    for r in rows[here].itertuples():
                        if last is None or r.snapshot_at > last[0]:
                            want.append((r.snapshot_at, last and last[0], r.read_bytes, last and r.read_bytes - last[1]))
                            last = (r.snapshot_at, r.read_bytes)
                    own_last[name, run] = last
                    found = steps[mine_too][["snapshot_at", "prev_at", "bytes", "change"]].astype(object)
                    assert [tuple(None if pd.isna(x) else x for x in r) for r in found.itertuples(index=False)] == want
        for name, state in own_window.items():
            held = windows[windows["task_id"].isna() if name is None else windows["task_id"] == name]
            assert len(held) == (state is not None)
            assert state is None or tuple(None if pd.isna(x) else x for x in held.iloc[0].tolist()[1:-1]) == state


def test_one_call_serves_the_tasks_of_a_bucket(monkeypatch):
    """Calls of a stream's processor are per bucket, however many tasks there are; silent ones lose their state."""
    class Held:
        value = None
        exists, get = (lambda self: self.value is not None), (lambda self: self.value)

        def update(self, value):
            self.value = value

    class Clock:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentProcessingTimeInMs(self):
            return self.ms

    processor = rt.WatchProcessor(expire_days=1)
    processor.held = Held()

    def run(at, ms, tasks):
        rows = pd.DataFrame({"bucket": 1, "scope": "all", "task_id": tasks, "run_id": "r", "status": "fetching", "read_bytes": int(at), "started_at": 0.0, "snapshot_at": at})
        return {r.task_id: r.elapsed_seconds for part in processor.handleInputRows((1,), iter([rows]), Clock(ms)) for r in part.itertuples()}

    assert len(run(0.0, 0, [f"t{i}" for i in range(5000)])) == 5000
    assert run(10.0, rt.DAY_MS - 1, ["t1"]) == {"t1": 10.0}
    assert run(20.0, rt.DAY_MS, ["t1", "t2"]) == {"t1": 20.0, "t2": 0.0}


def test_streams_deal_tasks_into_buckets(spark, tmp_path):
    spark.createDataFrame([], rt.SNAPSHOT).write.json(f"{tmp_path}/in")
    for steps in (rt.watch_rates, rt.counter_steps):
        plan = steps(ig.read_folder(spark, f"{tmp_path}/in", rt.SNAPSHOT))._jdf.queryExecution().analyzed().toString()
        assert "TransformWithStateInP" in plan and "bucket" in plan, plan
