"""Steps whose tables must not grow with the number of requests, and ties that must come out the same every time."""

from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries

from skyframe.operators import alignment as al
from skyframe.operators import forecasts as fc
from skyframe.operators import sequences as sq
from skyframe.operators import storms as st
from skyframe.plans.registry import QUERIES
from skyframe.sources import forecast_index as fi

EVENTS = "event_id string, start timestamp_ntz, end timestamp_ntz"
LISTING = "cycle timestamp_ntz, lead int, key string, etag string, size long, index_size long, modified timestamp_ntz"


def test_requests_of_overlapping_rows_are_distinct_and_shuffled_as_events(spark):
    day = datetime(2024, 8, 10)
    spans = [("E", 0, 3), ("E", 1, 2), ("E", 2, 6), ("E", 0, 3), ("F", 5, 5), ("F", 22, 30), (None, 1, 2)]
    events = spark.createDataFrame([(e, day + timedelta(hours=a), day + timedelta(hours=b)) for e, a, b in spans], EVENTS)
    asked = fc.forecast_requests(events, "2024-08-11T00:00:00")
    # The hours are listed after the only shuffle: no exchange stands above a generator.
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Generate") < plan.index("Exchange"), plan
    want = {(e, day + timedelta(hours=h), day + timedelta(hours=v)) for e, a, b in spans for h in range(a, b) for v in (h, h + 1) if v < 24}
    got = [tuple(r) for r in asked.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_judged_requests_do_not_grow_with_events(spark):
    day, cycle = datetime(2024, 8, 10), datetime(2024, 8, 9, 18)
    listing = spark.createDataFrame([(cycle, 7, "a", "e", 500, 1, cycle), (cycle, 8, "b", "e", 500, 1, cycle)], LISTING)
    records = spark.createDataFrame([(k, 0, 100, "PRES", "surface", f"{lead} hour fcst") for k, lead in (("a", 7), ("b", 8))],
                                    "key string, start long, stop long, field string, level string, descriptor string")

    def run(n):
        events = spark.createDataFrame([(f"E{i}", day + timedelta(hours=1), day + timedelta(hours=2)) for i in range(n)], EVENTS)
        requests = fc.forecast_requests(events, "2024-08-11T00:00:00")
        judged = fc.judged_requests(requests, listing)
        rows, pairs, gaps = fc.timely_rows(judged, records, fi.spec_table(spark, fi.CORE))
        covered = {r.event_id: r.covered_hours for r in fc.covered_hours(requests, pairs).collect()}
        members = fc.timely_forecasts(requests, listing, records, fi.spec_table(spark, fi.CORE))[1]
        assert covered == {f"E{i}": 1 for i in range(n)} and members.count() == 2 * n
        assert covered == {r.event_id: r.covered_hours for r in fc.event_coverage(members).collect()}
        return judged.count(), rows.count(), {r.reason: r.n for r in gaps.collect()}

    few, many = run(1), run(40)
    assert few[:2] == many[:2] and many[2]["missing-object-or-index"] == 40 * few[2]["missing-object-or-index"]
    assert many[2]["missing-or-ambiguous-field"] == few[2]["missing-or-ambiguous-field"] == 18


def test_equal_encounters_are_one_event(spark):
    """Both lie before the study, so that their clipped windows end before they begin; the frame of the SQL has peers."""
    at = datetime(2024, 1, 1, 2)
    rows = [("N", at, at + timedelta(hours=5)), ("N", at, at + timedelta(hours=5)), ("N", at + timedelta(hours=1), at + timedelta(hours=6))]
    spans = spark.createDataFrame(rows, "sid string, entry timestamp_ntz, exit timestamp_ntz")
    got = sorted((r.event_id, r.entry) for r in st.event_windows(spans, "2024-01-03T00:00:00", "2024-01-28T00:00:00").collect())
    assert got == [("N-2", at), ("N-3", at + timedelta(hours=1))]


def test_anchors_of_one_instant_are_scanned_once(spark, monkeypatch):
    day, scanned = datetime(2024, 1, 1), []
    monkeypatch.setattr(al, "asof_nearest", lambda left, *a, **k: scanned.append(left.count()) or sq.asof_nearest(left, *a, **k))
    anchors = spark.createDataFrame([(i, day, b) for i in range(30) for b in (1, 2, None)], "anchor_id int, anchor_time timestamp_ntz, band int")
    assets = spark.createDataFrame([(1, day + timedelta(seconds=60), "b"), (1, day - timedelta(seconds=60), "z"), (1, day - timedelta(seconds=60), "a"),
                                    (2, day + timedelta(seconds=91), "far"), (None, day, "n")], "band int, time timestamp_ntz, key string")
    got = sorted((r.anchor_id, r.band or 0, r.key, r.time) for r in al.nearest_peers(assets, anchors, ["band"]).collect())
    assert got == sorted(x for i in range(30) for x in ((i, 0, "n", day), (i, 1, "a", day - timedelta(seconds=60))))
    assert scanned == [3]


def test_what_follows_is_found_in_linear_time(spark):
    """Frames up to the key's end cost the square of a key's rows: 60,000 rows of one key in one range."""
    rows = spark.range(60_000).select(F.lit(1).alias("k"), F.col("id").alias("at"), F.when(F.col("id") % 20_000 == 19_999, F.col("id")).alias("v"))
    for bounded in (False, True):
        found = sq.with_neighbours(rows, ["k"], ["at"], "v", None, "next", bounded=bounded, parts=1)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "unboundedfollowing" not in plan.lower(), plan
        assert [tuple(r) for r in found.groupBy("next").count().orderBy("next").collect()] == [(19_999, 20_000), (39_999, 20_000), (59_999, 20_000)]


def test_rain_of_equal_values_is_that_of_the_first_observation(spark, tmp_path):
    at = datetime(2024, 1, 1, 0, 59, 30)
    kinds = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    for order in (1, -1):
        folder = str(tmp_path / f"t{order}")
        events = [(i, at, 1, "view", v, '{"k": %d}' % k) for i, v, k in ((3, 5.0, 30), (4, 5.0, 90), (5, 5.0, 60), (6, 1.0, 70), (7, None, 99))][::order]
        spark.createDataFrame(events, kinds).coalesce(1).write.parquet(f"{folder}/events.parquet")
        customers = [(0, "c", 0, 1.0, "m")]
        spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
        got = [tuple(r) for r in QUERIES["j14_rain_context"](spark, folder).collect()]
        assert got == [("S0", 1, 0.3, 5.0)]


def test_hours_of_few_events_are_listed_by_many_tasks(spark):
    start = datetime(2024, 8, 10)
    events = spark.createDataFrame([(f"E{i}", start, start + timedelta(hours=2)) for i in range(50)], EVENTS).coalesce(1)
    frames = fc.sample_times(fc.event_hours(events).select("event_id", "hour"))
    assert frames.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = {tuple(r) for r in frames.collect()}
    assert got == {(f"E{i}", start + timedelta(hours=h), start + timedelta(hours=h, minutes=10 * m)) for i in range(50) for h in (0, 1) for m in range(-5, 7)}


def test_channel_sizes_are_not_held_in_one_buffer(spark, monkeypatch):
    monkeypatch.setattr(F, "percentile", lambda *a: (_ for _ in ()).throw(AssertionError("a group's values in one buffer")))
    records = spark.createDataFrame([(f"k{i}", 1, 0, i, "PRES", "surface", "1 hour fcst") for i in range(1, 102)],
                                    "key string, lead int, start long, stop long, field string, level string, descriptor string")
    got = fc.channel_summary(records, fi.spec_table(spark, fi.CORE), ["key"]).filter("name = 'surface_pressure'").first()
    assert (got.samples, got.ambiguous, got.p10, got.median, got.p90) == (101, 0, 11.0, 51.0, 91.0)
    sizes = records.withColumn("bytes", F.col("stop"))
    assert fc.message_medians(sizes, ["field"], ["bytes"]).first().median_bytes == 51.0


def test_cuts_of_lines_are_not_evaluated_edge_by_edge_in_the_plan(spark):
    """An expression that walks some hundred edges for every row ran for minutes on a hundred thousand rows."""
    rows = spark.range(200_000).select(
        F.col("id").cast("string").alias("sid"), F.lit(datetime(2024, 8, 10)).cast("timestamp_ntz").alias("time_a"), (-73 + F.col("id") % 1300 / 100).alias("lon_a"),
        (F.lit(23.0) + F.col("id") % 150 / 100).alias("lat_a"))
    points = rows.select("sid", "time_a", F.col("time_a").alias("time"), "lon_a", "lat_a", F.col("lon_a").alias("lon_b"), F.col("lat_a").alias("lat_b"),
                         F.col("time_a").alias("lo"), F.col("time_a").alias("hi"), F.lit(0.0).alias("f0"), F.lit(1.0).alias("f1"))
    met = st.encounters(points)
    assert "lambdafunction" not in met.select("edge_km")._jdf.queryExecution().executedPlan().toString()
    assert met.agg(F.count("edge_km").alias("n"), F.min("edge_km").alias("km")).first().n == 200_000


def test_cuts_of_a_square_by_hand():
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    edges = np.array([(*p, *q) for p, q in zip(square, square[1:])])
    lines = np.array([(-2, 1, 6, 1), (1, 1, 2, 2), (6, 1, 6, 3), (7, 8, 7, 8), (3, 3, 3, 7), (np.nan, 1, 2, 2)], float)
    rows, shares, starts_in, gap = st.outline_cuts(np.concatenate([lines] * 200), np.array(edges))
    assert list(zip(rows[:3].tolist(), shares[:3].tolist())) == [(0, 0.25), (0, 0.75), (4, 0.25)] and len(rows) == 600
    assert starts_in[:5].tolist() == [False, True, False, False, True] and starts_in.sum() == 400
    assert np.isnan(gap[[0, 1, 4]]).all() and gap[[2, 3]].tolist() == [2.0, 5.0]


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_texts_are_made_behind_the_shuffle_and_rows_are_dealt_once(spark, monkeypatch):
    from skyframe.plans import q_sources, standins

    folder, before = "/root/testdata/sf0.001", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = standins.assets(spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "concat_ws" not in plan[plan.index("Exchange"):], plan
        assert _shuffles(q_sources._manifests(spark, folder)) == 3
        most = {"s06_selected_archives": 4, "s07_observation_index": 3, "u01_merge_fetch_runs": 1, "u06_adoption_audit": 7, "f11_confirmed_issues": 6, "u09_task_completion": 8}
        assert {n: c for n, c in ((n, _shuffles(QUERIES[n](spark, folder))) for n in most) if c > most[n]} == {}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_manifests_are_stored_compressed(spark):
    from skyframe.plans import q_sources

    assert all(f.endswith(".json.gz") for f in spark.read.text(q_sources._stored_manifests(spark, "/root/testdata/sf0.001")).inputFiles())


def test_two_different_completed_runs_fail_wherever_they_stand(spark):
    import pytest

    from skyframe.operators import merges as mg

    rows = lambda *r: spark.createDataFrame(list(r), "run_id long, status string, wall_seconds double")
    one, two = rows((1, "complete", 5.0), (2, "partial", 9.0), (None, "partial", 1.0)), rows((1, "complete", 5.0), (2, "complete", None))
    assert sorted(map(tuple, mg.merge_fetch_runs([one, two]).collect())) == [(1, "complete", 5.0), (2, "complete", None)]
    with pytest.raises(Exception, match="Conflicting completed fetch run"):
        mg.merge_fetch_runs([one, two, rows((1, "complete", 4.0))]).collect()


def test_adoption_of_assets_in_one_store_only(spark):
    from skyframe.operators import merges as mg

    rows = lambda *r: spark.createDataFrame(list(r), "asset_id string, content string")
    wanted = rows(("a", "x"), ("b", "x"), ("b", "y"), ("c", "z"), (None, "n"))
    got = mg.adoption_audit(wanted, rows(("a", "x"), ("z", "x"), (None, "q")), rows(("a", "x"), ("b", "y"), ("b", "y"), (None, "r")))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", "already_shared", 1), ("b", "moved", 1), ("c", "not_present", 0), (None, "not_present", 0)], key=str)


def test_a_task_reads_one_range_of_an_ordered_scan(spark):
    """Hashes of the ranges' numbers collide: of 16 ranges some tasks had several and others none."""
    rows = spark.range(4000).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"))
    dealt = sq._scan(rows, ["k"], ["at"], 16)[1]
    held = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("_block").alias("n")).collect()
    assert len(held) > 12 and {r.n for r in held} == {1}
    scanned = sq.with_ordinal(rows, ["k"], ["at"], parts=16)
    assert scanned.filter("ordinal <> (at - k) div 3").count() == 0


def test_scans_of_few_series_are_not_dealt_by_series(spark, monkeypatch):
    import pytest

    from skyframe.operators import inventory as iv

    plans, keep = [], sq.written
    monkeypatch.setattr(sq, "written", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df, name))
    at, kinds = datetime(2024, 1, 1), "product string, time timestamp_ntz, grid_hash string, images array<struct<band: int, origin: string, size: long>>"
    scans = [(p, at + timedelta(hours=h), "g", [(b, f"{p}{h}", 1) for b in (1, 2)]) for p in ("x", "y", None) for h in (2, 0, 1)]
    got = iv.band_sequences(spark.createDataFrame(scans, kinds), ["product"]).select("product", "band", "origin", "scan_index").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((p, b, f"{p}{h}", h) for p in ("x", "y", None) for b in (1, 2) for h in range(3)), key=str)
    assert "SortMergeJoin" not in plans[0] and "HashJoin" not in plans[0], plans[0]
    with pytest.raises(Exception, match="grid changed"):
        iv.band_sequences(spark.createDataFrame([*scans, ("x", at, "h", [(1, "o", 1)])], kinds), ["product"]).collect()


def test_what_is_told_of_an_asset_is_shuffled_once(spark):
    from skyframe.operators import inventory as iv

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        place = "product string, asset_id string, satellite int, month string, band int"
        selected = spark.createDataFrame([(p, a, 16, "2024-01", 1) for p, a in (("P", "a"), ("P", "b"), ("P", "b"), ("P", "c"), ("Q", "c"), ("P", "d"), ("P", "e"), ("Q", "x"))], place)
        archived = spark.createDataFrame([("P", "a", 16, "2024-01", 1, "2", "corrupt_source"), ("P", "a", 16, "2024-01", 1, "1", "saved"), ("P", "b", 16, "2024-01", 1, "1", "saved"),
                                          ("Q", "z", 17, "2024-02", 2, "1", "saved")], f"{place}, path string, status string")
        points = spark.createDataFrame([("P", ["c", "d"], 1, 5), (None, ["c", "e", "x"], 2, 9), (None, ["x"], 2, 7), ("R", ["d"], 1, 3)],
                                       "product string, asset_ids array<string>, next_index int, stamp long")
        found = iv.progress_states(selected, archived, points)
        assert _shuffles(found) == 2
        got = {(r.product, r.satellite): tuple(r)[4:] for r in found.collect()}
        assert got == {("P", 16): (5, 1, 1, 2, 1, 9, 80.0, "in_progress"), ("Q", 16): (2, 0, 0, 1, 1, 9, 50.0, "in_progress"), ("Q", 17): (1, 1, 0, 0, 0, None, 100.0, "complete")}
        # The rows of an order stay where the join of its lines put them.
        assert _shuffles(QUERIES["a38_member_source_bytes"](spark, "/root/testdata/sf0.001")) <= 15
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_measurements_are_parsed_once_a_level(spark):
    from skyframe.operators import reports as rp

    payloads = ['{"wall_s": null, "method": "a", "band": 3}', '{"rows": [{"summary": {"wall_s": 1, "method": "b"}, "wall_s": 9}, {"s\\u0075mmary": {"wall_s": 2}}, {"summary": null, "wall_s": 9}, "x", 5]}',
                '{"wall_seconds": 4, "rows": 7, "evidence": [{"rows": [{"download_seconds": 3, "stage": "deep"}]}], "summary": {"wall_s": 9}}', "not json", '{"band": 1}', None]
    rows = rp.measurement_rows(spark.createDataFrame([("k", p) for p in payloads], "kind string, payload string"))
    got = [(r.scope, r.method, r.band, r.wall_s, r.wall_seconds, r.download_seconds) for r in rows.collect()]
    assert sorted(got, key=str) == sorted([("k:", "a", 3, None, None, None), ("k:", "b", None, 1.0, None, None), ("k:", None, None, 2.0, None, None),
                                           ("k:", None, None, None, 4.0, None), ("k:deep", None, None, None, None, 3.0)], key=str)
    # The fields lie in the written levels: what comes out parses nothing again.
    assert "from_json" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_band_sequences_write_no_images(spark, monkeypatch):
    """All images of all scans were shuffled twice and written in between."""
    from skyframe.operators import inventory as iv

    tables, keep = [], sq.written
    monkeypatch.setattr(sq, "written", lambda df, name: tables.append(keep(df, name)) or tables[-1])
    at, kinds = datetime(2024, 1, 1), "product string, time timestamp_ntz, grid_hash string, images array<struct<band: int, origin: string, size: long>>"
    scans = [(p, at + timedelta(hours=h), "g", [(b, f"{p}{h}/{b}", h) for b in (1, 2, 3)]) for p in ("x", "y") for h in range(300)]
    got = iv.band_sequences(spark.createDataFrame(scans, kinds).repartition(4), ["product"])
    assert got.columns == ["product", "time", "available_bands", "band", "origin", "size", "scan_index"]
    assert sorted(map(tuple, got.collect())) == sorted((p, at + timedelta(hours=h), 3, b, f"{p}{h}/{b}", h, h) for p in ("x", "y") for h in range(300) for b in (1, 2, 3))
    assert sum(t.count() for t in tables) < 100, [(t.columns, t.count()) for t in tables]
