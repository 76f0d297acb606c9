import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyframe.functions import geo
from skyframe.operators import grid as gr
from skyframe.operators import storms as st
from skyframe.operators import studies as sd


def _two_by_two(spark, valid):
    targets = spark.createDataFrame([(0, 0.5, 0.5, True), (1, 5.0, 0.5, True)], "target_cell long, tx double, ty double, inside boolean")
    axis = gr.axis_table(spark, [0.0, 1.0])
    mapping = gr.interpolation_map(targets, axis, axis, 2, 2)
    frames = spark.createDataFrame([("f", "g", [0.0, 10.0, 20.0, 30.0], valid, [4, 5, 6, 7], [0, 0, 0, 0])],
                                   "frame string, grid_id string, values array<float>, valid array<boolean>, quality array<int>, classes array<int>")
    return mapping, frames


@pytest.mark.parametrize("valid,want", [([True] * 4, 15.0), ([True, True, False, True], None)])
def test_two_by_two_regrid(spark, valid, want):
    mapping, frames = _two_by_two(spark, valid)
    row = gr.regrid_frames(frames, gr.pack_map(mapping, "g")).first()
    assert row["values"] == [want, None] and row["valid"] == [want is not None, False]
    assert row["quality"][0] in (4, 5, 6, 7) and row["source_support"] == [True, False]
    long = gr.regrid_long(gr.long_pixels(frames, ["frame"]), gr.sparse_map(mapping), ["frame"]).orderBy("target_cell").first()
    assert long["value"] == want and long["quality"] == row["quality"][0]


def test_missing_source_cell_is_not_support(spark):
    mapping, frames = _two_by_two(spark, [True] * 4)
    three = gr.long_pixels(frames, ["frame"]).filter("source_cell <> 3")
    assert gr.regrid_long(three, gr.sparse_map(mapping), ["frame"]).filter("target_cell = 0").first().valid is False


def test_axes_must_be_monotonic(spark):
    points = spark.createDataFrame([(0, 0.5, True)], "target_cell long, tx double, inside boolean")
    with pytest.raises(Exception, match="monotonic"):
        gr.fractional_index(points, gr.axis_table(spark, [0.0, 2.0, 1.0]), "tx", "i").collect()
    down = gr.fractional_index(points, gr.axis_table(spark, [2.0, 1.0, 0.0]), "tx", "i").first()
    assert down.i == 1.5


def test_grid_shapes_and_projection(spark):
    assert [gr.grid_shape(km) for km in (1, 2, 3)] == [(864, 840), (432, 420), (288, 280)]
    cells = gr.target_grid(spark, 3)
    cone = geo.regional_lambert()
    x, y = cone.forward_columns(F.col("lon"), F.col("lat"))
    worst = cells.agg(F.max(F.abs(x - F.col("x_m"))).alias("x"), F.max(F.abs(y - F.col("y_m"))).alias("y"), F.count_if("inside").alias("n")).first()
    assert worst.x < 1e-3 and worst.y < 1e-3 and 0 < worst.n < 288 * 280
    assert cone.forward(-66.4, 18.2) == pytest.approx((0.0, 0.0), abs=1e-6)
    # On a standard parallel the scale is true: one arc-second along it has its ground length.
    for lat in (15.0, 21.0):
        step = 1 / 3600
        (x0, y0), (x1, y1) = cone.forward(-66.4, lat), cone.forward(-66.4 + step, lat)
        ground = geo.SEMI_MAJOR / math.sqrt(1 - geo.ECC2 * math.sin(math.radians(lat)) ** 2) * math.cos(math.radians(lat)) * math.radians(step)
        assert math.hypot(x1 - x0, y1 - y0) == pytest.approx(ground, rel=1e-7)


def test_view_angles_of_the_published_example(spark):
    """Worked example of the public fixed-grid definition: x -0.024052, y 0.095340 <-> -84.690932, 33.846162."""
    df = spark.createDataFrame([(-0.024052, 0.095340)], "x double, y double")
    lon, lat = geo.view_to_lonlat(F.col("x"), F.col("y"), -75.0, 35786023.0, 6378137.0, 6356752.31414)
    row = df.select(lon.alias("lon"), lat.alias("lat")).first()
    assert (row.lon, row.lat) == (pytest.approx(-84.690932, abs=1e-5), pytest.approx(33.846162, abs=1e-5))
    x, y = geo.lonlat_to_view(F.lit(-84.690932), F.lit(33.846162), -75.0, 35786023.0, 6378137.0, 6356752.31414)
    row = df.select(x.alias("x"), y.alias("y")).first()
    assert (row.x, row.y) == (pytest.approx(-0.024052, abs=1e-6), pytest.approx(0.095340, abs=1e-6))
    off = df.select(geo.view_to_lonlat(F.lit(0.2), F.lit(0.2), -75.0, 35786023.0)[0].alias("lon")).first()
    assert off.lon is None


def test_parallax_moves_towards_the_satellite(spark):
    df = spark.createDataFrame([(-66.0, 18.0, 0.0), (-66.0, 18.0, 12000.0)], "lon double, lat double, h double")
    rows = geo.with_parallax(df, "lon", "lat", "h", -75.2, 35786023.0, "lon2", "lat2").orderBy("h").collect()
    assert (rows[0].lon2, rows[0].lat2) == (pytest.approx(-66.0, abs=1e-9), pytest.approx(18.0, abs=1e-9))
    assert rows[1].lon2 < -66.0 and rows[1].lat2 < 18.0
    km = math.hypot((rows[1].lon2 + 66) * 111.32 * math.cos(math.radians(18)), (rows[1].lat2 - 18) * 110.57)
    # Height times the tangent of the view zenith angle, about 23 degrees here.
    assert 4.0 < km < 6.5


def test_boxes():
    west, south, east, north = geo.grow_box((-70.0, 14.0, -62.0, 22.0), 110)
    assert (south, north) == (13.0, 23.0) and west == pytest.approx(-70 - 1 / math.cos(math.radians(22)))
    options = geo.region_options()
    assert options["linear_200"][2] - options["linear_200"][0] == pytest.approx(2 * (geo.REGION[2] - geo.REGION[0]))
    assert options["east_to_60w"][2] == -60.0


def _tracks(spark, rows):
    return spark.createDataFrame(rows, "SID string, NAME string, TRACK_TYPE string, ISO_TIME string, USA_LAT string, USA_LON string")


def test_crossing_nearby_and_spur_tracks(spark):
    rows = [
        ("A1", "ALPHA", "main", "2024-08-10 00:00:00", "18.0", "-62.0"), ("A1", "ALPHA", "main", "2024-08-10 06:00:00", "18.0", "-63.5"),
        ("B1", "", "main", "2024-08-11 00:00:00", "22.5", "294.0"), ("C1", "GAMMA", "spur", "2024-08-12 00:00:00", "18.0", "-66.0"),
        ("D1", "DELTA", "main", "2024-08-12 00:00:00", "40.0", "-66.0"), ("E1", "BAD", "main", "2024-08-12 00:00:00", "x", "-66.0"),
    ]
    fixes = st.track_fixes(_tracks(spark, rows))
    events, nearby = st.select_events(fixes, "2024-08-01T00:00:00", "2024-09-01T00:00:00")
    event = events.collect()
    assert [(e.event_id, e.name) for e in event] == [("A1-1", "ALPHA")]
    # -62.56 is reached 0.56/1.5 into six hours; padded by 12 h before and 24 h after, to whole hours.
    assert abs(event[0].entry - datetime(2024, 8, 10, 2, 14, 24)) < timedelta(minutes=2)
    assert (event[0].start, event[0].end) == (datetime(2024, 8, 9, 14), datetime(2024, 8, 11, 6))
    near = nearby.collect()
    assert [r.sid for r in near] == ["B1"] and near[0].name == "B1" and 45 < near[0].distance_to_region_km < 56


def test_plane_encounters_against_sampling(spark):
    rng = random.Random(5)
    t0 = datetime(2024, 8, 1)
    rows = []
    for i in range(60):
        for j in range(2):
            rows.append((f"S{i}", "N", "main", (t0 + timedelta(hours=6 * j)).strftime("%Y-%m-%d %H:%M:%S"), f"{rng.uniform(12, 24):.3f}", f"{rng.uniform(-73, -60):.3f}"))
    settled, bad = st.settled_fixes(st.track_fixes(_tracks(spark, rows)), "2024-07-01T00:00:00", "2024-09-01T00:00:00")
    met = st.encounters(st.track_segments(settled, bad, "2024-07-01T00:00:00", "2024-09-01T00:00:00"))
    got = {r.sid: sum((s.exit - s.entry).total_seconds() for s in r.spans) / 21600 for r in met.collect()}
    west, south, east, north = geo.REGION
    outline = np.array(st.outline())
    for i in range(60):
        pair = [r for r in rows if r[0] == f"S{i}"]
        a, b = (geo.local_plane_point(float(p[5]), float(p[4]), *st.REFERENCE) for p in pair)
        share = np.linspace(0, 1, 4001)
        px, py = a[0] + (b[0] - a[0]) * share, a[1] + (b[1] - a[1]) * share
        inside = np.zeros(len(share), bool)
        for (x0, y0), (x1, y1) in zip(outline, outline[1:]):
            with np.errstate(divide="ignore", invalid="ignore"):
                inside ^= ((y0 > py) != (y1 > py)) & (px < (x1 - x0) * (py - y0) / (y1 - y0) + x0)
        assert got.get(f"S{i}", 0.0) == pytest.approx(inside.mean(), abs=2e-3)


def test_disputed_fix_breaks_a_segment(spark):
    rows = [("A", "N", "main", f"2024-08-10 0{h}:00:00", "18.0", lon) for h, lon in ((0, "-66"), (3, "-66.5"), (3, "-67.5"), (6, "-67"))]
    settled, bad = st.settled_fixes(st.track_fixes(_tracks(spark, rows)), "2024-08-01T00:00:00", "2024-09-01T00:00:00")
    assert bad.count() == 1 and settled.count() == 2
    assert st.track_segments(settled, bad, "2024-08-01T00:00:00", "2024-09-01T00:00:00").count() == 0


def test_rolling_sets_of_a_storm_hour(spark):
    t0 = datetime(2024, 8, 10, 18, 50)
    rows = [(t0 + timedelta(minutes=10 * i), f"b{v}", t0 + timedelta(minutes=10 * i - 1), [1.0] * 4, [True, True, True, i != 3 or v]) for i in range(9) for v in range(8)]
    frames = spark.createDataFrame([(a, b, c, d, [bool(x) for x in e]) for a, b, c, d, e in rows],
                                   "time timestamp_ntz, variable string, source_end timestamp_ntz, values array<float>, valid array<boolean>")
    hours = spark.createDataFrame([(datetime(2024, 8, 10, 20),)], "hour timestamp_ntz")
    picked = sd.frames_for(frames, sd.comparison_targets(hours), list(range(-60, 0, 10)), 8, strict=True)
    assert {r.target.minute: r.supported_cells for r in sd.joint_support(picked).collect()} == {50: 3, 0: 3, 10: 3}
    late = frames.withColumn("source_end", F.col("time") + F.expr("interval 1 minute"))
    with pytest.raises(Exception, match="not causal"):
        sd.frames_for(late, sd.comparison_targets(hours), [-10], 8, strict=True).collect()


def test_future_truth_is_refused(spark):
    t = datetime(2024, 1, 1)
    fc = spark.createDataFrame([(1, "v", 10, 0, 2.0, True, t)], "run int, variable string, lead int, cell int, predicted double, support boolean, valid_time timestamp_ntz")
    truth = spark.createDataFrame([(1, "v", 10, 0, 1.0, True, t)], "run int, variable string, lead int, cell int, observed double, valid boolean, source_end timestamp_ntz")
    first = spark.createDataFrame([(1, "v", 0, 4.0)], "run int, variable string, cell int, initial double")
    row = sd.verify_forecast(sd.join_truth(fc, truth, first)).first()
    assert (row.mae, row.bias, row.persistence_mae, row.pixels) == (1.0, 1.0, 3.0, 1)
    future = truth.withColumn("source_end", F.col("source_end") + F.expr("interval 1 second"))
    with pytest.raises(Exception, match="future"):
        sd.join_truth(fc, future, first).collect()
    none = sd.verify_forecast(sd.join_truth(fc, truth.withColumn("valid", F.lit(False)), first)).first()
    assert none.mae is None and none.valid_fraction == 0.0


def test_radar_year_example(spark):
    """Quality 0, .5, 1 / -1, -3, -285.3 and reflectivity -5, 0, 10 / -99, -999, NaN with bitmap 1,1,0 / 1,1,1."""
    bitmap = [1, 1, 0, 1, 1, 1]
    rows = [("2022-01", "RadarQualityIndex_00.00", i, v, b) for i, (v, b) in enumerate(zip([0.0, 0.5, 1.0, -1.0, -3.0, -285.3], bitmap))]
    rows += [("2022-01", "MergedReflectivityQCComposite_00.50", i, v, b) for i, (v, b) in enumerate(zip([-5.0, 0.0, 10.0, -99.0, -999.0, float("nan")], bitmap))]
    df = spark.createDataFrame(rows, "month string, product string, cell long, raw double, bitmap int")
    totals = {r["product"]: r for r in sd.radar_class_totals(df).collect()}
    q, z = totals["RadarQualityIndex_00.00"], totals["MergedReflectivityQCComposite_00.50"]
    assert (q.valid, q.out_of_range, q.valid_zero, q.missing_sentinel, q.no_coverage_sentinel, q.bitmap_gaps) == (2, 1, 1, 1, 1, 1)
    assert (z.valid, z.valid_negative, z.nonfinite) == (2, 1, 1)
    cells = {r.cell: r for r in sd.radar_year_cells(sd.merge_months(sd.radar_month_cells(df)), spark.createDataFrame([(1,)], "reads long")).collect()}
    assert cells[1].mean_rqi == 0.5 and cells[1].availability == 1.0 and cells[3].mean_rqi is None


def test_axis_search_matches_linear_interpolation(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    for coords in (np.cumsum(rng.random(37) + 0.01), -np.cumsum(rng.random(64) + 0.01), np.array([5.0])):
        up = coords if len(coords) < 2 or coords[0] < coords[-1] else coords[::-1]
        at = np.arange(len(coords), dtype=float) if up is coords else np.arange(len(coords), dtype=float)[::-1]
        x = np.concatenate([coords, rng.uniform(up[0] - 1, up[-1] + 1, 200)])
        want = np.interp(x, up, at, left=np.nan, right=np.nan)
        points = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)] + [(-1, None), (-2, float("nan"))], "i int, tx double")
        got = {r.i: r.f for r in gr.fractional_index(points, gr.axis_table(spark, coords.tolist()), "tx", "f").collect()}
        assert got.pop(-1) is None and got.pop(-2) is None
        assert all((got[i] is None) if np.isnan(w) else got[i] == pytest.approx(w, abs=1e-9) for i, w in enumerate(want))


def test_interpolation_map_needs_no_exchange(spark):
    axis = gr.axis_table(spark, [float(i) for i in range(50)])
    targets = spark.range(1000).select(F.col("id").alias("target_cell"), (F.col("id") % 49 + 0.5).alias("tx"), (F.col("id") / 21).alias("ty"), F.lit(True).alias("inside"))
    plan = gr.interpolation_map(targets, axis, axis, 50, 50)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_a_gap_in_an_axis_fails(spark):
    axis = spark.createDataFrame([(0, 1.0), (2, 3.0)], "index int, coord double")
    with pytest.raises(ValueError, match="without gaps"):
        gr.fractional_index(spark.range(1).withColumn("tx", F.lit(1.0)), axis, "tx", "i")


@pytest.mark.parametrize("side,broadcast", [(7, True), (16, False), (200, True)])
def test_tiles_agree_with_whole_frames(spark, monkeypatch, side, broadcast):
    import numpy as np

    monkeypatch.setattr(gr, "TILED_MOST", gr.TILED_MOST if broadcast else 0)
    nx, ny, tx, ty = 60, 45, 41, 30
    rng = np.random.default_rng(side)
    frames = spark.createDataFrame([(
        k, "g", rng.normal(size=nx * ny).astype("float32").tolist(), (rng.random(nx * ny) > 0.02).tolist(),
        [int(v) if v else None for v in rng.integers(0, 4, nx * ny)], rng.integers(0, 9, nx * ny).tolist()) for k in range(5)],
        "k int, grid_id string, values array<float>, valid array<boolean>, quality array<int>, classes array<int>")
    cells = spark.range(tx * ty).select(F.col("id").alias("target_cell"))
    targets = cells.select("target_cell", (F.col("target_cell") % tx * 1.5).alias("tx"), (F.floor(F.col("target_cell") / tx) * 1.47).alias("ty"), (F.col("target_cell") % 17 != 0).alias("inside"))
    mapping = gr.interpolation_map(targets, gr.axis_table(spark, [float(i) for i in range(nx)]), gr.axis_table(spark, [float(i) for i in range(ny)]), nx, ny)
    tiled = gr.regrid_tiles(gr.tile_frames(frames, ["k"], nx, ny, side), gr.tile_map(mapping, nx, tx, side), side)
    got = {(r.frame.k, p.target_cell): (p.value, p.valid, p.quality, p["class"], p.source_support) for r in tiled.collect() for p in r.cells}
    whole = gr.regrid_frames(frames, gr.pack_map(mapping, "g")).collect()
    assert len(got) == 5 * tx * ty
    for r in whole:
        for i, want in enumerate(zip(r["values"], r.valid, r.quality, r.classes, r.source_support)):
            value, *rest = got[r.k, i]
            assert rest == list(want[1:]) and (value is None) == (want[0] is None)
            assert value is None or value == pytest.approx(want[0], abs=1e-6)


def test_a_map_too_large_to_pack_fails(spark, monkeypatch):
    monkeypatch.setattr(gr, "PACKED_MOST", 3)
    axis = gr.axis_table(spark, [0.0, 1.0])
    targets = spark.range(4).select(F.col("id").alias("target_cell"), F.lit(0.5).alias("tx"), F.lit(0.5).alias("ty"), F.lit(True).alias("inside"))
    with pytest.raises(Exception, match="too large to be packed"):
        gr.pack_map(gr.interpolation_map(targets, axis, axis, 2, 2), "g").collect()


def test_recipes_need_no_exchange_on_cells(spark):
    axis = gr.axis_table(spark, [0.0, 1.0])
    targets = spark.range(1).select(F.col("id").alias("target_cell"), F.lit(0.5).alias("tx"), F.lit(0.5).alias("ty"), F.lit(True).alias("inside"))
    packed = gr.pack_map(gr.interpolation_map(targets, axis, axis, 2, 2), "g")
    decoded = spark.createDataFrame([("g", [1.0, 2.0, 3.0, 4.0], [0, None, 0, 0], [0, 0, 0, 0]), ("g", [1.0, 2.0, 3.0, None], [0, 1, 0, 0], [0, 0, 0, None])],
                                    "grid_id string, value array<double>, quality array<int>, class array<int>")
    out = gr.satellite_recipe(decoded, packed)
    assert [(r["values"], r.valid) for r in out.collect()] == [([2.5], [True]), ([None], [False])]
    assert [r["values"] for r in gr.satellite_recipe(decoded, packed, mask_quality=False).collect()] == [[2.5], [None]]
    frames_side = out._jdf.queryExecution().optimizedPlan().toString().split("Join")[1]
    assert "Aggregate" not in frames_side.split("\n")[1]
