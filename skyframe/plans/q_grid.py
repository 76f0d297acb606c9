"""Registered queries of grids, regridding, verification, storms and studies."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from skyframe.functions import geo
from skyframe.operators import grid as gr
from skyframe.operators import pixels as px
from skyframe.operators import storms as st
from skyframe.operators import studies as sd
from skyframe.operators.forecasts import event_hours
from skyframe.plans.registry import query, table
from skyframe.plans.standins import (
    END, FRAMES, OBSERVATIONS, RADAR, SATELLITE, START, STORMS, TRACKS, observations, radar_pixels, raster_frames, raw_tracks,
    satellite_pixels, storm_events)
from skyframe.session import new_folder

# --- map of the 8 x 8 frames to a 5 x 5 target whose last row and column lie outside ---------------
_X_AXIS, _Y_AXIS = [float(i) for i in range(8)], [float(7 - i) for i in range(8)]
MAP = """
targets AS (SELECT r * 5 + c AS target_cell, 0.3::DOUBLE + 1.9::DOUBLE * c AS tx, 0.3::DOUBLE + 1.9::DOUBLE * r AS ty
  FROM (SELECT unnest(range(5)) AS c) CROSS JOIN (SELECT unnest(range(5)) AS r)),
placed AS (SELECT *, CASE WHEN tx <= 7 THEN tx ELSE 0 END AS ix, CASE WHEN ty <= 7 THEN 7 - ty ELSE 0 END AS iy, tx <= 7 AND ty <= 7 AS support FROM targets),
corner AS (SELECT *, least(floor(ix), 6)::INTEGER AS x0, least(floor(iy), 6)::INTEGER AS y0, CAST(round_even(iy, 0) * 8 + round_even(ix, 0) AS INTEGER) AS nearest FROM placed),
lut AS (
  SELECT target_cell, support, nearest, y0 * 8 + x0 AS cell, CAST((1 - (ix - x0)) * (1 - (iy - y0)) AS FLOAT) AS w FROM corner
  UNION ALL SELECT target_cell, support, nearest, y0 * 8 + x0 + 1, CAST((ix - x0) * (1 - (iy - y0)) AS FLOAT) FROM corner
  UNION ALL SELECT target_cell, support, nearest, (y0 + 1) * 8 + x0, CAST((1 - (ix - x0)) * (iy - y0) AS FLOAT) FROM corner
  UNION ALL SELECT target_cell, support, nearest, (y0 + 1) * 8 + x0 + 1, CAST((ix - x0) * (iy - y0) AS FLOAT) FROM corner)
"""
REGRIDDED = """
regridded AS (
  SELECT c.vec_id, c.time, c.variable, l.target_cell, any_value(l.support) AND bool_and(c.valid OR l.w <= 1e-7) AS valid,
    sum(CASE WHEN c.valid THEN c.value::DOUBLE * l.w::DOUBLE ELSE 0 END) AS s, max(c.quality) FILTER (c.cell = l.nearest) AS quality,
    max(c.class) FILTER (c.cell = l.nearest) AS class, any_value(l.support) AS source_support
  FROM cells c JOIN lut l ON l.cell = c.cell GROUP BY ALL)
"""


def _targets(spark):
    cells = spark.range(25).select(F.col("id").alias("target_cell"))
    return cells.select("target_cell", (0.3 + 1.9 * (F.col("target_cell") % 5)).alias("tx"), (0.3 + 1.9 * F.floor(F.col("target_cell") / 5)).alias("ty"), F.lit(True).alias("inside"))


def _map(spark, method="bilinear"):
    return gr.interpolation_map(_targets(spark), gr.axis_table(spark, _X_AXIS), gr.axis_table(spark, _Y_AXIS), 8, 8, method)


def _long(frames):
    return gr.long_pixels(frames, ["vec_id", "time", "variable"])


_REGRID_COLUMNS = "vec_id, variable, target_cell, CASE WHEN valid THEN round(CAST(s AS FLOAT)::DOUBLE, 5) END AS value, valid, quality, class, source_support"


# Two uneven axes, one rising and one falling, and one target per line; some lie outside.
@query("g02_interpolation_map", """
WITH ax AS (SELECT n_nationkey::INTEGER AS i, (n_nationkey * n_nationkey + n_nationkey)::DOUBLE AS c FROM nation),
ay AS (SELECT n_nationkey::INTEGER AS i, 40::DOUBLE - 1.5::DOUBLE * n_nationkey AS c FROM nation),
bx AS (SELECT *, lead(c) OVER (ORDER BY c) AS nc FROM ax), by_ AS (SELECT *, lead(c) OVER (ORDER BY c) AS nc FROM ay),
t AS (SELECT l_orderkey * 8 + l_linenumber AS target_cell, l_extendedprice::DOUBLE % 650::DOUBLE AS tx, l_quantity::DOUBLE AS ty, l_discount::DOUBLE < 0.085::DOUBLE AS inside FROM lineitem),
px AS (SELECT t.*, CASE WHEN tx <= 600 THEN b.i + coalesce((tx - b.c) / (b.nc - b.c), 0) END AS ix FROM t ASOF LEFT JOIN bx b ON t.tx >= b.c),
py AS (SELECT px.*, CASE WHEN ty <= 40 THEN b.i - coalesce((ty - b.c) / (b.nc - b.c), 0) END AS iy FROM px ASOF LEFT JOIN by_ b ON px.ty >= b.c),
p AS (SELECT target_cell, ix IS NOT NULL AND iy IS NOT NULL AND inside AS support, coalesce(ix, 0) AS ix, coalesce(iy, 0) AS iy FROM py),
c AS (SELECT *, least(floor(ix), 23)::INTEGER AS x0, least(floor(iy), 23)::INTEGER AS y0, CAST(round_even(iy, 0) * 25 + round_even(ix, 0) AS INTEGER) AS nearest FROM p),
m AS (
  SELECT *, y0 * 25 + x0 AS cell, CAST((1 - (ix - x0)) * (1 - (iy - y0)) AS FLOAT) AS w FROM c
  UNION ALL SELECT *, y0 * 25 + x0 + 1, CAST((ix - x0) * (1 - (iy - y0)) AS FLOAT) FROM c
  UNION ALL SELECT *, (y0 + 1) * 25 + x0, CAST((1 - (ix - x0)) * (iy - y0) AS FLOAT) FROM c
  UNION ALL SELECT *, (y0 + 1) * 25 + x0 + 1, CAST((ix - x0) * (iy - y0) AS FLOAT) FROM c)
SELECT 'native' AS grid_pair, target_cell, cell AS source_cell, round(w::DOUBLE, 5) AS weight, support, cell = nearest AS is_nearest FROM m""")
def g02(spark, folder):
    n = F.col("n_nationkey")
    nations, lines = table(spark, folder, "nation"), table(spark, folder, "lineitem")
    x_axis = nations.select(n.cast("int").alias("index"), (n * n + n).cast("double").alias("coord"))
    y_axis = nations.select(n.cast("int").alias("index"), (F.lit(40.0) - F.lit(1.5) * n).alias("coord"))
    targets = lines.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("target_cell"), (F.col("l_extendedprice").cast("double") % 650.0).alias("tx"),
        F.col("l_quantity").cast("double").alias("ty"), (F.col("l_discount").cast("double") < 0.085).alias("inside"))
    sparse = gr.sparse_map(gr.interpolation_map(targets, x_axis, y_axis, 25, 25))
    return sparse.select(F.lit("native").alias("grid_pair"), "target_cell", "source_cell", F.round(F.col("weight").cast("double"), 5).alias("weight"), "support", "is_nearest")


@query("g03_regrid_long", f"WITH {FRAMES}, {MAP}, {REGRIDDED} SELECT {_REGRID_COLUMNS} FROM regridded")
def g03(spark, folder):
    out = gr.regrid_long(_long(raster_frames(spark, folder)), gr.sparse_map(_map(spark)), ["vec_id", "time", "variable"])
    return out.select("vec_id", "variable", "target_cell", F.round(F.col("value").cast("double"), 5).alias("value"), "valid", "quality", "class", "source_support")


@query("g03_regrid_arrays", f"WITH {FRAMES}, {MAP}, {REGRIDDED} SELECT {_REGRID_COLUMNS} FROM regridded")
def g03a(spark, folder):
    out = gr.regrid_frames(raster_frames(spark, folder), gr.pack_map(_map(spark), "native"))
    cells = F.posexplode(F.arrays_zip("values", "valid", "quality", "classes", "source_support")).alias("target_cell", "p")
    rows = out.select("vec_id", "variable", cells)
    return rows.select("vec_id", "variable", F.col("target_cell").cast("long").alias("target_cell"), F.round(F.col("p.values").cast("double"), 5).alias("value"),
                       "p.valid", "p.quality", F.col("p.classes").alias("class"), "p.source_support")


@query("g03_regrid_tiles", f"WITH {FRAMES}, {MAP}, {REGRIDDED} SELECT {_REGRID_COLUMNS} FROM regridded")
def g03t(spark, folder):
    tiles = gr.tile_frames(raster_frames(spark, folder), ["vec_id", "variable"], 8, 8, side=3)
    out = gr.regrid_tiles(tiles, gr.tile_map(_map(spark), 8, 5, side=3), side=3).select("frame.*", F.explode("cells").alias("p"))
    return out.select("vec_id", "variable", "p.target_cell", F.round(F.col("p.value").cast("double"), 5).alias("value"), "p.valid", "p.quality", "p.class", "p.source_support")


@query("g04_slot_frames", f"""
WITH {FRAMES}, {MAP}, {REGRIDDED},
spine AS (SELECT t.time AS slot_time, v.variable FROM (SELECT DISTINCT time FROM frames) t CROSS JOIN (SELECT unnest(['abi01c', 'abi13c', 'refc']) AS variable) v),
r AS (SELECT * FROM regridded WHERE vec_id NOT IN (SELECT vec_id FROM embeddings WHERE label = 3)),
g AS (SELECT s.slot_time, s.variable, count(r.vec_id) > 0 AS observed, CAST(count(*) FILTER (r.valid) AS BIGINT) AS valid_cells, sum(coalesce(r.quality, 255))::BIGINT AS quality_sum,
  sum(coalesce(r.class, 255))::BIGINT AS class_sum, round(coalesce(sum(CAST(r.s AS FLOAT)::DOUBLE) FILTER (r.valid), 0), 4) AS value_sum
  FROM spine s CROSS JOIN (SELECT unnest(range(25)) AS cell) k LEFT JOIN r ON r.time = s.slot_time AND r.variable = s.variable AND r.target_cell = k.cell GROUP BY ALL)
SELECT * FROM g""")
def g04(spark, folder):
    frames = raster_frames(spark, folder)
    spine = frames.select(F.col("time").alias("slot_time")).distinct().withColumn("variable", F.explode(F.array(*[F.lit(v) for v in ("abi01c", "abi13c", "refc")])))
    present = frames.filter("label <> 3").withColumnRenamed("time", "slot_time")
    out = gr.slot_frames(spine, present, gr.pack_map(_map(spark), "native"), 25)

    def add(name):
        return F.aggregate(name, F.lit(0).cast("long"), lambda a, v: a + v)

    total = F.aggregate(F.arrays_zip("values", "valid"), F.lit(0.0), lambda a, p: a + F.when(p["valid"], p["values"].cast("double")).otherwise(F.lit(0.0)))
    return out.select("slot_time", "variable", "observed", F.size(F.filter("valid", lambda v: v)).cast("long").alias("valid_cells"),
                      add("quality").alias("quality_sum"), add("classes").alias("class_sum"), F.round(total, 4).alias("value_sum"))


# Radar cells: 32 x 24 source cells (x by y) to their four-cell means, by a fixed regular map.
_BLOCKS = """
px AS (SELECT l_orderkey, l_linenumber, time, product, raw, bitmap, missing, no_coverage, CAST(y * 32 + x AS INTEGER) AS cell FROM radar WHERE {where}),
one AS (SELECT *, row_number() OVER (PARTITION BY time, product, cell ORDER BY l_orderkey, l_linenumber, raw, bitmap) AS r FROM px),
src AS (SELECT * FROM one WHERE r = 1),
m AS (SELECT t.t AS target_cell, (t.t // 16 * 2 + d // 2) * 32 + t.t % 16 * 2 + d % 2 AS cell FROM (SELECT unnest(range(192)) AS t) t CROSS JOIN (SELECT unnest(range(4)) AS d) d)
"""


def _block_map(spark):
    """Regular map of the 32 x 24 source cells to 16 x 12 targets at the corners of four cells."""
    cells = spark.range(192).select(F.col("id").alias("target_cell"))
    targets = cells.select("target_cell", (F.col("target_cell") % 16 * 2 + 0.5).alias("tx"), (F.floor(F.col("target_cell") / 16) * 2 + 0.5).alias("ty"), F.lit(True).alias("inside"))
    axes = [gr.axis_table(spark, [float(i) for i in range(n)]) for n in (32, 24)]
    return gr.pack_map(gr.interpolation_map(targets, *axes, 32, 24), "blocks")


def _block_frames(rows, keys, columns, first_by):
    """Frames of 32 x 24 cells, one pixel per cell (lines of one month share cells in the given table)."""
    rows = rows.withColumn("source_cell", (F.col("y") * 32 + F.col("x")).cast("int"))
    return gr.dense_frames(rows, keys, "source_cell", 768, columns, first_by).withColumn("grid_id", F.lit("blocks"))


def _radar_blocks(spark, folder, recipe):
    frames = _block_frames(radar_pixels(spark, folder), ["time", "product"], ["raw", "bitmap"], ["l_orderkey", "l_linenumber", "raw", "bitmap"])
    out = gr.radar_recipe(frames, _block_map(spark), recipe)
    cells = out.select("time", "product", F.posexplode(F.arrays_zip("values", "valid", "touched")).alias("target_cell", "p")).filter("p.touched")
    return cells.select("time", "product", F.col("target_cell").cast("long").alias("target_cell"), F.round(F.col("p.values").cast("double"), 5).alias("value"), "p.valid")


@query("g05_radar_mask_first", f"""
WITH {RADAR}, {_BLOCKS.format(where="true")}
SELECT time, product, target_cell, CASE WHEN count(*) FILTER (ok) = 4 THEN round(sum(CASE WHEN ok THEN CAST(raw AS FLOAT) * 0.25 END)::DOUBLE, 5) END AS value,
  count(*) FILTER (ok) = 4 AS valid
FROM (SELECT s.*, m.target_cell, bitmap = 1 AND NOT isnan(raw) AND raw <> missing AND raw <> no_coverage AS ok FROM src s JOIN m USING (cell)) GROUP BY time, product, target_cell""")
def g05(spark, folder):
    return _radar_blocks(spark, folder, "mask_first")


@query("g05_radar_mask_late", f"""
WITH {RADAR}, {_BLOCKS.format(where="true")},
v AS (SELECT time, product, target_cell, CASE WHEN count(*) FILTER (ok) = 4 THEN round(sum(CASE WHEN ok THEN CAST(raw AS FLOAT) * 0.25 END)::DOUBLE, 5) END AS value
  FROM (SELECT s.*, m.target_cell, bitmap = 1 AND NOT isnan(raw) AS ok FROM src s JOIN m USING (cell)) GROUP BY time, product, target_cell)
SELECT time, product, target_cell, CASE WHEN value >= 0 THEN value END AS value, coalesce(value >= 0, false) AS valid FROM v""")
def g05l(spark, folder):
    return _radar_blocks(spark, folder, "mask_late")


@query("g06_satellite_recipe", f"""
WITH {SATELLITE},
one AS (SELECT *, CAST(y * 32 + x AS INTEGER) AS cell, row_number() OVER (PARTITION BY variable, time, y, x ORDER BY l_orderkey, l_linenumber, raw) AS r FROM decoded),
src AS (SELECT *, class = 0 AND (quality IS NULL OR quality = 0) AS ok FROM one WHERE r = 1),
m AS (SELECT t.t AS target_cell, (t.t // 16 * 2 + d // 2) * 32 + t.t % 16 * 2 + d % 2 AS cell FROM (SELECT unnest(range(192)) AS t) t CROSS JOIN (SELECT unnest(range(4)) AS d) d)
SELECT variable, time, target_cell, count(*) FILTER (ok) = 4 AS valid, CASE WHEN count(*) FILTER (ok) = 4 THEN round(sum(CASE WHEN ok THEN phys::DOUBLE * 0.25 END), 2) END AS value
FROM src JOIN m USING (cell) GROUP BY variable, time, target_cell""")
def g06(spark, folder):
    decoded = px.decode_satellite(satellite_pixels(spark, folder))
    frames = _block_frames(decoded, ["variable", "time"], ["value", "quality", "class"], ["l_orderkey", "l_linenumber", "raw"])
    out = gr.satellite_recipe(frames, _block_map(spark))
    cells = out.select("variable", "time", F.posexplode(F.arrays_zip("values", "valid", "touched")).alias("target_cell", "p")).filter("p.touched")
    return cells.select("variable", "time", F.col("target_cell").cast("long").alias("target_cell"), "p.valid", F.round(F.col("p.values").cast("double"), 2).alias("value"))


# --- projections ------------------------------------------------------------------------------------
_CONE = geo.regional_lambert()
_E = geo.ECC
_LEFT, _BOTTOM, _RIGHT, _TOP = geo.grid_bounds()
_NX, _NY = (_RIGHT - _LEFT) // 3000, (_TOP - _BOTTOM) // 3000


def _forward_sql(lon, lat):
    t = f"(tan({math.pi / 4!r} - radians({lat}) / 2) * exp({_E!r} * atanh({_E!r} * sin(radians({lat})))))"
    rho = f"({geo.SEMI_MAJOR * _CONE.f!r} * pow({t}, {_CONE.n!r}))"
    theta = f"((radians({lon}) - ({_CONE.lon0!r})) * {_CONE.n!r})"
    return f"{rho} * sin({theta})", f"{_CONE.rho0!r} - {rho} * cos({theta})"


_FX, _FY = _forward_sql("lon", "lat")
_STEPS = "".join(
    f", i{k} AS (SELECT *, {math.pi / 2!r} - 2 * atan(t * exp(-{_E!r} * atanh({_E!r} * sin(phi{k - 1})))) AS phi{k} FROM i{k - 1})" for k in range(1, geo.ITERATIONS + 1))


@query("g01_target_grid", f"""
WITH {SATELLITE},
p AS (SELECT floor(({_FX} - ({_LEFT})) / 3000) AS c, floor(({_TOP} - ({_FY})) / 3000) AS r FROM satellite),
n AS (SELECT CAST(r * {_NX} + c AS BIGINT) AS target_cell, count(*) AS pixels FROM p WHERE c BETWEEN 0 AND {_NX - 1} AND r BETWEEN 0 AND {_NY - 1} GROUP BY 1),
m AS (SELECT *, {_LEFT + 1500.0!r} + target_cell % {_NX} * 3000 AS x_m, {_TOP - 1500.0!r} - target_cell // {_NX} * 3000 AS y_m FROM n),
i0 AS (SELECT *, pow(sqrt(x_m * x_m + ({_CONE.rho0!r} - y_m) * ({_CONE.rho0!r} - y_m)) / {geo.SEMI_MAJOR * _CONE.f!r}, {1 / _CONE.n!r}) AS t,
  {math.pi / 2!r} - 2 * atan(pow(sqrt(x_m * x_m + ({_CONE.rho0!r} - y_m) * ({_CONE.rho0!r} - y_m)) / {geo.SEMI_MAJOR * _CONE.f!r}, {1 / _CONE.n!r})) AS phi0 FROM m){_STEPS},
d AS (SELECT *, degrees(atan2(x_m, {_CONE.rho0!r} - y_m) / {_CONE.n!r} + ({_CONE.lon0!r})) AS lon, degrees(phi{geo.ITERATIONS}) AS lat FROM i{geo.ITERATIONS})
SELECT target_cell, pixels, round(x_m, 3)::DOUBLE AS x_m, round(y_m, 3)::DOUBLE AS y_m, round(lon, 7) AS lon, round(lat, 7) AS lat,
  lon BETWEEN -70.24 AND -62.56 AND lat BETWEEN 14.36 AND 22.04 AS inside FROM d""")
def g01(spark, folder):
    x, y = _CONE.forward_columns(F.col("lon"), F.col("lat"))
    rows = satellite_pixels(spark, folder).select(F.floor((x - _LEFT) / 3000).alias("c"), F.floor((F.lit(_TOP) - y) / 3000).alias("r"))
    rows = rows.filter(F.col("c").between(0, _NX - 1) & F.col("r").between(0, _NY - 1))
    counts = rows.groupBy((F.col("r") * _NX + F.col("c")).cast("long").alias("target_cell")).agg(F.count(F.lit(1)).alias("pixels"))
    cells = gr.target_grid(spark, 3).join(counts, "target_cell")
    return cells.select("target_cell", "pixels", F.round("x_m", 3).alias("x_m"), F.round("y_m", 3).alias("y_m"), F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"), "inside")


_SAT_LON, _SAT_H = -75.2, 35786023.0
_A, _B = geo.SEMI_MAJOR, geo.SEMI_MAJOR * (1 - geo.FLATTENING)
_H, _R = _SAT_H + _A, (_A / _B) ** 2


@query("g07_view_angles", f"""
WITH {SATELLITE},
g AS (SELECT l_orderkey, l_linenumber, raw, lon, lat, atan(tan(radians(lat)) / {_R!r}) AS gc, radians(lon) - ({math.radians(_SAT_LON)!r}) AS dl FROM satellite),
r AS (SELECT *, {_B!r} / sqrt(1 - {1 - 1 / _R!r} * cos(gc) * cos(gc)) AS rc FROM g),
s AS (SELECT *, {_H!r} - rc * cos(gc) * cos(dl) AS sx, -rc * cos(gc) * sin(dl) AS sy, rc * sin(gc) AS sz FROM r)
SELECT l_orderkey, l_linenumber, raw, round(asin(-sy / sqrt(sx * sx + sy * sy + sz * sz)), 10) AS view_x, round(atan(sz / sx), 10) AS view_y, round(lon, 7) AS lon, round(lat, 7) AS lat FROM s""")
def g07(spark, folder):
    """Positions to view angles and back: the round trip must return the given position."""
    x, y = geo.lonlat_to_view(F.col("lon"), F.col("lat"), _SAT_LON, _SAT_H)
    rows = satellite_pixels(spark, folder).select("l_orderkey", "l_linenumber", "raw", x.alias("view_x"), y.alias("view_y"))
    lon, lat = geo.view_to_lonlat(F.col("view_x"), F.col("view_y"), _SAT_LON, _SAT_H)
    return rows.select("l_orderkey", "l_linenumber", "raw", F.round("view_x", 10).alias("view_x"), F.round("view_y", 10).alias("view_y"), F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


_CLOUDS = f"""
{SATELLITE},
cl AS (SELECT s.*, l_orderkey * 100 + l_linenumber AS pixel_id, (abs(raw) % 160) / 10.0::DOUBLE AS height_km FROM satellite s),
k AS (SELECT *, variable IN ('band01', 'band03') AS movable, l_linenumber <> 7 AS known FROM cl),
w AS (SELECT *, radians(lat) AS phi, radians(lon) - ({math.radians(_SAT_LON)!r}) AS dl, height_km * 1000.0 AS h FROM k WHERE NOT movable OR known),
n AS (SELECT *, {_A!r} / sqrt(1 - {geo.ECC2!r} * sin(phi) * sin(phi)) AS n FROM w),
p AS (SELECT *, n * cos(phi) * cos(dl) - ({_A + _SAT_H!r}) AS dx, n * cos(phi) * sin(dl) AS dy, n * {1 - geo.ECC2!r} * sin(phi) AS dz, h + {_A!r} AS ha, h + {_B!r} AS hb FROM n),
q AS (SELECT *, (dx * dx + dy * dy) / (ha * ha) + dz * dz / (hb * hb) AS qa, 2 * {_A + _SAT_H!r} * dx / (ha * ha) AS qb, {(_A + _SAT_H) ** 2!r} / (ha * ha) - 1 AS qc FROM p),
t AS (SELECT *, (-qb - sqrt(qb * qb - 4 * qa * qc)) / (2 * qa) AS t FROM q),
z AS (SELECT *, {_A + _SAT_H!r} + t * dx AS px, t * dy AS py, t * dz AS pz FROM t),
moved AS (SELECT *, CASE WHEN movable THEN degrees(atan2(py, px)) + ({_SAT_LON!r}) ELSE lon END AS lon2,
  CASE WHEN movable THEN degrees(atan(pz / sqrt(px * px + py * py) * (ha / hb) * (ha / hb))) ELSE lat END AS lat2 FROM z)
"""


def _cloud_pixels(spark, folder):
    rows = px.decode_satellite(satellite_pixels(spark, folder))
    return rows.withColumns({
        "pixel_id": F.col("l_orderkey") * 100 + F.col("l_linenumber"), "height": F.abs("raw") % 160 / 10.0, "height_unit": F.lit("km"),
        "height_quality": F.when(F.col("l_linenumber") == 7, 1).otherwise(0)})


@query("g08_parallax_shift", f"""
WITH {_CLOUDS} SELECT l_orderkey, l_linenumber, raw, round(lon2, 6) AS lon2, round(lat2, 6) AS lat2 FROM moved WHERE movable""")
def g08(spark, folder):
    return _moved(spark, folder).select("l_orderkey", "l_linenumber", "raw", F.round("lon2", 6).alias("lon2"), F.round("lat2", 6).alias("lat2"))


def _moved(spark, folder):
    rows = _cloud_pixels(spark, folder).filter("variable in ('band01', 'band03') and height_quality = 0")
    return geo.with_parallax(rows.withColumn("metres", F.col("height") * 1000.0), "lon", "lat", "metres", _SAT_LON, _SAT_H, "lon2", "lat2")


_MX, _MY = _forward_sql("lon2", "lat2")


@query("g08_corrected_cells", f"""
WITH {_CLOUDS},
c AS (SELECT variable, movable, floor(({_MX} - ({_LEFT})) / 3000) AS c, floor(({_TOP} - ({_MY})) / 3000) AS r FROM moved)
SELECT variable, CAST(r * {_NX} + c AS BIGINT) AS target_cell, bool_or(movable) AS parallax_applied FROM c
WHERE c BETWEEN 0 AND {_NX - 1} AND r BETWEEN 0 AND {_NY - 1} GROUP BY ALL""")
def g08c(spark, folder):
    rows = _cloud_pixels(spark, folder).withColumn("scene", F.lit("all"))
    out = gr.corrected_pixels(rows, _SAT_LON, _SAT_H, 3, ["band01", "band03"], ["scene"])
    return out.select("variable", "target_cell", "parallax_applied")


@query("g09_forecast_crop", f"""
WITH {RADAR},
b AS (SELECT min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1 FROM radar WHERE lon BETWEEN -68.5 AND -68.0 AND lat BETWEEN 15.0 AND 15.3)
SELECT l_orderkey, l_linenumber, y, x, CASE WHEN lon BETWEEN -68.5 AND -68.0 AND lat BETWEEN 15.0 AND 15.3 AND NOT isnan(raw) THEN raw END AS value
FROM radar, b WHERE y BETWEEN y0 AND y1 AND x BETWEEN x0 AND x1""")
def g09(spark, folder):
    stamp = "2024-01-01 00:00:00"
    rows = radar_pixels(spark, folder).select(
        "l_orderkey", "l_linenumber", "y", "x", "lon", "lat", F.nanvl("raw", F.lit(None).cast("double")).alias("value"),
        F.lit(stamp).cast("timestamp_ntz").alias("cycle"), F.lit(stamp).cast("timestamp_ntz").alias("valid_time"))
    return gr.forecast_crop(rows, (-68.5, 15.0, -68.0, 15.3), stamp, stamp).select("l_orderkey", "l_linenumber", "y", "x", "value")


@query("g11_grown_boxes", """
WITH b AS (SELECT s_suppkey, -70.0::DOUBLE + s_suppkey / 50.0::DOUBLE AS w, 10.0::DOUBLE + s_nationkey / 5.0::DOUBLE AS s FROM supplier)
SELECT s_suppkey, round(w - 50.0 / (110.0 * cos(radians(s + 2))), 9) AS west, round(s - 50.0 / 110.0, 9) AS south,
  round(w + 3 + 50.0 / (110.0 * cos(radians(s + 2))), 9) AS east, round(s + 2 + 50.0 / 110.0, 9) AS north FROM b""")
def g11(spark, folder):
    w, s = -70.0 + F.col("s_suppkey") / 50.0, 10.0 + F.col("s_nationkey") / 5.0
    rows = table(spark, folder, "supplier").select("s_suppkey", w.alias("w"), s.alias("s"))
    box = geo.grow_box_columns(F.col("w"), F.col("s"), F.col("w") + 3, F.col("s") + 2)
    return rows.select("s_suppkey", *[F.round(c, 9).alias(n) for c, n in zip(box, ("west", "south", "east", "north"))])


_OPTIONS = ", ".join(f"('{n}', {', '.join(repr(float(v)) + '::DOUBLE' for v in b)})" for n, b in geo.region_options().items())


@query("g11_region_options", f"""
WITH {SATELLITE}, o(region, west, south, east, north) AS (VALUES {_OPTIONS})
SELECT region, count(s.lon) AS pixels FROM o LEFT JOIN satellite s ON lon >= west AND lon < east AND lat >= south AND lat < north GROUP BY region""")
def g11o(spark, folder):
    found = px.with_patch(satellite_pixels(spark, folder), patches=geo.region_options()).groupBy("patch").agg(F.count(F.lit(1)).alias("n"))
    return gr.region_rows(spark).join(found, F.col("region") == F.col("patch"), "left").select("region", F.coalesce("n", F.lit(0)).alias("pixels"))


@query("g12_static_field", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(greatest(p_retailprice - 1000.0, 0) * 0.5 + 3.0 AS FLOAT)::DOUBLE AS topography FROM lineitem JOIN part ON p_partkey = l_partkey""")
def g12(spark, folder):
    cells = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_partkey").alias("cell"))
    elevation = table(spark, folder, "part").select(F.col("p_partkey").alias("cell"), (F.col("p_retailprice") - 1000.0).alias("elevation"))
    out = gr.sample_static(cells, elevation, 0.5, 3.0, "zero")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.col("topography").cast("double").alias("topography"))


@query("x03_frame_comparison", f"""
WITH {FRAMES}
SELECT vec_id, count(*) = 64 AS same_window, bool_and(NOT valid OR label <> 2 OR cell <> 5) AS valid_pixels_equal,
  round(max(CASE WHEN label = 4 THEN 1e-5 ELSE 1e-7 END), 9) AS max_coordinate_difference, bool_and(label <> 4) AS within_tolerance FROM cells GROUP BY vec_id""")
def x03(spark, folder):
    rows = gr.long_pixels(raster_frames(spark, folder), ["vec_id", "label"]).withColumns({"lat": F.col("source_cell") * 1.0, "lon": F.col("source_cell") * 2.0})
    bump = F.when((F.col("label") == 2) & (F.col("source_cell") == 5), F.col("value") + 1).otherwise(F.col("value"))
    other = rows.withColumns({"value": bump, "lat": F.col("lat") + F.when(F.col("label") == 4, 1e-5).otherwise(1e-7)})
    out = gr.compare_frames(rows, other, ["vec_id", "source_cell"], ["lat", "lon"])
    return out.withColumn("max_coordinate_difference", F.round("max_coordinate_difference", 9))


@query("a25_support_share", f"""
WITH {SATELLITE}, g AS (SELECT x, y, lon >= -68.0 AND lat >= 15.5 AS inside, lon BETWEEN -67.0 AND -65.0 AND lat BETWEEN 15.0 AND 18.0 AS covered FROM satellite)
SELECT count(*) FILTER (inside) AS region_cells, count(*) FILTER (inside AND covered) AS region_supported,
  count(*) FILTER (y BETWEEN 4 AND 19 AND x BETWEEN 8 AND 23) AS crop_cells, count(*) FILTER (y BETWEEN 4 AND 19 AND x BETWEEN 8 AND 23 AND covered) AS crop_supported FROM g""")
def a25(spark, folder):
    rows = satellite_pixels(spark, folder).withColumn("inside", (F.col("lon") >= -68.0) & (F.col("lat") >= 15.5))
    return gr.support_share(rows, (-67.0, 15.0, -65.0, 18.0), 24, 32, 16)


# --- verification, samples, radar year ----------------------------------------------------------------
_JOINED = """
j AS (
  SELECT a.vec_id AS run, a.variable, 10 * (1 + a.vec_id % 3) AS lead, a.cell, a.value AS predicted, b.value AS observed, p.value AS initial,
    coalesce(a.valid AND b.valid AND p.value IS NOT NULL, false) AS joint
  FROM cells a LEFT JOIN cells b ON b.vec_id = a.vec_id + 1 AND b.cell = a.cell LEFT JOIN cells p ON p.vec_id = a.vec_id - 1 AND p.cell = a.cell)
"""


def _joined(spark, folder):
    rows = gr.long_pixels(raster_frames(spark, folder), ["vec_id", "variable", "time"]).withColumnRenamed("source_cell", "cell")
    lead = (10 * (1 + F.col("run") % 3)).alias("lead")
    base = rows.withColumn("run", F.col("vec_id"))
    forecast = base.select("run", "variable", lead, "cell", F.col("value").alias("predicted"), F.col("valid").alias("support"), (F.col("time") + F.expr("interval 1 hour")).alias("valid_time"))
    names = base.select("run", "variable").distinct()
    shifted = rows.drop("variable").withColumn("run", F.col("vec_id") - 1).join(names, "run")
    truth = shifted.select("run", "variable", lead, "cell", F.col("value").alias("observed"), "valid", F.col("time").alias("source_end"))
    before = rows.drop("variable").withColumn("run", F.col("vec_id") + 1).join(names, "run")
    return sd.join_truth(forecast, truth, before.select("run", "variable", "cell", F.col("value").alias("initial")))


@query("j22_truth_join", f"WITH {FRAMES}, {_JOINED} SELECT run, variable, lead, CAST(cell AS INTEGER) AS cell, round(predicted::DOUBLE, 7) AS predicted, round(observed::DOUBLE, 7) AS observed, round(initial::DOUBLE, 7) AS initial, joint FROM j")
def j22(spark, folder):
    return _joined(spark, folder).select("run", "variable", "lead", "cell", *[F.round(F.col(c).cast("double"), 7).alias(c) for c in ("predicted", "observed", "initial")], "joint")


@query("a12_forecast_verification", f"""
WITH {FRAMES}, {_JOINED}, e AS (SELECT *, predicted::DOUBLE - observed::DOUBLE AS e, initial::DOUBLE - observed::DOUBLE AS p FROM j)
SELECT variable, lead, count(*) FILTER (joint) AS pixels, round(avg(CASE WHEN joint THEN 1.0 ELSE 0.0 END), 6) AS valid_fraction, round(avg(abs(e)) FILTER (joint), 6) AS mae,
  round(sqrt(avg(e * e) FILTER (joint)), 6) AS rmse, round(avg(e) FILTER (joint), 6) AS bias, round(avg(abs(p)) FILTER (joint), 6) AS persistence_mae,
  round(sqrt(avg(p * p) FILTER (joint)), 6) AS persistence_rmse FROM e GROUP BY ALL""")
def a12(spark, folder):
    out = sd.verify_forecast(_joined(spark, folder))
    return out.select("variable", "lead", "pixels", *[F.round(c, 6).alias(c) for c in ("valid_fraction", "mae", "rmse", "bias", "persistence_mae", "persistence_rmse")])


_PICKED = """
n AS (SELECT t.target, c.* FROM (SELECT DISTINCT {target} AS target FROM {source}) t JOIN cells c ON epoch_us(c.time) - epoch_us(t.target) BETWEEN {lo} * 60000000::BIGINT AND {hi} * 60000000::BIGINT),
w AS (SELECT target FROM n GROUP BY target HAVING count(DISTINCT (time, variable)) = 12),
s AS (SELECT target, cell, bool_and(valid) AS ok FROM n WHERE target IN (SELECT target FROM w) GROUP BY ALL)
"""
_P09 = _PICKED.format(target="time", source="frames", lo=-50, hi=0)


def _frozen(spark, folder):
    frames = raster_frames(spark, folder)
    targets = frames.select(F.col("time").alias("target")).distinct()
    return sd.frames_for(frames, targets, list(range(-50, 10, 10)), 2)


@query("p09_sample_support", f"WITH {FRAMES}, {_P09} SELECT target, count(*) FILTER (ok) AS supported_cells, round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 9) AS supported_fraction FROM s GROUP BY target")
def p09(spark, folder):
    return sd.joint_support(_frozen(spark, folder)).withColumn("supported_fraction", F.round("supported_fraction", 9))


@query("p09_band_validity", f"""
WITH {FRAMES}, {_P09} SELECT target, variable, round(avg(CASE WHEN valid THEN 1.0 ELSE 0.0 END), 9) AS valid_fraction FROM n WHERE target IN (SELECT target FROM w) GROUP BY ALL""")
def p09b(spark, folder):
    return sd.band_validity(_frozen(spark, folder)).withColumn("valid_fraction", F.round("valid_fraction", 9))


_W17 = _PICKED.format(target="time", source="tg", lo=-60, hi=-10)


@query("w17_comparison_sets", f"""
WITH {FRAMES}, hrs AS (SELECT DISTINCT date_trunc('hour', time)::TIMESTAMP AS hour FROM frames),
tg AS (SELECT hour + to_minutes(o) AS time FROM hrs CROSS JOIN (SELECT unnest([-10, 0, 10]) AS o)), {_W17}
SELECT target, count(*) FILTER (ok) AS supported_cells FROM s GROUP BY target""")
def w17(spark, folder):
    frames = raster_frames(spark, folder)
    hours = frames.select(F.date_trunc("hour", "time").cast("timestamp_ntz").alias("hour")).distinct()
    picked = sd.frames_for(frames, sd.comparison_targets(hours), list(range(-60, 0, 10)), 2)
    return sd.joint_support(picked).select("target", "supported_cells")


_YEAR = """
v AS (SELECT *, strftime(time, '%Y-%m') AS month, y * 32 + x AS cell, bitmap = 1 AND NOT isnan(raw) AND raw <> missing AND raw <> no_coverage AS plain FROM radar),
u AS (SELECT *, product = 'RadarQualityIndex_00.00' AS q, plain AND NOT (product = 'RadarQualityIndex_00.00' AND (raw < 0 OR raw > 1)) AS ok FROM v)
"""


def _radar(spark, folder):
    rows = radar_pixels(spark, folder)
    return rows.withColumns({"month": F.date_format("time", "yyyy-MM"), "cell": (F.col("y") * 32 + F.col("x")).cast("long")})


@query("a16_radar_month_cells", f"""
WITH {RADAR}, {_YEAR}
SELECT month, cell::BIGINT AS cell, round(coalesce(sum(raw) FILTER (q AND ok), 0), 6) AS rqi_sum, count(*) FILTER (q AND ok) AS rqi_count, count(*) FILTER (NOT q AND ok) AS reflectivity_count FROM u GROUP BY ALL""")
def a16(spark, folder):
    return sd.radar_month_cells(_radar(spark, folder)).withColumn("rqi_sum", F.round("rqi_sum", 6))


@query("a16_radar_year_cells", f"""
WITH {RADAR}, {_YEAR}, n AS (SELECT count(DISTINCT time) AS reads FROM u WHERE NOT q)
SELECT cell::BIGINT AS cell, round(sum(raw) FILTER (q AND ok) / nullif(count(*) FILTER (q AND ok), 0), 6) AS mean_rqi, round(count(*) FILTER (NOT q AND ok) / (SELECT reads FROM n), 9) AS availability FROM u GROUP BY cell""")
def a16y(spark, folder):
    out = _year(spark, folder)
    return out.select("cell", F.round("mean_rqi", 6).alias("mean_rqi"), F.round("availability", 9).alias("availability"))


def _year(spark, folder):
    rows = _radar(spark, folder)
    reads = rows.filter("product <> 'RadarQualityIndex_00.00'").agg(F.count_distinct("time").alias("reads"))
    return sd.radar_year_cells(sd.merge_months(sd.radar_month_cells(rows)), reads)


@query("a16_radar_year_summary", f"""
WITH {RADAR}, {_YEAR}, n AS (SELECT count(DISTINCT time) AS reads FROM u WHERE NOT q),
c AS (SELECT cell, count(*) FILTER (NOT q AND ok) / (SELECT reads FROM n) AS a FROM u GROUP BY cell)
SELECT count(*) AS cells, round(max(a), 9) AS max_availability, count(*) FILTER (a >= 0.01) AS cells_1_percent, count(*) FILTER (a >= 0.5) AS cells_50_percent FROM c""")
def a16s(spark, folder):
    return sd.radar_year_summary(_year(spark, folder)).withColumn("max_availability", F.round("max_availability", 9))


@query("a16_radar_class_totals", f"""
WITH {RADAR}, {_YEAR}
SELECT product, count(*) AS total, count(*) FILTER (bitmap = 0) AS bitmap_gaps, count(*) FILTER (bitmap = 1 AND isnan(raw)) AS nonfinite,
  count(*) FILTER (bitmap = 1 AND raw = missing) AS missing_sentinel, count(*) FILTER (bitmap = 1 AND raw = no_coverage) AS no_coverage_sentinel,
  count(*) FILTER (plain AND NOT ok) AS out_of_range, count(*) FILTER (ok) AS valid, count(*) FILTER (ok AND raw = 0) AS valid_zero, count(*) FILTER (ok AND raw < 0) AS valid_negative FROM u GROUP BY product""")
def a16t(spark, folder):
    return sd.radar_class_totals(_radar(spark, folder))


# --- storms ------------------------------------------------------------------------------------------
_STUDY = ("2024-01-03T00:00:00", "2024-01-28T00:00:00")


def _fixes(spark, folder):
    return st.track_fixes(raw_tracks(spark, folder))


@query("s10_track_scan", f"WITH {TRACKS} SELECT sid, name, time, round(lon, 6) AS lon, lat FROM fixes")
def s10(spark, folder):
    target = new_folder(spark, "tracks")
    raw_tracks(spark, folder).write.csv(target, header=True)
    rows = st.read_tracks(spark, target)
    return rows.select("sid", "name", "time", F.round("lon", 6).alias("lon"), "lat")


SEGMENTS = f"""
allfix AS (SELECT sid, time, lon, lat, 0 AS bad FROM settled UNION ALL SELECT sid, time, NULL, NULL, 1 FROM disputed),
lagged AS (SELECT *, lag(time) OVER w AS pt, lag(lon) OVER w AS plon, lag(lat) OVER w AS plat, lag(bad) OVER w AS pbad
  FROM allfix WHERE time >= TIMESTAMP '2024-01-02 18:00:00' AND time < TIMESTAMP '2024-01-28 06:00:00' WINDOW w AS (PARTITION BY sid ORDER BY time)),
segments AS (SELECT sid, pt AS time_a, time, plon, plat, lon, lat, greatest(pt, TIMESTAMP '2024-01-03') AS lo, least(time, TIMESTAMP '2024-01-28') AS hi FROM lagged
  WHERE bad = 0 AND pbad = 0 AND time - pt <= INTERVAL 6 HOUR AND pt < TIMESTAMP '2024-01-28' AND time > TIMESTAMP '2024-01-03')
"""


def _segments(spark, folder):
    settled, conflicts = st.settled_fixes(_fixes(spark, folder), *_STUDY)
    return st.track_segments(settled, conflicts, *_STUDY)


@query("w09_track_segments", f"WITH {TRACKS}, {SEGMENTS} SELECT sid, time_a, time, round(plon, 6) AS lon_a, plat AS lat_a, round(lon, 6) AS lon_b, lat AS lat_b, lo, hi FROM segments")
def w09(spark, folder):
    return _segments(spark, folder).select("sid", "time_a", "time", F.round("lon_a", 6).alias("lon_a"), "lat_a", F.round("lon_b", 6).alias("lon_b"), "lat_b", "lo", "hi")


_WEST, _SOUTH, _EAST, _NORTH = geo.REGION


@query("g10_planar_encounters", f"""
WITH {TRACKS}, {SEGMENTS},
c AS (SELECT sid, time_a, time, lo, hi, epoch_us(lo) AS l, epoch_us(hi) - epoch_us(lo) AS d,
  plon + (lon - plon) * (epoch_us(lo) - epoch_us(time_a)) / (epoch_us(time) - epoch_us(time_a)) AS x0, plon + (lon - plon) * (epoch_us(hi) - epoch_us(time_a)) / (epoch_us(time) - epoch_us(time_a)) AS x1,
  plat + (lat - plat) * (epoch_us(lo) - epoch_us(time_a)) / (epoch_us(time) - epoch_us(time_a)) AS y0, plat + (lat - plat) * (epoch_us(hi) - epoch_us(time_a)) / (epoch_us(time) - epoch_us(time_a)) AS y1 FROM segments),
t AS (SELECT *, CASE WHEN x1 = x0 THEN CASE WHEN x0 BETWEEN {_WEST} AND {_EAST} THEN 0 ELSE 2 END ELSE least(({_WEST} - x0) / (x1 - x0), ({_EAST} - x0) / (x1 - x0)) END AS tx0,
  CASE WHEN x1 = x0 THEN 1 ELSE greatest(({_WEST} - x0) / (x1 - x0), ({_EAST} - x0) / (x1 - x0)) END AS tx1,
  CASE WHEN y1 = y0 THEN CASE WHEN y0 BETWEEN {_SOUTH} AND {_NORTH} THEN 0 ELSE 2 END ELSE least(({_SOUTH} - y0) / (y1 - y0), ({_NORTH} - y0) / (y1 - y0)) END AS ty0,
  CASE WHEN y1 = y0 THEN 1 ELSE greatest(({_SOUTH} - y0) / (y1 - y0), ({_NORTH} - y0) / (y1 - y0)) END AS ty1 FROM c),
s AS (SELECT *, greatest(0, tx0, ty0) AS a, least(1, tx1, ty1) AS b FROM t)
SELECT sid, time_a, time, CAST(round((l + a * d) / 1000000.0) AS BIGINT) AS entry_s, CAST(round((l + b * d) / 1000000.0) AS BIGINT) AS exit_s FROM s WHERE a < b""")
def g10p(spark, folder):
    """Encounters on the plain lon/lat plane, where a slab clip in SQL gives the same spans."""
    met = st.encounters(_segments(spark, folder), planar=True).select("sid", "time_a", "time", F.explode("spans").alias("s"))
    second = lambda c: F.round(F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000.0).cast("long")
    return met.select("sid", "time_a", "time", second("s.entry").alias("entry_s"), second("s.exit").alias("exit_s"))


def _plane_sql(lon, lat):
    """The local plane around the reference point, as SQL."""
    lon_0, lat_0 = st.REFERENCE
    dphi, dlam, mid = f"radians({lat} - {lat_0!r}::DOUBLE)", f"radians({lon} - ({lon_0!r})::DOUBLE)", f"radians(({lat} + {lat_0!r}::DOUBLE) / 2)"
    w = f"(1 - {geo.ECC2!r}::DOUBLE * pow(sin({mid}), 2))"
    across = f"({geo.SEMI_MAJOR!r}::DOUBLE / sqrt({w}) * cos({mid}) * {dlam})"
    along = f"({geo.SEMI_MAJOR * (1 - geo.ECC2)!r}::DOUBLE / pow({w}, 1.5) * {dphi} * cos({dlam} / 2))"
    bearing = f"(atan2({across}, {along}) - {dlam} * sin({mid}) / cos({dphi} / 2) / 2)"
    size = f"sqrt({across} * {across} + {along} * {along})"
    return f"{size} * sin({bearing})", f"{size} * cos({bearing})"


def _gap_sql(px, py, x0, y0, x1, y1):
    """Distance of a point to an edge, as SQL."""
    t = (f"greatest(0, least(1, coalesce((({px} - {x0}) * ({x1} - {x0}) + ({py} - {y0}) * ({y1} - {y0}))"
         f" / nullif(({x1} - {x0}) * ({x1} - {x0}) + ({y1} - {y0}) * ({y1} - {y0}), 0), 0)))")
    return f"sqrt(pow({px} - ({x0} + {t} * ({x1} - {x0})), 2) + pow({py} - ({y0} + {t} * ({y1} - {y0})), 2))"


_OUTLINE = st.outline()
_EDGES = ", ".join(f"({p[0]!r}::DOUBLE, {p[1]!r}::DOUBLE, {q[0]!r}::DOUBLE, {q[1]!r}::DOUBLE)" for p, q in zip(_OUTLINE, _OUTLINE[1:]))
(_AX, _AY), (_BX, _BY) = _plane_sql("plon", "plat"), _plane_sql("lon", "lat")
_SHARE = "(epoch_us({0}) - epoch_us(time_a)) / (epoch_us(time) - epoch_us(time_a))::DOUBLE"
ENCOUNTERS = f"""
near AS (SELECT * FROM fixes WHERE time >= TIMESTAMP '2024-01-02 18:00:00' AND time < TIMESTAMP '2024-01-28 06:00:00'),
named AS (SELECT sid, arg_min(name, time) AS name FROM (SELECT sid, time, min(name) AS name FROM near GROUP BY sid, time HAVING count(DISTINCT (lon, lat)) = 1) WHERE name <> '' GROUP BY sid),
part AS (
  SELECT sid, time_a, time, plon, plat, lon, lat, lo, hi, {_SHARE.format("lo")} AS f0, {_SHARE.format("hi")} AS f1 FROM segments
  UNION ALL SELECT sid, time, time, lon, lat, lon, lat, time, time, 0, 1 FROM settled WHERE time >= TIMESTAMP '2024-01-03' AND time < TIMESTAMP '2024-01-28'),
flat AS (SELECT *, {_AX} AS ax, {_AY} AS ay, {_BX} AS bx, {_BY} AS by_, row_number() OVER () AS n FROM part
  WHERE greatest(plon, lon) >= {_WEST - 3} AND least(plon, lon) <= {_EAST + 3} AND greatest(plat, lat) >= {_SOUTH - 3} AND least(plat, lat) <= {_NORTH + 3}),
line AS (SELECT *, ax + f0 * (bx - ax) AS x0, ay + f0 * (by_ - ay) AS y0, ax + f1 * (bx - ax) AS x1, ay + f1 * (by_ - ay) AS y1 FROM flat),
edge(ex0, ey0, ex1, ey1) AS (VALUES {_EDGES}),
crossing AS (SELECT *, nullif((x1 - x0) * (ey1 - ey0) - (y1 - y0) * (ex1 - ex0), 0) AS c FROM line CROSS JOIN edge),
tested AS (SELECT *, ((ex0 - x0) * (ey1 - ey0) - (ey0 - y0) * (ex1 - ex0)) / c AS t, ((ex0 - x0) * (y1 - y0) - (ey0 - y0) * (x1 - x0)) / c AS u,
  (ey0 > y0) <> (ey1 > y0) AND x0 < (ex1 - ex0) * (y0 - ey0) / nullif(ey1 - ey0, 0) + ex0 AS ray,
  least({_gap_sql("x0", "y0", "ex0", "ey0", "ex1", "ey1")}, {_gap_sql("x1", "y1", "ex0", "ey0", "ex1", "ey1")},
        {_gap_sql("ex0", "ey0", "x0", "y0", "x1", "y1")}, {_gap_sql("ex1", "ey1", "x0", "y0", "x1", "y1")}) AS gap FROM crossing),
met AS (SELECT n, any_value(sid) AS sid, any_value(lo) AS lo, any_value(hi) AS hi, any_value({_gap_sql("0", "0", "x0", "y0", "x1", "y1")}) AS ref,
  coalesce(list_sort(list(t) FILTER (t BETWEEN 0 AND 1 AND u >= 0 AND u < 1)), []) AS ts, count(*) FILTER (ray) % 2 = 1 AS starts_in, min(gap) AS gap FROM tested GROUP BY n),
span AS (
  SELECT sid, make_timestamp(CAST(trunc(epoch_us(lo) + p * (epoch_us(hi) - epoch_us(lo))) AS BIGINT)) AS entry, make_timestamp(CAST(trunc(epoch_us(lo) + q * (epoch_us(hi) - epoch_us(lo))) AS BIGINT)) AS exit
  FROM (SELECT *, marks[i] AS p, marks[i + 1] AS q FROM (SELECT *, list_concat(list_concat([0::DOUBLE], ts), [1::DOUBLE]) AS marks, unnest(range(1, len(ts) + 2)) AS i FROM met))
  WHERE q > p AND (i % 2 = 1) = starts_in),
fact AS (SELECT sid, min(ref) / 1000 AS ref, min(CASE WHEN starts_in OR len(ts) > 0 THEN 0 ELSE gap / 1000 END) AS gap FROM met GROUP BY sid)
"""


@query("g10_region_events", f"""
WITH {TRACKS}, {SEGMENTS}, {ENCOUNTERS},
p AS (SELECT sid, entry, exit, greatest(TIMESTAMP '2024-01-03', date_trunc('hour', entry) - INTERVAL 12 HOUR) AS lo,
  least(TIMESTAMP '2024-01-28', make_timestamp((epoch_us(exit) + 3599999999) // 3600000000 * 3600000000) + INTERVAL 24 HOUR) AS hi FROM span WHERE entry < TIMESTAMP '2024-01-28'),
r AS (SELECT *, max(hi) OVER (PARTITION BY sid ORDER BY entry, exit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM p),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach THEN 1 ELSE 0 END) OVER (PARTITION BY sid ORDER BY entry, exit ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM r),
e AS (SELECT sid, k, min(entry) AS entry, max(exit) AS exit, min(lo)::TIMESTAMP AS start, max(hi)::TIMESTAMP AS "end" FROM i GROUP BY sid, k)
SELECT sid || '-' || k AS event_id, sid, CAST(round(epoch_us(entry) / 1000000.0) AS BIGINT) AS entry_s, CAST(round(epoch_us(exit) / 1000000.0) AS BIGINT) AS exit_s, start, "end",
  coalesce(name, sid) AS name, round(ref, 2) AS closest_to_reference_km FROM e JOIN fact USING (sid) LEFT JOIN named USING (sid)""")
def g10(spark, folder):
    """Padded events of all tracks on the local equidistant plane."""
    second = lambda c: F.round(F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000.0).cast("long").alias(f"{c}_s")
    return st.select_events(_fixes(spark, folder), *_STUDY)[0].select("event_id", "sid", second("entry"), second("exit"), "start", "end", "name", "closest_to_reference_km")


@query("k05_nearby_storms", f"""
WITH {TRACKS}, {SEGMENTS}, {ENCOUNTERS}
SELECT sid, coalesce(name, sid) AS name, round(gap, 2) AS distance_to_region_km FROM fact LEFT JOIN named USING (sid)
WHERE gap <= 100 AND NOT EXISTS (SELECT 1 FROM span WHERE span.sid = fact.sid)""")
def k05(spark, folder):
    return st.select_events(_fixes(spark, folder), *_STUDY)[1]


@query("w08_event_windows", f"""
WITH {STORMS},
e AS (SELECT 'N' || c_nationkey AS sid, start AS entry, "end" AS exit FROM storms JOIN customer ON event_id = 'S' || c_custkey),
p AS (SELECT sid, entry, exit, greatest(TIMESTAMP '2024-01-03', date_trunc('hour', entry) - INTERVAL 12 HOUR) AS lo,
  least(TIMESTAMP '2024-01-28', make_timestamp((epoch_us(exit) + 3599999999) // 3600000000 * 3600000000) + INTERVAL 24 HOUR) AS hi FROM e WHERE entry < TIMESTAMP '2024-01-28'),
r AS (SELECT *, max(hi) OVER (PARTITION BY sid ORDER BY entry, exit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM p),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach THEN 1 ELSE 0 END) OVER (PARTITION BY sid ORDER BY entry, exit) AS k FROM r)
SELECT sid || '-' || k AS event_id, sid, min(entry) AS entry, max(exit) AS exit, min(lo)::TIMESTAMP AS start, max(hi)::TIMESTAMP AS "end" FROM i GROUP BY sid, k""")
def w08(spark, folder):
    c = table(spark, folder, "customer").select(F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("event_id"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("sid"))
    spans = storm_events(spark, folder).join(c, "event_id").select("sid", F.col("start").alias("entry"), F.col("end").alias("exit"))
    return st.event_windows(spans, *_STUDY)


@query("k01_closest_storms", """
SELECT 'N' || c_nationkey AS sid, min(round(abs(c_acctbal), 2)) AS closest_to_reference_km FROM customer GROUP BY 1 ORDER BY 2, 1 LIMIT 10""")
def k01(spark, folder):
    events = table(spark, folder, "customer").select(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("sid"), F.round(F.abs("c_acctbal"), 2).alias("closest_to_reference_km"))
    return st.closest_storms(events, 10)


_NAMED = ", ".join(f"('{s}', TIMESTAMP '{a.replace('T', ' ').rstrip('Z')}', TIMESTAMP '{b.replace('T', ' ').rstrip('Z')}')" for s, _, a, b in st.STORMS)


@query("e02_named_storm_hours", f"""
WITH {OBSERVATIONS}, s(storm, a, b) AS (VALUES {_NAMED}),
h AS (SELECT storm, unnest(generate_series(a, b - INTERVAL 1 MICROSECOND, INTERVAL 1 HOUR)) AS hour FROM s),
o AS (SELECT date_trunc('hour', time - INTERVAL 873 DAY)::TIMESTAMP AS hour, count(*) AS n FROM observations GROUP BY 1)
SELECT storm, hour, coalesce(n, 0) AS observations FROM h LEFT JOIN o USING (hour)""")
def e02(spark, folder):
    """Observations (moved back 873 days, into the first named storm) per storm hour."""
    moved = observations(spark, folder).select(F.date_trunc("hour", F.col("time") - F.expr("interval 873 days")).cast("timestamp_ntz").alias("hour"))
    counts = moved.groupBy("hour").agg(F.count(F.lit(1)).alias("n"))
    hours = st.storm_hours(st.storm_table(spark)).select("storm", "hour")
    return hours.join(counts, "hour", "left").select("storm", "hour", F.coalesce("n", F.lit(0)).alias("observations"))


def _cube(spark, folder):
    frames = raster_frames(spark, folder).select("vec_id", "time", "variable", "label")
    times = event_hours(storm_events(spark, folder)).select(F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(5)), lambda i: F.timestamp_micros(F.unix_micros(F.col("hour").cast("timestamp")) + i.cast("long") * 600_000_000).cast("timestamp_ntz"))).alias("time"))
    first = frames.filter("label < 5").withColumns({"src_ord": F.lit(0), "provenance": F.lit("first")})
    second = frames.withColumns({"src_ord": F.lit(1), "provenance": F.lit("second")})
    corrected = frames.filter("label > 7").withColumn("provenance", F.lit("corrected"))
    return st.cube_records(times, first.unionByName(second), corrected, ["variable"])


_CUBE = """
st AS (SELECT DISTINCT hour + to_minutes(o) AS time FROM storm_hours CROSS JOIN (SELECT unnest(range(0, 60, 10)) AS o)),
cube AS (SELECT vec_id, time, variable, 'uncorrected' AS variant, CASE WHEN label < 5 THEN 'first' ELSE 'second' END AS provenance FROM frames WHERE time IN (SELECT time FROM st)
  UNION ALL SELECT vec_id, time, variable, 'corrected', 'corrected' FROM frames WHERE label > 7 AND time IN (SELECT time FROM st))
"""


@query("e04_storm_cube", f"WITH {FRAMES}, {STORMS}, {_CUBE} SELECT vec_id, time, variable, variant, provenance FROM cube")
def e04(spark, folder):
    return _cube(spark, folder).select("vec_id", "time", "variable", "variant", "provenance")


@query("e05_window_read", f"""
WITH {FRAMES}, h AS (SELECT DISTINCT date_trunc('hour', time)::TIMESTAMP AS hour FROM frames),
w AS (SELECT hour FROM h JOIN (SELECT DISTINCT time FROM frames) f ON f.time BETWEEN hour - INTERVAL 50 MINUTE AND hour + INTERVAL 60 MINUTE GROUP BY hour HAVING count(*) = 12)
SELECT w.hour, f.time, f.vec_id FROM w JOIN frames f ON f.time BETWEEN w.hour - INTERVAL 50 MINUTE AND w.hour + INTERVAL 60 MINUTE""")
def e05(spark, folder):
    cube = raster_frames(spark, folder).select("vec_id", "time", "variable").withColumn("variant", F.lit("uncorrected"))
    edges = cube.agg(F.min("time").alias("a"), F.max("time").alias("b"))
    hours = cube.select(F.date_trunc("hour", "time").cast("timestamp_ntz").alias("hour")).distinct()
    inside = hours.join(F.broadcast(edges), (F.col("hour") - F.expr("interval 50 minutes") >= F.col("a")) & (F.col("hour") + F.expr("interval 60 minutes") <= F.col("b")))
    return st.read_window(cube, inside, "uncorrected").select("hour", "time", "vec_id")


# --- studies -----------------------------------------------------------------------------------------
_BANDS = "[1, 2, 3, 7, 8, 9, 10, 13]"


def _scenario_sql(n):
    return f"""
src{n} AS (SELECT key, time, band8, size, satellite, epoch_us(time) AS u, epoch_us(date_trunc('hour', time)) AS h FROM listed),
pick{n} AS (
  SELECT h, band8, 0 AS mark, (SELECT NULL::VARCHAR[]) AS used FROM (SELECT DISTINCT h, band8 FROM src{n})
  UNION ALL
  SELECT p.h, p.band8, p.mark + 1, list_append(coalesce(p.used, []), (
    SELECT arg_min(s.key, (abs(s.u - p.h - p.mark::BIGINT * {3_600_000_000 // n}), s.u, s.key)) FROM src{n} s
    WHERE s.h = p.h AND s.band8 = p.band8 AND NOT list_contains(coalesce(p.used, []), s.key)))
  FROM pick{n} p WHERE p.mark < {n}),
kept{n} AS (SELECT DISTINCT key FROM (SELECT unnest(used) AS key FROM pick{n} WHERE mark = {n}) WHERE key IS NOT NULL)"""


_A18 = f"""
WITH RECURSIVE {OBSERVATIONS}, listed AS (SELECT *, {_BANDS}[band] AS band8 FROM observations), {_scenario_sql(1)}, {_scenario_sql(3)}, {_scenario_sql(6)},
k AS (SELECT 'eight_1ph' AS scenario, 8 AS per_hour, l.* FROM listed l JOIN kept1 USING (key) UNION ALL SELECT 'eight_3ph', 24, l.* FROM listed l JOIN kept3 USING (key)
  UNION ALL SELECT 'eight_6ph', 48, l.* FROM listed l JOIN kept6 USING (key) UNION ALL SELECT 'sixteen_6ph', 96, l.* FROM listed l JOIN kept6 USING (key))
"""


def _kept(spark, folder):
    rows = observations(spark, folder)
    bands = F.array(*[F.lit(b) for b in sd.EIGHT_BANDS])
    return sd.scenario_assets(rows.withColumn("band", F.element_at(bands, F.col("band"))))


@query("a18_scenario_months", f"""{_A18}
SELECT scenario, strftime(time, '%Y-%m') AS month, count(*) AS band_files, count(DISTINCT time) AS distinct_scan_times, sum(size)::BIGINT AS listed_bytes,
  CAST(744 * any_value(per_hour) AS BIGINT) AS nominal_files, greatest(0, CAST(744 * any_value(per_hour) AS BIGINT) - count(*)) AS missing_files FROM k GROUP BY scenario, month""")
def a18(spark, folder):
    return sd.scenario_months(_kept(spark, folder), START, END)


@query("a18_scenario_counts", f"""{_A18} SELECT scenario, strftime(time, '%Y-%m') AS month, satellite, band8 AS band, count(*) AS files FROM k GROUP BY ALL""")
def a18c(spark, folder):
    return sd.scenario_counts(_kept(spark, folder))


_COUNTS = """
c AS (SELECT variable AS scenario, satellite, band, count(*) AS files FROM observations GROUP BY ALL),
q AS (SELECT satellite, band, quantile_cont(size::DOUBLE, 0.1) AS low, quantile_cont(size::DOUBLE, 0.5) AS central, quantile_cont(size::DOUBLE, 0.9) AS high FROM observations WHERE NOT (band = 8 AND satellite = 1) GROUP BY ALL)
"""


@query("a19_size_estimate", f"""
WITH {OBSERVATIONS}, {_COUNTS}
SELECT scenario, CASE WHEN bool_and(central IS NOT NULL) THEN round(sum(files * (low + 2048)), 3) END AS low, CASE WHEN bool_and(central IS NOT NULL) THEN round(sum(files * (central + 2048)), 3) END AS central,
  CASE WHEN bool_and(central IS NOT NULL) THEN round(sum(files * (high + 2048)), 3) END AS high
FROM (SELECT * FROM c WHERE scenario <> 'click' OR NOT (band = 8 AND satellite = 1)) LEFT JOIN q USING (satellite, band) GROUP BY scenario""")
def a19(spark, folder):
    rows = observations(spark, folder)
    counts = rows.groupBy(F.col("variable").alias("scenario"), "satellite", "band").agg(F.count(F.lit(1)).alias("files"))
    counts = counts.filter("scenario <> 'click' or not (band = 8 and satellite = 1)")
    samples = rows.filter("not (band = 8 and satellite = 1)")
    out = sd.size_estimate(counts, samples, "size", sd.PROVENANCE_BYTES)
    return out.select("scenario", *[F.round(c, 3).alias(c) for c in ("low", "central", "high")])


_RUNS = "r AS (SELECT o_orderpriority AS product, CAST(o_custkey % 4 + 1 AS INTEGER) AS writers, CAST(o_custkey % 3 + 1 AS INTEGER) AS workers, o_totalprice AS seconds FROM orders WHERE o_orderstatus <> 'P'), m AS (SELECT product, writers, workers, quantile_cont(seconds, 0.5) AS median FROM r GROUP BY ALL)"


def _runs(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("product"), (F.col("o_custkey") % 4 + 1).cast("int").alias("writers"), (F.col("o_custkey") % 3 + 1).cast("int").alias("workers"),
        F.col("o_totalprice").alias("seconds"), (F.col("o_orderstatus") != "P").alias("verified"))



@query("a30_chosen_configuration", f"""
WITH {_RUNS}, b AS (SELECT *, min(median) OVER (PARTITION BY product) AS best FROM m)
SELECT product, writers, workers, round(median, 6) AS median FROM b WHERE median <= best * 1.05 QUALIFY row_number() OVER (PARTITION BY product ORDER BY writers * workers, writers) = 1""")
def a30(spark, folder):
    load = [F.col("writers") * F.col("workers"), F.col("writers")]
    return sd.choose_configuration(_runs(spark, folder), ["writers", "workers"], load, keys=["product"]).withColumn("median", F.round("median", 6))


@query("a30_finalists", f"""
WITH {_RUNS}, b AS (SELECT *, min(median) OVER (PARTITION BY product) AS best FROM m),
p AS (SELECT product, writers, workers, median, 'preferred' AS role FROM b WHERE median <= best * 1.05 QUALIFY row_number() OVER (PARTITION BY product ORDER BY writers * workers, writers) = 1),
a AS (SELECT m.product, m.writers, m.workers, m.median, 'alternative' AS role FROM m WHERE (product, writers, workers) NOT IN (SELECT (product, writers, workers) FROM p)
  QUALIFY row_number() OVER (PARTITION BY product ORDER BY median, writers, workers) = 1)
SELECT product, writers, workers, round(median, 6) AS median, role FROM p UNION ALL SELECT product, writers, workers, round(median, 6), role FROM a""")
def a30f(spark, folder):
    load = [F.col("writers") * F.col("workers"), F.col("writers")]
    return sd.finalist_configurations(_runs(spark, folder), ["writers", "workers"], load, keys=["product"]).withColumn("median", F.round("median", 6))


@query("a37_parallax_comparison", f"""
WITH {SATELLITE},
b AS (SELECT variable, phys::DOUBLE AS p, phys::DOUBLE + l_linenumber / 10.0::DOUBLE AS m, class = 0 AS pv, class = 0 AND x > 3 AS mv FROM decoded),
l AS (SELECT variable, unnest([p, m]) AS v FROM b WHERE pv AND mv)
SELECT b.variable, round(avg(m - p) FILTER (pv AND mv), 5) AS mean_difference, round(max(abs(m - p)) FILTER (pv AND mv), 5) AS "limit", round(avg(CASE WHEN pv AND mv THEN 1.0 ELSE 0.0 END), 9) AS common_share,
  (SELECT round(quantile_cont(v, 0.02), 5) FROM l WHERE l.variable = b.variable) AS low, (SELECT round(quantile_cont(v, 0.98), 5) FROM l WHERE l.variable = b.variable) AS high FROM b GROUP BY b.variable""")
def a37(spark, folder):
    rows = px.decode_satellite(satellite_pixels(spark, folder))
    plain = F.col("value").cast("double")
    cells = rows.select("variable", plain.alias("plain"), F.col("valid").alias("plain_valid"), (plain + F.col("l_linenumber") / 10.0).alias("moved"), (F.col("valid") & (F.col("x") > 3)).alias("moved_valid"))
    out = sd.compare_parallax(cells, ["variable"])
    return out.select("variable", *[F.round(c, 5).alias(c) for c in ("mean_difference", "limit", "low", "high")], F.round("common_share", 9).alias("common_share"))


@query("x05_pilot_observations", f"""
WITH {OBSERVATIONS},
m AS (SELECT variable, asset_id, time, h, row_number() OVER (PARTITION BY variable, h ORDER BY abs(hour(time) - h), time, asset_id) AS r FROM observations CROSS JOIN (SELECT unnest([4, 16]) AS h))
SELECT DISTINCT variable, asset_id, time FROM m WHERE r = 1""")
def x05(spark, folder):
    return sd.pilot_observations(observations(spark, folder))


@query("x05_pilot_displacement", f"""
WITH {_CLOUDS},
d AS (SELECT variable, sqrt(pow((lon2 - lon) * cos(radians(lat)) * 111.32, 2) + pow((lat2 - lat) * 110.57, 2)) AS km FROM moved WHERE movable)
SELECT variable, round(max(km), 5) AS max_km, round(quantile_cont(km, 0.5), 5) AS median_km FROM d GROUP BY variable""")
def x05d(spark, folder):
    km = F.hypot((F.col("lon2") - F.col("lon")) * F.cos(F.radians("lat")) * 111.32, (F.col("lat2") - F.col("lat")) * 110.57)
    out = sd.pilot_displacement(_moved(spark, folder).select("variable", "valid", km.alias("displacement_km")), ["variable"])
    return out.select("variable", F.round("max_km", 5).alias("max_km"), F.round("median_km", 5).alias("median_km"))


