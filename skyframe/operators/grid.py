"""Grids and regridding: target grid, interpolation maps, long and array application, frames per slot.

A map belongs to a pair of grids and its size is fixed by them (four entries per target cell). The array form keeps one row
per frame and needs no shuffle at all, for maps of a checked size; the tiled form is for any size; the long form is for
selected pixels.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.functions import decode as dc
from skyframe.functions import geo
from skyframe.functions.checks import guard
from skyframe.session import written

WEIGHT_FLOOR = 1e-7  # a contributor this light need not be valid
AXIS_MOST = 1 << 16  # coordinates of a native axis
PACKED_MOST = 1 << 20  # target cells of a map that is packed into one row and broadcast, some 70 bytes each
TILED_MOST = 1 << 22  # entries of a tiled map that is broadcast, some 16 bytes each
TILE = 128  # cells along the side of a tile


def target_grid(spark: SparkSession, resolution_km: int = 3, box=geo.REGION) -> DataFrame:
    """Cell centres of the regional Lambert grid with lon/lat and an inside-the-box flag."""
    if resolution_km not in (1, 2, 3):
        raise ValueError("The resolution must be 1, 2 or 3 km")
    left, bottom, right, top = geo.grid_bounds(box)
    spacing = resolution_km * 1000
    nx, ny = (right - left) // spacing, (top - bottom) // spacing
    cells = spark.range(nx * ny).withColumnRenamed("id", "target_cell")
    y, x = F.floor(F.col("target_cell") / nx).cast("int"), (F.col("target_cell") % nx).cast("int")
    x_m, y_m = F.lit(left + spacing / 2) + x * spacing, F.lit(top - spacing / 2) - y * spacing
    lon, lat = geo.regional_lambert().inverse_columns(F.col("x_m"), F.col("y_m"))
    rows = cells.withColumns({"y": y, "x": x, "x_m": x_m, "y_m": y_m}).withColumns({"lon": lon, "lat": lat})
    west, south, east, north = box
    return rows.withColumn("inside", F.col("lon").between(west, east) & F.col("lat").between(south, north))


def grid_shape(resolution_km: int, box=geo.REGION) -> tuple[int, int]:
    """Rows and columns of the target grid."""
    left, bottom, right, top = geo.grid_bounds(box)
    return (top - bottom) // (resolution_km * 1000), (right - left) // (resolution_km * 1000)


def axis_values(axis: DataFrame) -> tuple[list[float], int, int]:
    """An axis (index, coord) as rising coordinates, the index of the least one and the step of the index along them."""
    rows = axis.select("index", "coord").orderBy("index").limit(AXIS_MOST + 1).collect()
    if len(rows) > AXIS_MOST:
        raise ValueError(f"An axis has at most {AXIS_MOST} coordinates")
    coords = [r.coord for r in rows]
    if any(b["index"] - a["index"] != 1 for a, b in zip(rows, rows[1:])) or any(c is None or not math.isfinite(c) for c in coords):
        raise ValueError("Native coordinates must be finite and without gaps")
    steps = [b > a for a, b in zip(coords, coords[1:]) if a != b]
    if len(steps) < len(coords) - 1 or len(set(steps)) > 1:
        raise ValueError("Native coordinates must be strictly monotonic")
    return (coords, rows[0]["index"] if rows else 0, 1) if not steps or steps[0] else (coords[::-1], rows[-1]["index"], -1)


def fractional_index(points: DataFrame, axis: DataFrame, coordinate: str, name: str) -> DataFrame:
    """Position of a coordinate on a strictly monotonic axis (index, coord), NULL outside it and for NULL and NaN.

    The axis is one-dimensional and bounded, so it goes into the plan as one sorted array; every row searches it by halving,
    without an exchange.
    """
    coords, start, step = axis_values(axis)
    if not coords:
        return points.withColumn(name, F.lit(None).cast("double"))
    known = F.split(F.lit(",".join(map(repr, coords))), ",").cast("array<double>")
    x, n = F.col(coordinate).cast("double"), len(coords)
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, n.bit_length())))])
    place = F.aggregate(halves, F.lit(0), lambda at, more: F.when((at + more < n) & (F.get(known, at + more) <= x), at + more).otherwise(at))
    rows = points.withColumn("_place", F.when((x >= coords[0]) & (x <= coords[-1]), place))
    here, after = F.get(known, F.col("_place")), F.get(known, F.col("_place") + 1)
    share = F.coalesce((x - here) / (after - here), F.lit(0.0))
    return rows.withColumn(name, start + F.col("_place") * step + share * step).drop("_place")


def interpolation_map(targets: DataFrame, x_axis: DataFrame, y_axis: DataFrame, nx: int, ny: int, method: str = "bilinear",
                      tx: str = "tx", ty: str = "ty", inside: str = "inside") -> DataFrame:
    """Per target cell its contributing source cells as arrays: ``cells``, ``weights``, ``nearest`` and
    ``support``. Bilinear has four contributors, nearest one."""
    if min(nx, ny) < 2:
        raise ValueError("At least two source coordinates per axis are needed")
    rows = fractional_index(fractional_index(targets, x_axis, tx, "_ix"), y_axis, ty, "_iy")
    support = F.col("_ix").isNotNull() & F.col("_iy").isNotNull() & F.col(inside)
    ix, iy = F.coalesce("_ix", F.lit(0.0)), F.coalesce("_iy", F.lit(0.0))
    nearest = (F.rint(iy) * nx + F.rint(ix)).cast("int")
    if method == "nearest":
        cells, weights = F.array(nearest), F.array(F.lit(1.0).cast("float"))
    elif method == "bilinear":
        x0 = F.least(F.floor(ix), F.lit(nx - 2)).cast("int")
        y0 = F.least(F.floor(iy), F.lit(ny - 2)).cast("int")
        dx, dy = ix - x0, iy - y0
        base = y0 * nx + x0
        cells = F.array(base, base + 1, base + nx, base + nx + 1)
        weights = F.array(*[w.cast("float") for w in ((1 - dx) * (1 - dy), dx * (1 - dy), (1 - dx) * dy, dx * dy)])
    else:
        raise ValueError("Choose bilinear or nearest")
    return rows.select("target_cell", cells.alias("cells"), weights.alias("weights"), nearest.alias("nearest"), support.alias("support"))


def sparse_map(mapping: DataFrame) -> DataFrame:
    """The map in long form: one row per (target cell, source cell)."""
    heavy = F.size(F.filter("weights", lambda w: w > WEIGHT_FLOOR))
    rows = mapping.select("target_cell", "support", "nearest", heavy.alias("heavy"), F.explode(F.arrays_zip("cells", "weights")).alias("e"))
    return rows.select("target_cell", F.col("e.cells").alias("source_cell"), F.col("e.weights").alias("weight"),
                       (F.col("e.cells") == F.col("nearest")).alias("is_nearest"), "support", "heavy")


def regrid_long(pixels: DataFrame, sparse: DataFrame, frame: list[str], cell: str = "source_cell") -> DataFrame:
    """G03 long form: value is the weighted sum, valid only where every real contributor is; quality and
    class come from the nearest source cell."""
    joined = pixels.join(sparse.withColumnRenamed("source_cell", cell), cell)
    part = F.when(F.col("valid"), F.col("value").cast("double") * F.col("weight")).otherwise(F.lit(0.0))
    near = F.when(F.col("is_nearest"), F.struct("quality", "class"))
    out = joined.groupBy(*frame, "target_cell").agg(
        F.sum(part).alias("_sum"), F.count_if(F.col("valid") & (F.col("weight") > WEIGHT_FLOOR)).alias("_have"),
        F.first("heavy").alias("_need"), F.first("support").alias("source_support"), F.max(near).alias("_near"))
    ok = (F.col("_have") == F.col("_need")) & F.col("source_support")
    return out.select(*frame, "target_cell", F.when(ok, F.col("_sum").cast("float")).alias("value"), ok.alias("valid"),
                      F.col("_near.quality").alias("quality"), F.col("_near.class").alias("class"), "source_support")


def pack_map(mapping: DataFrame, grid_id: str) -> DataFrame:
    """One row holding the whole map of a grid pair, cells in order. A map of more than ``PACKED_MOST`` target cells fails the
    job: it would be neither gathered nor broadcast; ``regrid_tiles`` is for those."""
    entry = F.struct("target_cell", "cells", "weights", "nearest", "support")
    counted = mapping.groupBy(F.lit(grid_id).alias("grid_id")).agg(F.count("*").alias("_n"))
    small = guard(counted, F.col("_n") <= PACKED_MOST, "The map is too large to be packed; regrid by tiles")
    rows = mapping.crossJoin(F.broadcast(small))  # one row, checked before any map row is gathered
    return rows.groupBy("grid_id").agg(F.sort_array(F.collect_list(entry)).alias("lut"))


def regrid_frames(frames: DataFrame, packed: DataFrame) -> DataFrame:
    """G03 array form: frames (grid_id, values, valid, quality, classes as row-major arrays) to the target
    grid, one row in, one row out, in one pass over the map. ``packed`` holds one row per pair of grids, of checked size, so
    it is broadcast. A source cell that is NULL in ``valid`` is absent; ``touched`` says which targets have a present one."""
    rows = frames.join(F.broadcast(packed), "grid_id", "left")
    pairs = F.arrays_zip

    def cell(m):
        usable = m["support"] & F.forall(pairs(m["cells"], m["weights"]), lambda e: (e["weights"] <= WEIGHT_FLOOR) | F.coalesce(F.get("valid", e["cells"]), F.lit(False)))
        total = F.aggregate(pairs(m["cells"], m["weights"]), F.lit(0.0), lambda acc, e: acc + F.when(
            F.get("valid", e["cells"]), F.get("values", e["cells"]).cast("double") * e["weights"]).otherwise(F.lit(0.0)))
        return F.struct(
            usable.alias("valid"), F.when(usable, total.cast("float")).alias("values"), F.get("quality", m["nearest"]).alias("quality"),
            F.get("classes", m["nearest"]).alias("classes"), m["support"].alias("source_support"),
            F.exists(m["cells"], lambda c: F.get("valid", c).isNotNull()).alias("touched"))

    kept = [c for c in frames.columns if c not in ("values", "valid", "quality", "classes")]
    done = rows.select(*kept, F.transform("lut", cell).alias("_cells"))
    return done.select(*kept, *[F.col(f"_cells.{c}").alias(c) for c in ("values", "valid", "quality", "classes", "source_support", "touched")])


def dense_frames(pixels: DataFrame, frame: list[str], cell: str, cells: int, columns: list[str], first_by: list[str]) -> DataFrame:
    """Frames as arrays of ``cells`` entries from pixel rows: the first pixel of a cell by ``first_by``, NULL where there is none.
    The pixels are dealt out by frame once."""
    own = pixels.filter(F.col(cell).between(0, cells - 1)).repartition(*[F.col(c) for c in frame])
    picked = own.groupBy(*frame, cell).agg(F.min_by(F.struct(*columns), F.struct(*first_by)).alias("_p"))
    rows = picked.groupBy(*frame).agg(F.sort_array(F.collect_list(F.struct(F.col(cell).cast("int").alias("c"), "_p"))).alias("_s"))
    # Between a cell and the next one there are as many gaps as cells are missing.
    after = F.concat(F.transform(F.slice("_s", 2, F.size("_s")), lambda e: e["c"]), F.array(F.lit(cells)))
    gap = F.struct(*[F.lit(None).cast(pixels.schema[c].dataType).alias(c) for c in columns])
    nothing = F.when(F.lit(False), gap)  # a NULL of the same type
    filled = F.flatten(F.transform(F.arrays_zip(F.col("_s").alias("s"), after.alias("n")), lambda e: F.concat(
        F.array(e["s"]["_p"]), F.array_repeat(nothing, e["n"] - e["s"]["c"] - 1))))
    rows = rows.withColumn("_all", F.concat(F.array_repeat(nothing, F.col("_s")[0]["c"]), filled))
    return rows.select(*frame, *[F.col(f"_all.{c}").alias(c) for c in columns])


def _tile(cell: Column, nx: int, side: int) -> tuple[Column, Column]:
    """Tile of a row-major cell, and its place inside; places of edge tiles use the same stride."""
    y, x = F.floor(cell / nx), cell % nx
    return (F.floor(y / side) * math.ceil(nx / side) + F.floor(x / side)).cast("int"), (y % side * side + x % side).cast("int")


def tile_map(mapping: DataFrame, nx: int, target_nx: int, side: int = TILE) -> tuple[DataFrame, DataFrame]:
    """A map cut by target and source tiles: entries (target and source place, weight, nearest) per pair of tiles, and per
    target tile what its cells need. Written once; a row is bounded by the area of a tile."""
    target_tile, target = _tile(F.col("target_cell"), target_nx, side)
    heavy = F.size(F.filter("weights", lambda w: w > WEIGHT_FLOOR))
    rows = mapping.withColumns({"target_tile": target_tile, "to": target, "need": heavy})
    need = F.struct("to", "target_cell", "need", "support")
    needs = rows.groupBy("target_tile").agg(F.sort_array(F.collect_list(need)).alias("needs"))
    flat = rows.select("target_tile", "to", "nearest", F.explode(F.arrays_zip("cells", "weights")).alias("e"))
    source_tile, source = _tile(F.col("e.cells"), nx, side)
    entry = F.struct("to", source.alias("from"), F.col("e.weights").alias("weight"), (F.col("e.cells") == F.col("nearest")).alias("near"))
    tiles = flat.groupBy("target_tile", source_tile.alias("source_tile")).agg(F.collect_list(entry).alias("entries"))
    return written(tiles, "tiles"), written(needs, "needs")


def tile_frames(frames: DataFrame, frame: list[str], nx: int, ny: int, side: int = TILE) -> DataFrame:
    """Frames as row-major arrays cut into tiles: ``frame`` (a struct), ``source_tile`` and arrays of the tile's places."""
    across, down = math.ceil(nx / side), math.ceil(ny / side)
    tile = F.explode(F.sequence(F.lit(0), F.lit(across * down - 1))).alias("source_tile")
    rows = frames.select(F.struct(*frame).alias("frame"), "values", "valid", "quality", "classes", tile)
    top, left = F.floor(F.col("source_tile") / across) * side, F.col("source_tile") % across * side

    def cut(name):
        def line(y):
            some = F.slice(name, (y * nx + left + 1).cast("int"), F.least(F.lit(side), nx - left).cast("int"))
            return F.concat(some, F.array_repeat(F.when(F.lit(False), F.get(name, F.lit(0))), (side - F.size(some)).cast("int")))
        return F.flatten(F.transform(F.sequence(top, F.least(top + side, F.lit(ny)) - 1), line)).alias(name)

    return rows.select("frame", "source_tile", *[cut(c) for c in ("values", "valid", "quality", "classes")])


def regrid_tiles(tiles: DataFrame, tiled: tuple[DataFrame, DataFrame], side: int = TILE) -> DataFrame:
    """G03 tiled form, for maps and frames that neither a broadcast nor a task can hold: ``frame``, ``target_tile`` and, per target
    cell, ``target_cell``, ``value``, ``valid``, ``quality``, ``class`` and ``source_support``.

    Frame tiles meet map tiles by source tile, are weighted there, and only sums per target place go on to the target
    tile. The map is broadcast if it has at most ``TILED_MOST`` entries; beyond, frames are salted so that the few source tiles
    do not bound the number of tasks.
    """
    entries, needs = tiled
    size = entries.agg(F.sum(F.size("entries")), F.countDistinct("source_tile")).first()
    if (size[0] or 0) <= TILED_MOST:
        joined = tiles.join(F.broadcast(entries), "source_tile")
    else:
        parts = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = max(1, math.ceil(parts / size[1]))
        salted = entries.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
        joined = tiles.withColumn("_salt", F.pmod(F.xxhash64("frame"), F.lit(salts)).cast("int")).join(salted, ["source_tile", "_salt"])
    area = side * side
    names = ["frame", "target_tile", "sums", "have", "quality", "classes"]

    def numbers(column, fill):
        flat = column.values if hasattr(column, "values") else column
        return np.asarray(flat.fill_null(fill).to_numpy(zero_copy_only=False))

    def weigh(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                entry = row.column("entries").flatten()
                to, source, weight, near = (entry.field(k).to_numpy(zero_copy_only=False) for k in range(4))
                valid = numbers(row.column("valid").flatten(), False)[source]
                value = numbers(row.column("values").flatten(), 0.0)[source].astype(np.float64)
                sums = np.bincount(to, np.where(valid, value * weight, 0.0), minlength=area)
                have = np.bincount(to[valid & (weight > WEIGHT_FLOOR)], minlength=area)
                codes = []
                for c in ("quality", "classes"):
                    flat = row.column(c).flatten()
                    at, out = source[near], np.zeros(area, np.int32)
                    out[to[near]] = numbers(flat, 0)[at]
                    missing = np.ones(area, bool)
                    missing[to[near]] = flat.is_null().to_numpy(zero_copy_only=False)[at]
                    codes.append(pa.array(out, mask=missing))
                lists = [pa.ListArray.from_arrays([0, area], x) for x in (pa.array(sums), pa.array(have.astype(np.int32)), *codes)]
                yield pa.RecordBatch.from_arrays([row.column("frame"), row.column("target_tile"), *lists], names=names)

    kind = T.StructType([tiles.schema["frame"], T.StructField("target_tile", T.IntegerType()), T.StructField("sums", T.ArrayType(T.DoubleType())),
                         *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in names[3:]]])
    partial = joined.select("frame", "target_tile", "entries", F.col("values").cast("array<double>").alias("values"), "valid", F.col("quality").cast("array<int>").alias("quality"),
                            F.col("classes").cast("array<int>").alias("classes")).mapInArrow(weigh, kind)
    # A target tile meets only the source tiles around it, so a few partial rows come together.
    met = partial.groupBy("frame", "target_tile").agg(F.collect_list(F.struct(*names[2:])).alias("p"))

    def together(name, start, add):
        return F.aggregate(F.col(f"p.{name}"), F.array_repeat(start, area), lambda a, b: F.zip_with(a, b, add)).alias(name)

    added = met.select(
        "frame", "target_tile", together("sums", F.lit(0.0), lambda x, y: x + y), together("have", F.lit(0), lambda x, y: x + y),
        *[together(c, F.lit(None).cast("int"), lambda x, y: F.coalesce(x, y)) for c in ("quality", "classes")])

    def cell(e):
        ok = (F.get("have", e["to"]) == e["need"]) & e["support"]
        return F.struct(e["target_cell"].alias("target_cell"), F.when(ok, F.get("sums", e["to"]).cast("float")).alias("value"), ok.alias("valid"),
                        F.get("quality", e["to"]).alias("quality"), F.get("classes", e["to"]).alias("class"), e["support"].alias("source_support"))

    return added.join(needs, "target_tile").select("frame", "target_tile", F.transform("needs", cell).alias("cells"))


def slot_frames(spine: DataFrame, frames: DataFrame, packed: DataFrame, cells: int) -> DataFrame:
    """One target frame per slot and variable of the spine; an absent observation is an all-invalid
    frame with fill codes, so absent and invalid stay apart. Frames carry slot_time, variable, grid_id."""
    done = regrid_frames(frames, packed).withColumn("_there", F.lit(True))
    out = spine.join(done, ["slot_time", "variable"], "left")

    def fill(name, value, kind):
        return F.coalesce(F.col(name), F.array_repeat(F.lit(value).cast(kind), cells)).alias(name)

    return out.select("slot_time", "variable", F.coalesce("_there", F.lit(False)).alias("observed"),
                      fill("values", None, "float"), fill("valid", False, "boolean"), fill("quality", 255, "int"),
                      fill("classes", 255, "int"), fill("source_support", False, "boolean"))


def radar_recipe(frames: DataFrame, packed: DataFrame, recipe: str) -> DataFrame:
    """Frames (grid_id, product, raw, bitmap) to the target grid. ``mask_first`` drops gaps and sentinels before
    interpolating; ``mask_late`` interpolates whatever the bitmap keeps and then drops negatives. Masking, weighting and the
    choice of codes are array passes within a frame's row. Cell edges follow this map, not a raster library's."""
    if recipe not in ("mask_first", "mask_late"):
        raise ValueError("Choose mask_first or mask_late")
    rows = dc.with_product(frames)

    def keep(p):
        present = (p["bitmap"] == 1) & dc.finite(p["raw"])
        if recipe == "mask_first":
            present = present & (p["raw"] != F.col("missing")) & (p["raw"] != F.col("no_coverage"))
        return F.when(p["raw"].isNotNull() | p["bitmap"].isNotNull(), F.coalesce(present, F.lit(False)))

    rows = rows.select(*frames.columns, F.transform(F.arrays_zip("raw", "bitmap"), keep).alias("valid"), F.transform("raw", lambda v: v.cast("float")).alias("values"),
                       F.col("bitmap").alias("quality"), F.transform("bitmap", lambda b: F.lit(0)).alias("classes"))
    kept = [c for c in frames.columns if c not in ("raw", "bitmap")]
    out = regrid_frames(rows.drop("raw", "bitmap"), packed).select(*kept, "values", "valid", "touched")
    if recipe == "mask_late":
        out = out.withColumn("values", F.transform("values", lambda v: F.when(v >= 0, v)))
        out = out.withColumn("valid", F.transform("values", lambda v: v.isNotNull()))
    return out


def satellite_recipe(frames: DataFrame, packed: DataFrame | None, mask_quality: bool = True) -> DataFrame:
    """Decoded satellite frames (grid_id, value, quality, class) with an optional strict quality mask, reprojected
    when a map is given, all within a frame's row. A cell whose class is NULL is absent."""
    def keep(p):
        good = p["value"].isNotNull()
        if mask_quality:
            good = good & (p["quality"].isNull() | (p["quality"] == 0))
        return F.when(p["class"].isNotNull(), good)

    zipped = F.arrays_zip("value", "quality", "class")
    rows = frames.withColumn("valid", F.transform(zipped, keep))
    rows = rows.withColumn("values", F.transform(F.arrays_zip("value", "valid"), lambda p: F.when(p["valid"], p["value"])))
    rows = rows.withColumns({"quality": F.transform("quality", lambda q: F.coalesce(q, F.lit(255))), "classes": F.col("class")}).drop("value", "class")
    return rows if packed is None else regrid_frames(rows, packed)


def corrected_pixels(pixels: DataFrame, satellite_lon: float, height: float, resolution_km: int, correction: list[str],
                     frame: list[str], box=geo.REGION) -> DataFrame:
    """Pixels moved below their cloud tops and binned to the target grid, nearest to the cell centre
    winning. Heights need quality 0 and must not be negative; kilometres become metres; without a known
    height a pixel of a correctable variable is dropped, other variables are never shifted."""
    metres = F.when(F.col("height_unit") == "km", F.col("height") * 1000.0).otherwise(F.col("height"))
    known = (F.col("height_quality") == 0) & dc.finite(metres) & (metres >= 0)
    movable = F.col("variable").isin(correction)
    rows = pixels.withColumns({"_metres": metres, "known": F.coalesce(known, F.lit(False))})
    rows = geo.with_parallax(rows, "lon", "lat", "_metres", satellite_lon, height, "_lon2", "_lat2")
    rows = rows.withColumns({"lon2": F.when(movable, F.col("_lon2")).otherwise(F.col("lon")), "lat2": F.when(movable, F.col("_lat2")).otherwise(F.col("lat")),
                             "parallax_applied": movable})
    x, y = geo.regional_lambert().forward_columns(F.col("lon2"), F.col("lat2"))
    left, bottom, right, top = geo.grid_bounds(box)
    spacing = resolution_km * 1000
    nx, ny = (right - left) // spacing, (top - bottom) // spacing
    rows = rows.withColumns({"_x": x, "_y": y})
    rows = rows.withColumns({"_c": F.floor((F.col("_x") - left) / spacing), "_r": F.floor((F.lit(top) - F.col("_y")) / spacing)})
    off = F.hypot(F.col("_x") - (left + (F.col("_c") + 0.5) * spacing), F.col("_y") - (top - (F.col("_r") + 0.5) * spacing))
    on_grid = F.col("_c").between(0, nx - 1) & F.col("_r").between(0, ny - 1) & (~F.col("parallax_applied") | F.col("known"))
    # A pixel yields one cell or none. As a filter this test would be pushed down through the whole chain
    # of projection steps and repeat all of it.
    cell = F.explode(F.array_compact(F.array(F.when(on_grid, (F.col("_r") * nx + F.col("_c")).cast("long")))))
    rows = rows.withColumn("_off", off).withColumn("target_cell", cell)
    shift = F.hypot((F.col("lon2") - F.col("lon")) * F.cos(F.radians("lat")) * 111.32, (F.col("lat2") - F.col("lat")) * 110.57)
    best = F.min_by(F.struct("value", "valid", "parallax_applied", shift.alias("displacement_km")), F.struct("_off", "pixel_id"))
    return rows.groupBy(*frame, "variable", "target_cell").agg(best.alias("b")).select(*frame, "variable", "target_cell", "b.*")


def forecast_crop(pixels: DataFrame, box, cycle: str, valid: str, y: str = "y", x: str = "x") -> DataFrame:
    """Bounding rows and columns of a closed box, NULL outside the box; another (cycle, valid) fails."""
    same = (F.col("cycle") == F.lit(cycle).cast("timestamp_ntz")) & (F.col("valid_time") == F.lit(valid).cast("timestamp_ntz"))
    rows = guard(pixels, same, "The forecast's times differ from the selected one")
    west, south, east, north = box
    lon = F.pmod(F.col("lon") + 180.0, F.lit(360.0)) - 180.0
    inside = lon.between(west, east) & F.col("lat").between(south, north)
    bounds = rows.filter(inside).agg(F.count(F.lit(1)).alias("_n"), *[f(c).alias(f"{n}_{c}") for c in (y, x) for n, f in (("lo", F.min), ("hi", F.max))])
    bounds = guard(bounds, F.col("_n") > 0, "The forecast grid does not meet the box")
    keep = F.col(y).between(F.col(f"lo_{y}"), F.col(f"hi_{y}")) & F.col(x).between(F.col(f"lo_{x}"), F.col(f"hi_{x}"))
    cut = rows.join(F.broadcast(bounds), keep)  # one row of bounds
    return cut.select(*[c for c in pixels.columns if c != "value"], F.when(inside, F.col("value")).alias("value"))


def sample_static(cells: DataFrame, elevation: DataFrame, scale: float, offset: float, ocean: str, cell: str = "cell") -> DataFrame:
    """Static field per cell: ocean set to zero or kept, scaled; a missing cell fails."""
    if ocean not in ("zero", "retain"):
        raise ValueError("The ocean convention must be zero or retain")
    rows = guard(cells.join(elevation, cell, "left"), dc.finite("elevation"), "The static field has missing cells")
    height = F.greatest(F.col("elevation"), F.lit(0.0)) if ocean == "zero" else F.col("elevation")
    return rows.select(*cells.columns, (height * scale + offset).cast("float").alias("topography"))


def compare_frames(left: DataFrame, right: DataFrame, keys: list[str], coordinates: list[str], tolerance: float = 2e-6) -> DataFrame:
    """Per frame whether valid pixels are equal, the window is the same, and how far coordinates differ.

    keys start with the frame column; right carries the validity.
    """
    frame, cell = keys[0], keys[1:]
    a = left.select(*keys, F.col("value").alias("_a"), *[F.col(c).alias(f"_a_{c}") for c in coordinates], F.lit(1).alias("_in_a"))
    b = right.select(*keys, F.col("value").alias("_b"), F.col("valid").alias("_v"), *[F.col(c).alias(f"_b_{c}") for c in coordinates], F.lit(1).alias("_in_b"))
    rows = a.join(b, [frame, *cell], "full_outer")
    both = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    same = ~F.coalesce(F.col("_v"), F.lit(False)) | F.col("_a").eqNullSafe(F.col("_b"))
    gaps = [F.abs(F.col(f"_a_{c}") - F.col(f"_b_{c}")) for c in coordinates]
    far = F.greatest(*gaps) if len(gaps) > 1 else gaps[0]
    out = rows.groupBy(frame).agg(F.bool_and(both).alias("same_window"), F.bool_and(same).alias("valid_pixels_equal"), F.max(far).alias("max_coordinate_difference"))
    return out.withColumn("within_tolerance", F.coalesce(F.col("max_coordinate_difference") <= tolerance, F.lit(False)))


def support_share(grid: DataFrame, bounds, ny: int, nx: int, crop: int) -> DataFrame:
    """Grid cells inside the region, those a source footprint covers, and the same for a centred crop."""
    west, south, east, north = bounds
    covered = F.col("lon").between(west, east) & F.col("lat").between(south, north)
    top, left = (ny - crop) // 2, (nx - crop) // 2
    in_crop = F.col("y").between(top, top + crop - 1) & F.col("x").between(left, left + crop - 1)
    return grid.agg(
        F.count_if("inside").alias("region_cells"), F.count_if(F.col("inside") & covered).alias("region_supported"),
        F.count_if(in_crop).alias("crop_cells"), F.count_if(in_crop & covered).alias("crop_supported"))


def axis_table(spark: SparkSession, coordinates: list[float]) -> DataFrame:
    """An axis as (index, coord) rows."""
    return spark.createDataFrame([(i, float(c)) for i, c in enumerate(coordinates)], "index int, coord double")


def long_pixels(frames: DataFrame, keys: list[str]) -> DataFrame:
    """Array frames to one row per pixel."""
    zipped = F.arrays_zip("values", "valid", "quality", "classes")
    rows = frames.select(*keys, F.posexplode(zipped).alias("source_cell", "p"))
    return rows.select(*keys, "source_cell", F.col("p.values").alias("value"), F.col("p.valid").alias("valid"),
                       F.col("p.quality").alias("quality"), F.col("p.classes").alias("class"))


def region_rows(spark: SparkSession) -> DataFrame:
    """Named region variants as a table."""
    rows = [(name, *[float(v) for v in box]) for name, box in geo.region_options().items()]
    return spark.createDataFrame(rows, "region string, west double, south double, east double, north double")


