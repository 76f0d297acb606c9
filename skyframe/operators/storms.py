"""Storm tracks: reading, segments, region encounters, padded event windows, rankings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyframe.functions import geo
from skyframe.functions.checks import guard
from skyframe.functions.times import HOUR, ceil_to, floor_to, instant, literal_micros, micros
from skyframe.operators.alignment import first_of
from skyframe.operators.forecasts import sample_times
from skyframe.operators.sequences import with_previous
from skyframe.session import written

# Reference point, longest step between fixes, padding of an encounter, "near" limit,
# spacing of the region's outline in degrees.
REFERENCE = (-66.4, 18.2)
STEP_HOURS = 6
PAD_BEFORE_HOURS, PAD_AFTER_HOURS = 12, 24
NEAR_KM = 100.0
OUTLINE_DEGREES = 0.1
LINES_TOGETHER = 64
MARGIN_DEGREES = 3.0

# Named comparison storms and their UTC windows.
STORMS = [
    ("fred-2021", "Fred", "2021-08-10T12:00:00Z", "2021-08-11T16:00:00Z"),
    ("grace-2021", "Grace", "2021-08-15T06:00:00Z", "2021-08-16T06:00:00Z"),
    ("earl-2022", "Earl", "2022-09-03T18:00:00Z", "2022-09-05T12:00:00Z"),
    ("fiona-2022", "Fiona", "2022-09-17T18:00:00Z", "2022-09-20T00:00:00Z"),
    ("philippe-2023", "Philippe", "2023-10-03T06:00:00Z", "2023-10-04T14:00:00Z"),
    ("ernesto-2024", "Ernesto", "2024-08-13T16:00:00Z", "2024-08-14T18:00:00Z"),
    ("erin-2025", "Erin", "2025-08-16T16:00:00Z", "2025-08-17T18:00:00Z"),
]


def storm_table(spark: SparkSession) -> DataFrame:
    """The named storm windows."""
    rows = spark.createDataFrame(STORMS, "storm string, name string, start_text string, end_text string")
    return rows.select("storm", "name", F.to_timestamp("start_text").cast("timestamp_ntz").alias("start"),
                       F.to_timestamp("end_text").cast("timestamp_ntz").alias("end"))


def storm_hours(storms: DataFrame) -> DataFrame:
    """One row per storm and hour from its start, end excluded."""
    hours = F.sequence(micros("start"), micros("end") - 1, F.lit(HOUR))
    return storms.withColumn("hour", F.explode(F.transform(hours, instant)))


def read_tracks(spark: SparkSession, location: str) -> DataFrame:
    """Track file with a header; a byte-order mark in front of the first name is ignored."""
    raw = spark.read.csv(location, header=True, encoding="UTF-8", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return track_fixes(raw.toDF(*[c.lstrip("﻿") for c in raw.columns]))


def track_fixes(raw: DataFrame) -> DataFrame:
    """Main-track rows with a dated time and valid coordinates, longitude in [-180, 180)."""
    stamp = F.trim("ISO_TIME")
    lon, lat = F.trim("USA_LON").try_cast("double"), F.trim("USA_LAT").try_cast("double")
    rows = raw.select(
        F.trim("SID").alias("sid"), F.trim("NAME").alias("name"), F.upper(F.trim("TRACK_TYPE")).alias("_type"),
        F.when(F.substring(stamp, 1, 4).rlike(r"^\d{4}$"), F.try_to_timestamp(stamp)).cast("timestamp_ntz").alias("time"),
        lon.alias("_lon"), lat.alias("lat"))
    good = (F.col("sid") != "") & F.col("time").isNotNull() & (F.col("_type") == "MAIN") & F.col("_lon").between(-180, 360) & F.col("lat").between(-90, 90)
    return rows.filter(good).select("sid", "name", "time", (F.pmod(F.col("_lon") + 180.0, F.lit(360.0)) - 180.0).alias("lon"), "lat")


def settled_fixes(fixes: DataFrame, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """One fix per storm and time within six hours of the study, and the (storm, time) pairs that disagree."""
    at = micros("time")
    low, high = literal_micros(start) - STEP_HOURS * HOUR, literal_micros(end) + STEP_HOURS * HOUR
    near = fixes.filter((at >= low) & (at < high))
    ends = [f(c).alias(f"{n}_{c}") for c in ("lon", "lat") for n, f in (("least", F.min), ("most", F.max))]
    # Segments, points, names and conflicts all read it.
    per = written(near.groupBy("sid", "time").agg(*ends, F.min("name").alias("name")), "fixes")
    one = (F.col("least_lon") == F.col("most_lon")) & (F.col("least_lat") == F.col("most_lat"))
    return per.filter(one).select("sid", "time", F.col("least_lon").alias("lon"), F.col("least_lat").alias("lat"), "name"), per.filter(~one).select("sid", "time")


def track_segments(fixes: DataFrame, conflicts: DataFrame, start: str, end: str) -> DataFrame:
    """Consecutive fixes at most six hours apart with no disputed fix between, clipped to the study.

    ``lo`` and ``hi`` are the clipped ends; ``f0`` and ``f1`` their shares along the whole step.
    """
    rows = fixes.select("sid", "time", "lon", "lat", F.lit(0).alias("_bad")).unionByName(
        conflicts.select("sid", "time", F.lit(None).cast("double").alias("lon"), F.lit(None).cast("double").alias("lat"), F.lit(1).alias("_bad")))
    rows = rows.withColumn("_us", micros("time"))
    rows = with_previous(rows, ["sid"], ["_us"], ["_us", "lon", "lat", "_bad"], prefix="a")
    first, last = literal_micros(start), literal_micros(end)
    a, b = F.col("a_us"), F.col("_us")
    keep = (F.col("_bad") == 0) & (F.col("a_bad") == 0) & (b - a <= STEP_HOURS * HOUR) & (a < last) & (b > first)
    lo, hi = F.greatest(a, F.lit(first)), F.least(b, F.lit(last))
    return rows.filter(keep).select(
        "sid", instant("a_us").alias("time_a"), "time", F.col("alon").alias("lon_a"), F.col("alat").alias("lat_a"), F.col("lon").alias("lon_b"),
        F.col("lat").alias("lat_b"), instant(lo).alias("lo"), instant(hi).alias("hi"), ((lo - a) / (b - a)).alias("f0"), ((hi - a) / (b - a)).alias("f1"))


def outline(box=geo.REGION, reference=REFERENCE, step: float = OUTLINE_DEGREES, planar: bool = False) -> list[tuple[float, float]]:
    """Closed outline of a lon/lat box in the local plane (or as it is)."""
    west, south, east, north = box
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    points = []
    for (x0, y0), (x1, y1) in zip(corners, corners[1:]):
        n = 1 if planar else max(1, -(-int(round((abs(x1 - x0) + abs(y1 - y0)) / step * 1e6)) // 10**6))
        points += [(x0 + (x1 - x0) * i / n, y0 + (y1 - y0) * i / n) for i in range(n)]
    points.append(points[0])
    return points if planar else [geo.local_plane_point(x, y, *reference) for x, y in points]


def outline_cuts(lines: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How lines (rows of x0, y0, x1, y1) meet a closed outline (edges of the same form): the rows and shares along them of
    the crossings, in order, whether a line starts inside, and the distance of the lines that do not touch (else NaN)."""
    ex0, ey0, ex1, ey1 = edges.T
    ux, uy = ex1 - ex0, ey1 - ey0
    rows, shares = [np.zeros(0, np.int64)], [np.zeros(0)]
    starts_in, gap = np.zeros(len(lines), bool), np.full(len(lines), np.nan)

    def to_edge(px, py, x0, y0, dx, dy):
        size = dx * dx + dy * dy
        along = np.where(size == 0, 0.0, ((px - x0) * dx + (py - y0) * dy) / size)
        t = np.clip(along, 0.0, 1.0)
        return np.hypot(px - (x0 + t * dx), py - (y0 + t * dy))

    with np.errstate(divide="ignore", invalid="ignore"):
        for start in range(0, len(lines), LINES_TOGETHER):
            x0, y0, x1, y1 = (lines[start:start + LINES_TOGETHER, i, None] for i in range(4))
            # Even-odd test of the start: edges crossed by the ray to the right.
            ray = ((ey0 > y0) != (ey1 > y0)) & (x0 < ux * (y0 - ey0) / uy + ex0)
            inside = ray.sum(axis=1) % 2 == 1
            touched = inside.copy()
            moving = np.flatnonzero((x0 != x1) | (y0 != y1))
            if len(moving):
                mx, my, dx, dy = x0[moving], y0[moving], (x1 - x0)[moving], (y1 - y0)[moving]
                cross = dx * uy - dy * ux
                cross[cross == 0] = np.nan
                t = ((ex0 - mx) * uy - (ey0 - my) * ux) / cross
                u = ((ex0 - mx) * dy - (ey0 - my) * dx) / cross
                at, edge = np.nonzero((t >= 0) & (t <= 1) & (u >= 0) & (u < 1))
                found = t[at, edge]
                order = np.lexsort((found, at))
                rows.append(start + moving[at[order]])
                shares.append(found[order])
                touched[moving[at]] = True
            starts_in[start:start + LINES_TOGETHER] = inside
            # Only a line that does not touch the region has a distance; a point's is that of its one end.
            apart = np.flatnonzero(~touched)
            least = to_edge(x0[apart], y0[apart], ex0, ey0, ux, uy).min(axis=1, initial=np.inf)
            along = np.flatnonzero(np.isin(apart, moving))
            if len(along):
                x0, y0, x1, y1 = (v[apart[along]] for v in (x0, y0, x1, y1))
                for gaps in (to_edge(x1, y1, ex0, ey0, ux, uy), to_edge(ex0, ey0, x0, y0, x1 - x0, y1 - y0), to_edge(ex1, ey1, x0, y0, x1 - x0, y1 - y0)):
                    least[along] = np.minimum(least[along], gaps.min(axis=1, initial=np.inf))
            gap[start + apart] = least
    return np.concatenate(rows), np.concatenate(shares), starts_in, gap


def _point_to_edge(px, py, x0, y0, x1, y1) -> Column:
    dx, dy = x1 - x0, y1 - y0
    size = dx * dx + dy * dy
    along = F.coalesce(((px - x0) * dx + (py - y0) * dy) / F.nullif(size, F.lit(0.0)), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return F.hypot(px - (x0 + t * dx), py - (y0 + t * dy))


def encounters(segments: DataFrame, box=geo.REGION, reference=REFERENCE, planar: bool = False) -> DataFrame:
    """Time spans that segments spend in the region, and their distances in kilometres.

    Segments are straight in the local plane; each task cuts its own, an Arrow batch at a time, against the outline, a fixed
    list of a few hundred edges; time runs linearly along a segment. Only segments within three degrees of the box are
    cut: others can neither enter it nor come within the "near" limit.
    Output: one row per segment with ``spans`` as an array of (entry, exit), ``edge_km``, ``reference_km``.
    """
    west, south, east, north = box
    close = ((F.greatest("lon_a", "lon_b") >= west - MARGIN_DEGREES) & (F.least("lon_a", "lon_b") <= east + MARGIN_DEGREES)
             & (F.greatest("lat_a", "lat_b") >= south - MARGIN_DEGREES) & (F.least("lat_a", "lat_b") <= north + MARGIN_DEGREES))
    flat = (lambda lon, lat: (lon, lat)) if planar else (lambda lon, lat: geo.local_plane(lon, lat, *reference))
    ax, ay = flat(F.col("lon_a"), F.col("lat_a"))
    bx, by = flat(F.col("lon_b"), F.col("lat_b"))
    rows = segments.filter(close).withColumns({"ax": ax, "ay": ay, "bx": bx, "by": by})
    x0, y0 = F.col("ax") + F.col("f0") * (F.col("bx") - F.col("ax")), F.col("ay") + F.col("f0") * (F.col("by") - F.col("ay"))
    x1, y1 = F.col("ax") + F.col("f1") * (F.col("bx") - F.col("ax")), F.col("ay") + F.col("f1") * (F.col("by") - F.col("ay"))
    rows = rows.withColumns({"x0": x0, "y0": y0, "x1": x1, "y1": y1})
    rows = rows.select("sid", "time_a", "time", "lo", "hi", "x0", "y0", "x1", "y1")
    points = np.array(outline(box, reference, planar=planar))
    edges = np.concatenate([points[:-1], points[1:]], axis=1)

    def cut(batches):
        for batch in batches:
            line = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("x0", "y0", "x1", "y1")], axis=1)
            at, shares, starts_in, gap = outline_cuts(line, edges)
            ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(line)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(shares)), pa.array(starts_in), pa.array(gap)],
                                             names=[*batch.schema.names, "_ts", "_starts_in", "_gap"])

    per = rows.mapInArrow(cut, StructType([*rows.schema.fields, *StructType.fromDDL("_ts array<double>, _starts_in boolean, _gap double").fields]))
    marks = F.concat(F.array(F.lit(0.0)), F.col("_ts"), F.array(F.lit(1.0)))
    pieces = F.transform(F.sequence(F.lit(1), F.size(marks) - 1), lambda i: F.struct(
        F.element_at(marks, i).alias("p"), F.element_at(marks, i + 1).alias("q"), ((i % 2 == 1) == F.col("_starts_in")).alias("_in")))
    inside = F.filter(pieces, lambda s: s["_in"] & (s["q"] > s["p"]))
    begin, length = micros("lo"), micros("hi") - micros("lo")
    spans = F.transform(inside, lambda s: F.struct(
        instant((begin + s["p"] * length).cast("long")).alias("entry"), instant((begin + s["q"] * length).cast("long")).alias("exit")))
    rx, ry = (F.lit(reference[0]), F.lit(reference[1])) if planar else (F.lit(0.0), F.lit(0.0))
    touched = F.col("_starts_in") | (F.size("_ts") > 0)
    scale = 1.0 if planar else 1000.0
    return per.select("sid", "time_a", "time", spans.alias("spans"),
                      F.when(touched, F.lit(0.0)).otherwise(F.col("_gap") / scale).alias("edge_km"),
                      (_point_to_edge(rx, ry, F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")) / scale).alias("reference_km"))


def fix_points(fixes: DataFrame, start: str, end: str) -> DataFrame:
    """Single fixes inside the study as zero-length segments, so that an isolated fix also counts."""
    at = micros("time")
    inside = fixes.filter((at >= literal_micros(start)) & (at < literal_micros(end)))
    return inside.select("sid", F.col("time").alias("time_a"), "time", F.col("lon").alias("lon_a"), F.col("lat").alias("lat_a"), F.col("lon").alias("lon_b"),
                         F.col("lat").alias("lat_b"), F.col("time").alias("lo"), F.col("time").alias("hi"), F.lit(0.0).alias("f0"), F.lit(1.0).alias("f1"))


def event_windows(spans: DataFrame, start: str, end: str) -> DataFrame:
    """Encounters padded by 12 h before and 24 h after to whole hours, clipped, and merged while the
    next one starts inside the running end; numbered per storm in time order. Encounters of one entry and exit are one event.

    spans: sid, entry, exit.
    """
    first, last = literal_micros(start), literal_micros(end)
    lo = F.greatest(F.lit(first), floor_to(micros("entry"), HOUR) - PAD_BEFORE_HOURS * HOUR)
    hi = F.least(F.lit(last), ceil_to(micros("exit"), HOUR) + PAD_AFTER_HOURS * HOUR)
    rows = spans.filter(micros("entry") < last).select("sid", "entry", "exit", lo.alias("_lo"), hi.alias("_hi"), micros("entry").alias("_us"), micros("exit").alias("_ux"))
    track = Window.partitionBy("sid").orderBy("_us", "_ux")  # the encounters of one storm, not its fixes
    reach = F.max("_hi").over(track.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_reach", reach)
    fresh = F.when(F.col("_reach").isNull() | (F.col("_lo") > F.col("_reach")), 1).otherwise(0)
    rows = rows.withColumn("encounter", F.sum(fresh).over(track.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.groupBy("sid", "encounter").agg(
        F.min("entry").alias("entry"), F.max("exit").alias("exit"), instant(F.min("_lo")).alias("start"), instant(F.max("_hi")).alias("end")).select(
        F.concat_ws("-", "sid", "encounter").alias("event_id"), "sid", "entry", "exit", "start", "end")


def select_events(fixes: DataFrame, start: str, end: str, limit: int | None = None, box=geo.REGION):
    """G10/W08/W09/K01/K05 together: padded events (closest storms first when limited) and nearby storms."""
    settled, conflicts = settled_fixes(fixes, start, end)
    parts = track_segments(settled, conflicts, start, end).unionByName(fix_points(settled, start, end))
    met = written(encounters(parts, box).select("sid", "spans", "edge_km", "reference_km"), "encounters")  # read twice
    distance = met.groupBy("sid").agg(F.min("reference_km").alias("_ref"), F.min("edge_km").alias("_edge"),
                                      F.max(F.size("spans")).alias("_spans"))
    names = settled.filter("name <> ''").groupBy("sid").agg(F.min_by("name", "time").alias("name"))
    facts = distance.join(names, "sid", "left").withColumn("name", F.coalesce("name", "sid"))
    spans = met.select("sid", F.explode("spans").alias("s")).select("sid", "s.entry", "s.exit")
    events = event_windows(spans, start, end).join(facts.select("sid", "name", F.round("_ref", 2).alias("closest_to_reference_km")), "sid")
    if limit:
        events = events.join(closest_storms(events, limit), "sid", "left_semi")
    return events, nearby_storms(facts)


def closest_storms(events: DataFrame, limit: int) -> DataFrame:
    """The storms nearest the reference point, ties by id."""
    best = events.groupBy("sid").agg(F.min("closest_to_reference_km").alias("closest_to_reference_km"))
    return best.orderBy("closest_to_reference_km", "sid").limit(limit)


def nearby_storms(facts: DataFrame) -> DataFrame:
    """Storms that stayed outside but came within 100 km of the region, nearest first."""
    near = facts.filter((F.col("_spans") == 0) & (F.col("_edge") <= NEAR_KM))
    return near.select("sid", "name", F.round("_edge", 2).alias("distance_to_region_km")).orderBy("distance_to_region_km", "sid")


def cube_records(times: DataFrame, baselines: DataFrame, corrected: DataFrame, keys: list[str]) -> DataFrame:
    """Frames of the wanted times in two variants; the first baseline that holds a frame wins.

    baselines carry ``src_ord`` and ``provenance``.
    """
    wanted = times.select("time").distinct()
    base = baselines.join(wanted, "time", "left_semi")
    kept = first_of(base, [*keys, "time"], [F.col("src_ord")]).drop("_rank", "src_ord").withColumn("variant", F.lit("uncorrected"))
    moved = corrected.join(wanted, "time", "left_semi").withColumn("variant", F.lit("corrected"))
    return kept.unionByName(moved)


def read_window(cube: DataFrame, hours: DataFrame, variant: str, frames: int = 12) -> DataFrame:
    """The twelve frames of one variant around each hour; an incomplete window fails."""
    need = sample_times(hours.select("hour"))
    hits = need.join(cube.filter(F.col("variant") == variant), "time", "left")
    whole = hits.groupBy("hour").agg(F.count_distinct(F.when(F.col("variant").isNotNull(), F.col("time"))).alias("_n"))
    return hits.join(guard(whole, F.col("_n") == frames, "A window lacks frames").select("hour"), "hour")

