"""Pixel tables: decoding, spatial scopes, statistics by frame and scope, training moments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.functions import decode as dc
from skyframe.functions.checks import guard
from skyframe.operators.quantiles import exact_quantiles, quantile_parts
from skyframe.operators.sequences import join_on, with_runnings

# Named lon/lat boxes (west, south, east, north).
PATCHES = {
    "Puerto Rico": (-67.5, 17.8, -65.2, 18.6),
    "Mona Passage": (-68.8, 17.8, -67.6, 18.8),
    "Virgin Islands": (-65.2, 17.5, -64.3, 18.7),
    "Offshore south": (-67.0, 15.0, -65.0, 16.0),
}
OVERLAPPING = ["numeric_valid", "fill", "no_coverage", "bitmap_missing", "nonfinite", "outside_range",
               "ambiguous_shear_zero", "strict_good", "good_plus_conditional", "quality_unknown", "raw_zero",
               "valid_zero", "valid_negative", "calibration_nonfinite"]
PERCENTED = ["fill", "no_coverage", "bitmap_missing", "nonfinite", "outside_range", "ambiguous_shear_zero",
             "strict_good", "good_plus_conditional", "quality_unknown", "valid_zero"]


def wrap_longitude(lon: Column | str) -> Column:
    """Longitude in [-180, 180)."""
    lon = F.col(lon) if isinstance(lon, str) else lon
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def in_box(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    """Half-open lon/lat box."""
    west, south, east, north = box
    return (lon >= west) & (lon < east) & (lat >= south) & (lat < north)


def with_patch(df: DataFrame, lon: str = "lon", lat: str = "lat", patches: dict | None = None,
               whole: str | None = None) -> DataFrame:
    """one row per (pixel, patch that contains it). The patches are literals of the plan, so the
    box test is a per-row expression and needs no join. ``whole`` adds an all-pixel scope."""
    boxes = PATCHES if patches is None else patches
    x, y = wrap_longitude(lon), F.col(lat)
    hits = [F.when(in_box(x, y, box), F.lit(name)) for name, box in boxes.items()]
    if whole:
        hits.append(F.lit(whole))
    return df.withColumn("patch", F.explode(F.array_compact(F.array(*hits))))


def crop_box(df: DataFrame, box: tuple[float, float, float, float], halo: int = 0, lon: str = "lon", lat: str = "lat",
             x: str = "x", y: str = "y") -> DataFrame:
    """cells in the half-open box plus ``halo`` index cells around them."""
    inside = df.filter(in_box(wrap_longitude(lon), F.col(lat), box))
    if not halo:
        return inside
    bounds = inside.agg(*[f(c).alias(f"{n}_{c}") for c in (x, y) for n, f in (("lo", F.min), ("hi", F.max))])
    keep = F.lit(True)
    for c in (x, y):
        keep = keep & F.col(c).between(F.col(f"lo_{c}") - halo, F.col(f"hi_{c}") + halo)
    return df.join(F.broadcast(bounds), keep).select(*df.columns)  # one row of bounds


def crop_view(df: DataFrame, low_x: float, low_y: float, high_x: float, high_y: float, halo: int = 0,
              view_x: str = "view_x", view_y: str = "view_y", x: str = "x", y: str = "y") -> DataFrame:
    """cells whose view coordinates lie in the box (both ends in) with a halo; fails when none do."""
    inside = df.filter(F.col(view_x).between(low_x, high_x) & F.col(view_y).between(low_y, high_y))
    bounds = inside.agg(F.count(F.lit(1)).alias("_n"), *[
        f(c).alias(f"{n}_{c}") for c in (x, y) for n, f in (("lo", F.min), ("hi", F.max))])
    bounds = guard(bounds, F.col("_n") > 0, "The box lies outside the source window")
    keep = (F.col(x).between(F.col(f"lo_{x}") - halo, F.col(f"hi_{x}") + halo)
            & F.col(y).between(F.col(f"lo_{y}") - halo, F.col(f"hi_{y}") + halo))
    return df.join(F.broadcast(bounds), keep).select(*df.columns)  # one row of bounds


def select_bands(df: DataFrame, wanted: list[str], variable: str = "variable", allow_missing: bool = False) -> DataFrame:
    """keep the requested variables; unless tolerated, a variable without rows fails the job."""
    kept = df.filter(F.col(variable).isin(wanted))
    if allow_missing:
        return kept
    names = df.sparkSession.createDataFrame([(w,) for w in wanted], f"{variable} string")
    seen = kept.groupBy(variable).agg(F.count(F.lit(1)).alias("_n"))
    checked = guard(names.join(seen, variable, "left"), F.col("_n") > 0, "A requested variable is missing")
    return kept.join(F.broadcast(checked.select(variable)), variable, "left_semi")  # one row per wanted name


def centre_crop(df: DataFrame, height: int, width: int, size: int, y: str = "y", x: str = "x") -> DataFrame:
    """centred square of cells."""
    if size > min(height, width):
        raise ValueError("The crop is larger than the grid")
    top, left = (height - size) // 2, (width - size) // 2
    return df.filter(F.col(y).between(top, top + size - 1) & F.col(x).between(left, left + size - 1))


def decode_radar(df: DataFrame) -> DataFrame:
    """P01 on (product, raw, bitmap) pixels: adds value (NULL when invalid), valid, quality and class."""
    rows = guard(dc.with_product(df), ~F.col("zero_ambiguous") & F.col("bitmap").isNotNull(),
                 "Radar pixels need a bitmap and a product whose zeros are unambiguous")
    rows = rows.withColumn("class", dc.radar_class()).withColumn("valid", F.col("class") == 0)
    return rows.select(*df.columns, F.when(F.col("valid"), F.col("raw").cast("float")).alias("value"),
                       "valid", F.col("bitmap").alias("out_quality"), "class")


def decode_satellite(df: DataFrame, policy: str = "good") -> DataFrame:
    """P02 on (raw, quality, scale, offset, fill, low, high) pixels with per-scan calibration columns. Containers are
    unsigned unless a column ``unsigned`` says otherwise for a scan."""
    flag = F.col("unsigned") if "unsigned" in df.columns else None
    rows = df.withColumn("encoded", dc.unsigned16("raw", flag)).withColumn(
        "physical", dc.to_physical(F.col("encoded"), "scale", "offset"))
    rows = rows.withColumn("class", dc.satellite_class())
    rows = rows.withColumn("valid", dc.class_valid("class", policy))
    return rows.select(*df.columns, F.when(F.col("valid"), F.col("physical")).alias("value"), "valid",
                       F.coalesce("quality", F.lit(255)).alias("out_quality"), "class")


def pixel_statistics(df: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """Overlapping counts, exclusive class counts, percentages (NULL without pixels) and moments
    with quartiles for strict, conditional and numeric pixels, per key (frame and scope)."""
    rows = dc.with_audit(df, kind).select(*keys, "value", "class", *OVERLAPPING)
    labels = {"strict": "strict_good", "conditional": "good_plus_conditional", "numeric": "numeric_valid"}
    counts = [F.count_if(n).alias(n) for n in OVERLAPPING]
    classes = [F.count_if(F.col("class") == code).alias(f"class_{code}") for code in dc.CLASS_NAMES]
    moments = []
    for label, flag in labels.items():
        value = F.when(F.col(flag), F.col("value"))
        moments += [F.min(value).alias(f"{label}_min"), F.max(value).alias(f"{label}_max"),
                    F.avg(value).alias(f"{label}_mean"), F.stddev_pop(value).alias(f"{label}_std")]
    base = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("pixels"), *counts, *classes, *moments)
    percent = [(F.lit(100.0) * F.col(n) / F.nullif("pixels", F.lit(0))).alias(f"{n}_percent") for n in PERCENTED]
    # The three kinds are nested, so each value is counted once for all of them and one scan ranks them together.
    counted = rows.groupBy(*keys, F.col("value").cast("double").alias("value")).agg(*[F.count_if(F.col(flag) & F.col("value").isNotNull()).alias(label) for label, flag in labels.items()])
    ranked = with_runnings(counted, keys, ["value"], {f"_upto_{x}": F.col(x) for x in labels}, {f"_upto_{x}": f"_total_{x}" for x in labels})
    parts, points = [], []
    for label in labels:
        own, points_of = quantile_parts(label, f"_upto_{label}", f"_total_{label}", "value", [0.25, 0.5, 0.75], [f"{label}_{q}" for q in ("q25", "median", "q75")])
        parts += own
        points += points_of
    wide = ranked.groupBy(*keys).agg(*parts).select(*keys, *points)
    return join_on(base, wide, keys).select(*base.columns, *percent, *[c for c in wide.columns if c not in keys])


def class_histogram(df: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """Exclusive class counts in long form."""
    return dc.with_audit(df, kind).groupBy(*keys, "class").agg(F.count(F.lit(1)).alias("pixels"))


def quality_histogram(df: DataFrame, keys: list[str], quality: str = "quality") -> DataFrame:
    """Counts of every quality code in long form."""
    return df.filter(F.col(quality).isNotNull()).groupBy(*keys, quality).agg(F.count(F.lit(1)).alias("pixels"))


def describe(df: DataFrame, keys: list[str], patches: dict | None = None, code: str = "class", value: str = "value") -> DataFrame:
    """Per key and patch the exclusive classes 0-7 as counts and percentages, moments and a note.

    A patch without pixels still has a row; its percentages are NaN as in a 0/0 share.
    """
    names = list((PATCHES if patches is None else patches))
    found = with_patch(df, patches=patches)
    valid = F.when(F.col(code) == 0, F.col(value).cast("double"))
    stats = found.groupBy(*keys, "patch").agg(
        F.count(F.lit(1)).alias("pixels"), F.count(valid).alias("valid_pixels"),
        *[F.count_if(F.col(code) == c).alias(f"{dc.CLASS_NAMES[c]}_count") for c in range(8)],
        F.count_if(valid == 0).alias("valid_zero_count"), F.count_if(valid < 0).alias("valid_negative_count"),
        F.min(valid).alias("min"), F.max(valid).alias("max"), F.avg(valid).alias("mean"), F.stddev_pop(valid).alias("std"))
    quartiles = exact_quantiles(found.withColumn("_valid", valid), [*keys, "patch"], F.col("_valid"),
                                [0.25, 0.5, 0.75], ["q25", "median", "q75"])
    spine = df.select(*keys).distinct().withColumn("patch", F.explode(F.array(*[F.lit(n) for n in names])))
    out = join_on(join_on(spine, stats, [*keys, "patch"]), quartiles, [*keys, "patch"])
    counted = [c for c in stats.columns if c.endswith("_count") or c in ("pixels", "valid_pixels")]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in counted})

    def share(c):
        return F.when(F.col("pixels") == 0, F.lit(float("nan"))).otherwise(F.lit(100.0) * F.col(c) / F.col("pixels"))

    shares = {c[:-len("_count")] + "_pct": share(c) for c in counted if c.endswith("_count") and c != "valid_negative_count"}
    note = (F.when(F.col("pixels") == 0, "outside selected pixels")
            .when(F.col("valid_pixels") == 0, "no valid measurements").otherwise(""))
    return out.withColumns({**shares, "note": note})


def training_moments(df: DataFrame, variables: list[str], start: str, end: str, variable: str = "variable",
                     time: str = "time", value: str = "value", valid: str = "valid", inside: str | None = None) -> DataFrame:
    """Population mean and deviation of valid finite pixels in ``[start, end)``; an empty or constant
    variable fails the job."""
    moment = F.col(time).cast("timestamp_ntz")
    usable = F.col(valid) & dc.finite(value)
    if inside:
        usable = usable & F.col(inside)
    # Only the time range is a filter: one on validity would be pushed down through the decoding and repeat it.
    rows = df.filter((moment >= F.lit(start).cast("timestamp_ntz")) & (moment < F.lit(end).cast("timestamp_ntz")))
    number = F.when(usable, F.col(value).cast("double"))
    stats = rows.groupBy(variable).agg(F.count(number).alias("pixels"), F.avg(number).alias("mean"), F.stddev_pop(number).alias("std"))
    names = df.sparkSession.createDataFrame([(v,) for v in variables], f"{variable} string")
    return guard(names.join(stats, variable, "left"), (F.col("pixels") > 0) & (F.col("std") > 0),
                 "A training variable is empty or constant")


def slot_validity(df: DataFrame, variables: list[str], slot: str = "slot_time", variable: str = "variable",
                  valid_pixels: str = "valid_pixels") -> DataFrame:
    """A slot is valid when every variable is present with at least one valid pixel."""
    rows = df.filter(F.col(variable).isin(variables)).groupBy(slot).agg(
        F.count_distinct(variable).alias("_have"), F.bool_and(F.col(valid_pixels) > 0).alias("_all"))
    return rows.select(slot, ((F.col("_have") == len(variables)) & F.col("_all")).alias("valid"))


def display_frames(df: DataFrame, frame: str = "frame", box: str = "region", hide_zero: bool = False,
                   limit: int = 1500, code: str = "class", value: str = "value") -> DataFrame:
    """Values masked by class; fails beyond ``limit`` frames or with more than one region."""
    facts = df.agg(F.count_distinct(frame).alias("_frames"), F.count_distinct(box).alias("_boxes"))
    facts = guard(facts, (F.col("_frames") <= limit) & (F.col("_boxes") <= 1), "Too many frames or mixed regions")
    shown = (F.col(code) == 0) & (F.col(value) != 0) if hide_zero else F.col(code) == 0
    masked = df.withColumn("shown", F.when(shown, F.col(value)))
    return masked.join(F.broadcast(facts), F.col("_frames").isNotNull()).drop("_frames", "_boxes")  # one row of facts


def common_limits(df: DataFrame, value: str = "value") -> DataFrame:
    """Finite minimum and maximum over all frames, widened by one when equal."""
    finite = F.when(dc.finite(value), F.col(value).cast("double"))
    edges = df.agg(F.min(finite).alias("low"), F.max(finite).alias("high"))
    return edges.select("low", F.when(F.col("low") == F.col("high"), F.col("high") + 1).otherwise(F.col("high")).alias("high"))


def raster_summary(df: DataFrame, keys: list[str], value: str = "value", cell: list[str] | None = None, nodata: Column | None = None) -> DataFrame:
    """Valid, zero, minimum, maximum and, given the columns of a cell's place, an order-free ``content`` number per
    raster. Cells of the value ``nodata`` count as missing; all missing cells are alike to the content."""
    known = dc.finite(value) if nodata is None else dc.finite(value) & ~F.coalesce(F.col(value).cast("double") == nodata.cast("double"), F.lit(False))
    finite = F.when(known, F.col(value).cast("double"))
    parts = [F.count(finite).alias("valid"), F.count_if(finite == 0).alias("zero"), F.min(finite).alias("min"), F.max(finite).alias("max")]
    if cell:
        shown = F.coalesce(F.round(finite.cast("float").cast("double"), 6).cast("decimal(38,6)").cast("string"), F.lit("missing"))
        digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cell], shown))
        # Sums of 60 bits each do not depend on the order and merge over partitions.
        parts.append(F.sum(F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")).alias("content"))
    return df.groupBy(*keys).agg(*parts)


def coverage_frequency(df: DataFrame, cell: list[str], code: str = "class") -> DataFrame:
    """Per cell the share of frames in class 0."""
    return df.groupBy(*cell).agg(F.avg((F.col(code) == 0).cast("double")).alias("share"))
