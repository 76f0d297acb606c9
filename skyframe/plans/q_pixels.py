"""Registered queries over pixel tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyframe.functions import decode as dc
from skyframe.operators import pixels as px
from skyframe.operators.quantiles import exact_quantiles
from skyframe.plans.registry import query, table
from skyframe.plans.standins import IN_PATCH, PATCH_SQL, RADAR, SATELLITE, radar_pixels, satellite_pixels

_ID = ["l_orderkey", "l_linenumber"]


@query("p01_radar_decode", f"""
WITH {RADAR}
SELECT product, class, bitmap AS out_quality, count(*) AS pixels, count(*) FILTER (class = 0) AS valid_pixels,
       round(sum(CASE WHEN class = 0 THEN raw END), 4) AS value_sum
FROM radar_classed GROUP BY ALL""")
def p01(spark, folder):
    rows = px.decode_radar(radar_pixels(spark, folder))
    return rows.groupBy("product", "class", "out_quality").agg(
        F.count(F.lit(1)).alias("pixels"), F.count_if("valid").alias("valid_pixels"),
        F.round(F.sum(F.col("value").cast("double")), 4).alias("value_sum"))


@query("p02_satellite_decode", f"""
WITH {SATELLITE}
SELECT l_orderkey, l_linenumber, raw, CASE WHEN class = 0 THEN phys::DOUBLE END AS value, class = 0 AS valid,
       coalesce(quality, 255) AS out_quality, class FROM decoded""")
def p02(spark, folder):
    rows = px.decode_satellite(satellite_pixels(spark, folder))
    return rows.select(*_ID, "raw", F.col("value").cast("double").alias("value"), "valid", "out_quality", "class")


@query("p02_satellite_decode_conditional", f"""
WITH {SATELLITE}
SELECT variable, class, class IN (0, 9) AS valid, count(*) AS pixels FROM decoded GROUP BY ALL""")
def p02c(spark, folder):
    rows = px.decode_satellite(satellite_pixels(spark, folder), "conditional")
    return rows.groupBy("variable", "class", "valid").agg(F.count(F.lit(1)).alias("pixels"))


@query("p03_scan_calibration", f"""
WITH {SATELLITE}, s AS (SELECT *, scale <> 0.25 AS unsigned FROM satellite),
e AS (SELECT * REPLACE (CASE WHEN unsigned THEN low ELSE -30000 END AS low, CASE WHEN unsigned THEN high ELSE 30000 END AS high),
  CASE WHEN unsigned THEN raw & 65535 ELSE raw END AS enc FROM s),
p AS (SELECT *, CASE WHEN isinf(scale) THEN (CASE WHEN enc < 0 THEN '-Infinity' WHEN enc = 0 THEN 'NaN' ELSE 'Infinity' END)::DOUBLE ELSE CAST(scale * enc + off AS FLOAT)::DOUBLE END AS physical FROM e)
SELECT l_orderkey, l_linenumber, off AS offset, fill, low, high, unsigned, CASE WHEN isfinite(physical) THEN physical END AS physical,
  CASE WHEN NOT isfinite(physical) THEN 10 WHEN raw = fill OR enc = fill THEN 1 WHEN enc < low OR enc > high THEN 6
       WHEN quality IS NULL THEN 8 WHEN quality = 1 THEN 9 WHEN quality <> 0 THEN 5 ELSE 0 END AS class
FROM p""")
def p03(spark, folder):
    """Scans with unsigned and with signed containers, some of infinite scale, which their metadata spells as text."""
    rows = satellite_pixels(spark, folder)
    unsigned = F.col("scale") != 0.25
    limits = F.when(unsigned, F.array(F.lit(100), F.lit(-2))).otherwise(F.array(F.lit(-30000), F.lit(30000)))
    attrs = F.struct(F.col("scale").alias("scale_factor"), F.col("offset").alias("add_offset"), F.col("fill").alias("_FillValue"),
                     limits.alias("valid_range"), F.when(unsigned, "true").otherwise("false").alias("_Unsigned"))
    sidecar = F.to_json(F.struct(F.struct(F.struct(attrs.alias("attrs")).alias("CMI")).alias("variables")))
    sent = rows.select(*_ID, "raw", "quality", sidecar.alias("source_metadata_json"))
    back = px.decode_satellite(dc.restore_calibration(sent).drop("source_metadata_json"), "good")
    shown = back.withColumn("_p", dc.to_physical(dc.unsigned16("raw", F.col("unsigned")), "scale", "offset").cast("double"))
    return shown.select(*_ID, "offset", "fill", "low", "high", "unsigned", F.when(dc.finite("_p"), F.col("_p")).alias("physical"), "class")


@query("p04_audit_classes", f"""
WITH {RADAR} SELECT product, time, class, count(*) AS pixels FROM (SELECT product, time,
  CASE WHEN bitmap = 0 THEN 3 WHEN isnan(raw) THEN 4 WHEN raw = no_coverage THEN 2 WHEN raw = missing THEN 1 ELSE 0 END AS class
  FROM radar) GROUP BY ALL""")
def p04(spark, folder):
    rows = dc.with_product(radar_pixels(spark, folder))
    return px.class_histogram(rows, ["product", "time"], "radar")


_AUDIT_SAT = f"""
{SATELLITE},
flagged AS (
  SELECT *, raw = fill AS is_fill, enc < low OR enc > high AS outside, isinf(phys) AS calib FROM encoded),
audited AS (
  SELECT *, NOT is_fill AND NOT outside AND NOT calib AS num FROM flagged),
classed AS (
  SELECT *, num AND coalesce(quality = 0, false) AS strict, num AND coalesce(quality IN (0, 1), false) AS cond,
    CASE WHEN calib THEN 10 WHEN is_fill THEN 1 WHEN outside THEN 6 WHEN NOT num THEN 0
         WHEN quality IS NULL THEN 8 WHEN quality = 1 THEN 9 WHEN quality <> 0 THEN 5 ELSE 0 END AS code FROM audited)
"""


@query("p04_audit_classes_satellite", f"""
WITH {_AUDIT_SAT} SELECT variable, code AS class, count(*) AS pixels FROM classed GROUP BY ALL""")
def p04s(spark, folder):
    rows = _encoded(satellite_pixels(spark, folder))
    return px.class_histogram(rows, ["variable"], "satellite")


def _encoded(df):
    return df.withColumn("encoded", dc.unsigned16("raw")).withColumn(
        "physical", dc.to_physical(F.col("encoded"), "scale", "offset"))


@query("p05_display_classes", f"""
WITH {SATELLITE} SELECT variable, class, count(*) AS pixels FROM (SELECT variable,
  CASE WHEN raw = -1 THEN 1 WHEN quality <> 0 THEN 5 WHEN raw < -30000 OR raw > 30000 THEN 6 ELSE 0 END AS class FROM satellite)
GROUP BY ALL""")
def p05(spark, folder):
    code = dc.display_class_satellite(fill=F.lit(-1), low=F.lit(-30000), high=F.lit(30000))
    return satellite_pixels(spark, folder).groupBy("variable", code.alias("class")).agg(F.count(F.lit(1)).alias("pixels"))


@query("p05_display_classes_radar", f"""
WITH {RADAR} SELECT product, class, count(*) AS pixels FROM radar_classed GROUP BY ALL""")
def p05r(spark, folder):
    rows = dc.with_product(radar_pixels(spark, folder)).withColumn("class", dc.display_class_radar())
    return rows.groupBy("product", "class").agg(F.count(F.lit(1)).alias("pixels"))


@query("p06_product_dimension", f"""
WITH {RADAR} SELECT product, CASE WHEN product LIKE 'Merged%' THEN 'dBZ' ELSE '1' END AS unit, missing::DOUBLE AS missing,
 no_coverage::DOUBLE AS no_coverage, 2 AS frequency_minutes, count(*) AS pixels FROM radar GROUP BY ALL""")
def p06(spark, folder):
    rows = dc.with_product(radar_pixels(spark, folder))
    return rows.groupBy("product", "unit", "missing", "no_coverage", "frequency_minutes").agg(F.count(F.lit(1)).alias("pixels"))


@query("p07_slot_validity", f"""
WITH {SATELLITE},
f AS (SELECT time AS slot_time, variable, count(*) FILTER (class = 0 AND x = 0) AS v FROM decoded GROUP BY ALL)
SELECT slot_time, count(DISTINCT variable) = 4 AND bool_and(v > 0) AS valid FROM f GROUP BY slot_time""")
def p07(spark, folder):
    rows = px.decode_satellite(satellite_pixels(spark, folder))
    frames = rows.groupBy(F.col("time").alias("slot_time"), "variable").agg(
        F.count_if(F.col("valid") & (F.col("x") == 0)).alias("valid_pixels"))
    return px.slot_validity(frames, ["band01", "band02", "band03", "band04"])


@query("p08_display_frames", f"""
WITH {RADAR} SELECT l_orderkey, l_linenumber, CASE WHEN class = 0 AND raw <> 0 THEN raw END AS shown FROM radar_classed""")
def p08(spark, folder):
    rows = dc.with_product(radar_pixels(spark, folder)).withColumn("class", dc.display_class_radar())
    rows = rows.withColumn("region", F.lit("all"))
    return px.display_frames(rows, frame="time", hide_zero=True, value="raw").select(*_ID, "shown")


_COUNTS = ["numeric_valid", "fill", "outside_range", "strict_good", "good_plus_conditional", "quality_unknown", "raw_zero",
           "valid_zero", "valid_negative", "calibration_nonfinite"]


@query("a02_pixel_statistics", f"""
WITH {_AUDIT_SAT}, {PATCH_SQL},
scoped AS (
  SELECT c.*, p.patch FROM classed c JOIN patches p ON {IN_PATCH}
  UNION ALL SELECT *, 'whole' FROM classed)
SELECT variable, patch, count(*) AS pixels, count(*) FILTER (num) AS numeric_valid, count(*) FILTER (is_fill) AS fill, count(*) FILTER (outside) AS outside_range,
  count(*) FILTER (strict) AS strict_good, count(*) FILTER (cond) AS good_plus_conditional, count(*) FILTER (quality IS NULL) AS quality_unknown,
  count(*) FILTER (raw = 0) AS raw_zero, count(*) FILTER (strict AND phys = 0) AS valid_zero, count(*) FILTER (strict AND phys < 0) AS valid_negative,
  count(*) FILTER (calib) AS calibration_nonfinite, count(*) FILTER (code = 5) AS class_5, count(*) FILTER (code = 9) AS class_9,
  round(100.0 * count(*) FILTER (strict) / count(*), 6) AS strict_good_percent, round(100.0 * count(*) FILTER (is_fill) / count(*), 6) AS fill_percent,
  round(min(phys::DOUBLE) FILTER (strict), 6) AS strict_min, round(max(phys::DOUBLE) FILTER (num), 6) AS numeric_max,
  round(avg(phys::DOUBLE) FILTER (strict), 6) AS strict_mean, round(stddev_pop(phys::DOUBLE) FILTER (strict), 6) AS strict_std,
  round(quantile_cont(phys::DOUBLE, 0.25) FILTER (strict), 6) AS strict_q25, round(quantile_cont(phys::DOUBLE, 0.5) FILTER (cond), 6) AS conditional_median,
  round(quantile_cont(phys::DOUBLE, 0.75) FILTER (num), 6) AS numeric_q75
FROM scoped GROUP BY ALL""")
def a02(spark, folder):
    rows = px.with_patch(_encoded(satellite_pixels(spark, folder)), whole="whole")
    out = px.pixel_statistics(rows, ["variable", "patch"], "satellite")
    exact = ["variable", "patch", "pixels", *_COUNTS, "class_5", "class_9"]
    rounded = ["strict_good_percent", "fill_percent", "strict_min", "numeric_max", "strict_mean", "strict_std",
               "strict_q25", "conditional_median", "numeric_q75"]
    return out.select(*exact, *[F.round(c, 6).alias(c) for c in rounded])


@query("a02_quality_histogram", f"""
WITH {SATELLITE} SELECT variable, quality, count(*) AS pixels FROM satellite WHERE quality IS NOT NULL GROUP BY ALL""")
def a02q(spark, folder):
    return px.quality_histogram(satellite_pixels(spark, folder), ["variable"])


@query("a03_patch_description", f"""
WITH {RADAR}, {PATCH_SQL},
spine AS (SELECT DISTINCT product, time, patch FROM radar CROSS JOIN patches),
found AS (SELECT r.*, p.patch FROM radar_classed r JOIN patches p ON {IN_PATCH}),
stats AS (
  SELECT product, time, patch, count(*) AS pixels, count(*) FILTER (class = 0) AS valid_pixels, count(*) FILTER (class = 1) AS n1, count(*) FILTER (class = 3) AS n3,
    count(*) FILTER (class = 0 AND raw = 0) AS valid_zero_count, count(*) FILTER (class = 0 AND raw < 0) AS valid_negative_count,
    avg(raw) FILTER (class = 0) AS mean, stddev_pop(raw) FILTER (class = 0) AS std, quantile_cont(raw, 0.5) FILTER (class = 0) AS median
  FROM found GROUP BY ALL)
SELECT s.product, s.time, s.patch, coalesce(pixels, 0) AS pixels, coalesce(valid_pixels, 0) AS valid_pixels,
  coalesce(n1, 0) AS missing_fill_count, CASE WHEN pixels IS NULL THEN 'NaN'::DOUBLE ELSE round(100.0 * n3 / pixels, 6) END AS bitmap_missing_pct,
  coalesce(valid_zero_count, 0) AS valid_zero_count, coalesce(valid_negative_count, 0) AS valid_negative_count,
  round(mean, 6) AS mean, round(std, 6) AS std, round(median, 6) AS median,
  CASE WHEN pixels IS NULL THEN 'outside selected pixels' WHEN valid_pixels = 0 THEN 'no valid measurements' ELSE '' END AS note
FROM spine s LEFT JOIN stats USING (product, time, patch)""")
def a03(spark, folder):
    rows = dc.with_product(radar_pixels(spark, folder)).withColumn("class", dc.display_class_radar()).withColumn("value", F.col("raw"))
    out = px.describe(rows, ["product", "time"])
    return out.select("product", "time", "patch", "pixels", "valid_pixels", "missing_fill_count",
                      F.round("bitmap_missing_pct", 6).alias("bitmap_missing_pct"), "valid_zero_count", "valid_negative_count",
                      *[F.round(c, 6).alias(c) for c in ("mean", "std", "median")], "note")


@query("a01_training_moments", f"""
WITH {SATELLITE}
SELECT variable, count(*) AS pixels, round(avg(phys::DOUBLE), 6) AS mean, round(stddev_pop(phys::DOUBLE), 6) AS std
FROM decoded WHERE class = 0 AND time >= TIMESTAMP '1996-01-01' AND time < TIMESTAMP '2000-01-01' GROUP BY variable""")
def a01(spark, folder):
    rows = px.decode_satellite(satellite_pixels(spark, folder))
    out = px.training_moments(rows, ["band01", "band02", "band03", "band04"], "1996-01-01", "2000-01-01")
    return out.select("variable", "pixels", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("f03_patch_mask", f"""
WITH {SATELLITE}, {PATCH_SQL}
SELECT patch, variable, count(*) AS pixels FROM satellite JOIN patches ON {IN_PATCH} GROUP BY ALL""")
def f03(spark, folder):
    return px.with_patch(satellite_pixels(spark, folder)).groupBy("patch", "variable").agg(F.count(F.lit(1)).alias("pixels"))


_BOX = (-67.5, 16.0, -66.5, 17.0)


@query("f04_native_crop", f"""
WITH {RADAR},
hit AS (SELECT * FROM radar WHERE lon >= -67.5 AND lon < -66.5 AND lat >= 16.0 AND lat < 17.0),
b AS (SELECT min(x) - 2 AS x0, max(x) + 2 AS x1, min(y) - 2 AS y0, max(y) + 2 AS y1 FROM hit)
SELECT l_orderkey, l_linenumber, x, y FROM radar, b WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1""")
def f04(spark, folder):
    rows = radar_pixels(spark, folder)
    return px.crop_box(rows, _BOX, halo=2).select(*_ID, "x", "y")


@query("f05_view_crop", f"""
WITH {RADAR},
b AS (SELECT min(x) - 1 AS x0, max(x) + 1 AS x1, min(y) - 1 AS y0, max(y) + 1 AS y1 FROM radar
      WHERE x BETWEEN 4 AND 12 AND y BETWEEN 3 AND 9)
SELECT l_orderkey, l_linenumber, x, y FROM radar, b WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1""")
def f05(spark, folder):
    rows = radar_pixels(spark, folder).withColumns({"view_x": F.col("x") * 0.5, "view_y": F.col("y") * 0.5})
    return px.crop_view(rows, 2.0, 1.5, 6.0, 4.5, halo=1).select(*_ID, "x", "y")


@query("f06_band_selection", f"""
WITH {SATELLITE} SELECT variable, count(*) AS pixels, count(quality) AS graded FROM satellite WHERE variable IN ('band01', 'band03') GROUP BY ALL""")
def f06(spark, folder):
    rows = px.select_bands(satellite_pixels(spark, folder), ["band01", "band03"])
    return rows.groupBy("variable").agg(F.count(F.lit(1)).alias("pixels"), F.count("quality").alias("graded"))


@query("f07_centre_crop", f"""
WITH {SATELLITE} SELECT l_orderkey, l_linenumber, y, x FROM satellite WHERE y BETWEEN 8 AND 15 AND x BETWEEN 12 AND 19""")
def f07(spark, folder):
    return px.centre_crop(satellite_pixels(spark, folder), 24, 32, 8).select(*_ID, "y", "x")


@query("a21_coverage_frequency", f"""
WITH {SATELLITE} SELECT y, x, round(avg(CASE WHEN class = 0 THEN 1.0 ELSE 0.0 END), 9) AS share FROM decoded GROUP BY ALL""")
def a21(spark, folder):
    rows = px.coverage_frequency(px.decode_satellite(satellite_pixels(spark, folder)), ["y", "x"])
    return rows.withColumn("share", F.round("share", 9))


@query("a32_raster_summary", f"""
WITH {RADAR}, d AS (SELECT *, md5(l_orderkey || '|' || l_linenumber || '|' || CASE WHEN isnan(raw) OR raw IS NULL THEN 'missing' ELSE CAST(CAST(round(CAST(raw AS FLOAT)::DOUBLE, 6) AS DECIMAL(38, 6)) AS VARCHAR) END) AS h FROM radar)
SELECT product, time, count(CASE WHEN NOT isnan(raw) THEN 1 END) AS valid, count(*) FILTER (raw = 0) AS zero,
       min(raw) FILTER (NOT isnan(raw)) AS min, max(raw) FILTER (NOT isnan(raw)) AS max, CAST(sum(CAST('0x' || h[1:15] AS BIGINT)) AS VARCHAR) AS content FROM d GROUP BY ALL""")
def a32(spark, folder):
    return px.raster_summary(radar_pixels(spark, folder), ["product", "time"], "raw", _ID).withColumn("content", F.col("content").cast("string"))


@query("a34_common_limits", f"""
WITH {SATELLITE} SELECT min(phys::DOUBLE) AS low, max(phys::DOUBLE) AS high FROM decoded WHERE class = 0""")
def a34(spark, folder):
    return px.common_limits(px.decode_satellite(satellite_pixels(spark, folder)))


@query("c04_unsigned_containers", f"""
WITH {SATELLITE} SELECT l_orderkey, l_linenumber, enc AS encoded, ((lon + 360.0::DOUBLE + 180.0::DOUBLE) % 360.0::DOUBLE) - 180.0::DOUBLE AS lon FROM encoded""")
def c04(spark, folder):
    rows = satellite_pixels(spark, folder)
    return rows.select(*_ID, dc.unsigned16("raw").alias("encoded"), px.wrap_longitude(F.col("lon") + 360.0).alias("lon"))


@query("c12_product_aliases", f"""
WITH {RADAR} SELECT product, count(*) AS pixels FROM radar GROUP BY ALL""")
def c12(spark, folder):
    rows = radar_pixels(spark, folder)
    readable = F.when(F.col("product").startswith("Merged"), "Composite-Reflectivity").otherwise(F.col("product"))
    return rows.withColumn("product", dc.product_key(readable)).groupBy("product").agg(F.count(F.lit(1)).alias("pixels"))


@query("c05_packed_to_physical", f"""
WITH {SATELLITE}
SELECT l_orderkey, l_linenumber, CASE WHEN isfinite(enc::DOUBLE * scale + off) THEN CAST(enc::DOUBLE * scale + off AS FLOAT)::DOUBLE END AS physical FROM encoded""")
def c05(spark, folder):
    """Every pixel; one of a scan whose scale is infinite has no physical value."""
    rows = satellite_pixels(spark, folder)
    physical = dc.to_physical(dc.unsigned16("raw"), "scale", "offset").cast("double")
    return rows.select(*_ID, F.when(dc.finite(physical), physical).alias("physical"))


@query("c06_wrapped_longitude", """
SELECT o_orderkey, round(((o_custkey % 1441 - 720) / 2.0 + 180) - floor(((o_custkey % 1441 - 720) / 2.0 + 180) / 360) * 360 - 180, 6) AS lon FROM orders""")
def c06(spark, folder):
    """Half degrees over four half turns, both edges included."""
    lon = (F.col("o_custkey") % 1441 - 720) / 2.0
    return table(spark, folder, "orders").select("o_orderkey", F.round(px.wrap_longitude(lon), 6).alias("lon"))


@query("a02_null_band_quartiles", """
WITH p AS (SELECT CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE CAST(o_custkey % 8 AS INTEGER) END AS band, o_totalprice::DOUBLE AS v FROM orders)
SELECT band, round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.75), 6) AS q75 FROM p GROUP BY band""")
def a02n(spark, folder):
    """A NULL band beside known ones, holding a third of the rows."""
    band = F.when(F.col("o_custkey") % 3 != 0, (F.col("o_custkey") % 8).cast("int"))
    rows = table(spark, folder, "orders").select(band.alias("band"), F.col("o_totalprice").cast("double").alias("v"))
    out = exact_quantiles(rows, ["band"], F.col("v"), [0.25, 0.5, 0.75], ["q25", "median", "q75"])
    return out.select("band", *[F.round(c, 6).alias(c) for c in ("q25", "median", "q75")])
