"""The given tables seen as observations, archives, pixels and frames, with the same view in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.functions.times import literal_micros
from skyframe.plans.registry import table

# The calendar range that holds every row of the events table.
START, END = "2024-01-01T00:00:00Z", "2024-02-01T00:00:00Z"


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """events as observations on whole minutes, so that ties and slot boundaries really occur."""
    ev = table(spark, folder, "events")
    time = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    return ev.select(
        F.col("event_id").alias("asset_id"), F.col("event_type").alias("variable"), time.alias("time"),
        F.timestamp_micros(F.unix_micros(time.cast("timestamp")) + (F.col("event_id") % 9) * 60_000_000)
        .cast("timestamp_ntz").alias("end_time"),
        (F.col("user_id") % 2).alias("satellite"), (F.col("user_id") % 8 + 1).cast("int").alias("band"),
        F.when(F.col("event_type").isin("error", "signup"), 300).otherwise(600).alias("tolerance_s"),
        F.get_json_object("props", "$.k").cast("int").alias("quality"),
        (F.col("value") * 100 + 0.5).cast("long").alias("size"), "user_id", "value",
        F.format_string("scan/%s/%010d", "event_type", "event_id").alias("key"),
    )


OBSERVATIONS = """
observations AS (
  SELECT event_id AS asset_id, event_type AS variable, date_trunc('minute', ts) AS time,
         date_trunc('minute', ts) + to_minutes(event_id % 9) AS end_time,
         user_id % 2 AS satellite, CAST(user_id % 8 + 1 AS INTEGER) AS band,
         CASE WHEN event_type IN ('error', 'signup') THEN 300 ELSE 600 END AS tolerance_s,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS quality,
         CAST(round(value * 100) AS BIGINT) AS size, user_id, value,
         'scan/' || event_type || '/' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS key
  FROM events)
"""


def satellite_pixels(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem as packed satellite pixels: signed 16-bit raw, quality code, per-scan calibration."""
    li = table(spark, folder, "lineitem")
    packed = ((F.col("l_extendedprice") * 100 + 0.5).cast("long") % 65536 - 32768).cast("int")
    raw = F.when(F.col("l_discount") == 0.0, F.lit(-1)).when(F.col("l_tax") == 0.08, F.lit(-2)).otherwise(packed)
    return li.select(
        "l_orderkey", "l_linenumber", F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("time"),
        F.format_string("band%02d", F.col("l_suppkey") % 4 + 1).alias("variable"),
        raw.alias("raw"),
        F.when(F.col("l_linestatus") == "F", F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2))
        .when(F.col("l_returnflag") == "A", 0).alias("quality"),
        F.when(F.col("l_suppkey") == 7, F.lit(float("inf"))).otherwise(0.25 * (1 + F.col("l_suppkey") % 3)).alias("scale"),
        (F.col("l_suppkey") % 5).cast("double").alias("offset"),
        F.lit(65535).alias("fill"), F.lit(100).alias("low"), F.lit(65534).alias("high"),
        (-69.0 + (F.col("l_partkey") % 500) / 100.0).alias("lon"),
        (15.0 + (F.col("l_suppkey") % 100) / 25.0).alias("lat"),
        (F.col("l_partkey") % 32).cast("int").alias("x"), (F.col("l_suppkey") % 24).cast("int").alias("y"),
    )


SATELLITE = """
satellite AS (
  SELECT l_orderkey, l_linenumber, date_trunc('month', l_shipdate)::TIMESTAMP AS time,
         'band' || lpad(CAST(l_suppkey % 4 + 1 AS VARCHAR), 2, '0') AS variable,
         CASE WHEN l_discount = 0.0 THEN -1 WHEN l_tax = 0.08 THEN -2
              ELSE CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 65536 - 32768 AS INTEGER) END AS raw,
         CASE WHEN l_linestatus = 'F' THEN CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END
              WHEN l_returnflag = 'A' THEN 0 END AS quality,
         CASE WHEN l_suppkey = 7 THEN 'Infinity'::DOUBLE ELSE 0.25::DOUBLE * (1 + l_suppkey % 3) END AS scale,
         CAST(l_suppkey % 5 AS DOUBLE) AS off, 65535 AS fill, 100 AS low, 65534 AS high,
         -69.0::DOUBLE + (l_partkey % 500) / 100.0::DOUBLE AS lon, 15.0::DOUBLE + (l_suppkey % 100) / 25.0::DOUBLE AS lat,
         CAST(l_partkey % 32 AS INTEGER) AS x, CAST(l_suppkey % 24 AS INTEGER) AS y
  FROM lineitem),
encoded AS (
  SELECT *, raw & 65535 AS enc, CASE WHEN scale = 'Infinity'::DOUBLE THEN 'Infinity'::FLOAT
         ELSE CAST((raw & 65535)::DOUBLE * scale + off AS FLOAT) END AS phys FROM satellite),
decoded AS (
  SELECT *, CASE WHEN isinf(phys) THEN 10 WHEN raw = fill OR enc = fill THEN 1 WHEN enc < low OR enc > high THEN 6
                 WHEN quality IS NULL THEN 8 WHEN quality = 1 THEN 9 WHEN quality <> 0 THEN 5 ELSE 0 END AS class
  FROM encoded)
"""


def radar_pixels(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem as radar pixels: sentinels, NaN and bitmap gaps, two products."""
    li = table(spark, folder, "lineitem")
    even = F.col("l_partkey") % 2 == 0
    raw = (
        F.when(F.col("l_discount") == 0.0, F.when(even, F.lit(-99.0)).otherwise(F.lit(-1.0)))
        .when(F.col("l_tax") == 0.08, F.when(even, F.lit(-999.0)).otherwise(F.lit(-3.0)))
        .when((F.col("l_linenumber") == 7) & (F.col("l_discount") == 0.01), F.lit(float("nan")))
        .otherwise(F.col("l_quantity") - 5.0)
    )
    return li.select(
        "l_orderkey", "l_linenumber", F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("time"),
        F.when(even, "MergedReflectivityQCComposite_00.50").otherwise("RadarQualityIndex_00.00").alias("product"),
        raw.alias("raw"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), 0).otherwise(1).alias("bitmap"),
        (-69.0 + (F.col("l_partkey") % 500) / 100.0).alias("lon"),
        (15.0 + (F.col("l_suppkey") % 100) / 25.0).alias("lat"),
        (F.col("l_partkey") % 32).cast("int").alias("x"), (F.col("l_suppkey") % 24).cast("int").alias("y"),
    )


RADAR = """
radar AS (
  SELECT l_orderkey, l_linenumber, date_trunc('month', l_shipdate)::TIMESTAMP AS time,
         CASE WHEN l_partkey % 2 = 0 THEN 'MergedReflectivityQCComposite_00.50' ELSE 'RadarQualityIndex_00.00' END AS product,
         CASE WHEN l_discount = 0.0 THEN CASE WHEN l_partkey % 2 = 0 THEN -99.0 ELSE -1.0 END
              WHEN l_tax = 0.08 THEN CASE WHEN l_partkey % 2 = 0 THEN -999.0 ELSE -3.0 END
              WHEN l_linenumber = 7 AND l_discount = 0.01 THEN 'NaN'::DOUBLE ELSE l_quantity - 5.0 END::DOUBLE AS raw,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 0 ELSE 1 END AS bitmap,
         CASE WHEN l_partkey % 2 = 0 THEN -99.0 ELSE -1.0 END AS missing,
         CASE WHEN l_partkey % 2 = 0 THEN -999.0 ELSE -3.0 END AS no_coverage,
         -69.0::DOUBLE + (l_partkey % 500) / 100.0::DOUBLE AS lon, 15.0::DOUBLE + (l_suppkey % 100) / 25.0::DOUBLE AS lat,
         CAST(l_partkey % 32 AS INTEGER) AS x, CAST(l_suppkey % 24 AS INTEGER) AS y
  FROM lineitem),
radar_classed AS (
  SELECT *, CASE WHEN bitmap = 0 THEN 3 WHEN isnan(raw) THEN 4 WHEN raw = no_coverage THEN 2 WHEN raw = missing THEN 1 ELSE 0 END AS class
  FROM radar)
"""

PATCH_SQL = """
patches(patch, west, south, east, north) AS (VALUES
  ('Puerto Rico', -67.5::DOUBLE, 17.8::DOUBLE, -65.2::DOUBLE, 18.6::DOUBLE), ('Mona Passage', -68.8, 17.8, -67.6, 18.8),
  ('Virgin Islands', -65.2, 17.5, -64.3, 18.7), ('Offshore south', -67.0, 15.0, -65.0, 16.0))
"""
IN_PATCH = "((lon + 180.0::DOUBLE) % 360.0::DOUBLE) - 180.0::DOUBLE >= west AND ((lon + 180.0::DOUBLE) % 360.0::DOUBLE) - 180.0::DOUBLE < east AND lat >= south AND lat < north"


CURRENT = "quality-v1"


def diagnostics(spark: SparkSession, folder: str) -> DataFrame:
    """orders as diagnostics rows with a JSON payload."""
    o = table(spark, folder, "orders")
    pixels = F.when(F.col("o_orderkey") % 7 == 0, 0).otherwise(1000 + F.col("o_orderkey") % 500)
    good = F.when(pixels == 0, 0).otherwise(F.col("o_orderkey") % 900)
    mean, std = F.when(good > 0, F.sqrt("o_totalprice")), F.when(good > 0, (F.col("o_custkey") % 50) / 10.0)
    stats = F.struct(mean.alias("mean"), std.alias("std"), (mean - std).alias("minimum"), (mean + std).alias("maximum"),
                     (mean - std / 2).alias("q25"), mean.alias("median"), (mean + std / 2).alias("q75"))
    payload = F.to_json(F.struct(
        pixels.alias("pixels"), good.alias("strict_good"), (good + F.col("o_custkey") % 100).alias("good_plus_conditional"),
        F.when(F.col("o_custkey") % 3 == 0, F.lit("n/a")).otherwise((F.col("o_custkey") % 20).cast("string")).alias("fill"),
        F.struct((F.col("o_custkey") % 4).alias("scale_factor")).alias("calibration"),
        F.when(F.col("o_custkey") % 5 == 0, "int16").otherwise("uint16").alias("packed_dtype"), stats.alias("strict_stats")))
    patch = F.when(F.col("o_orderkey") % 4 == 0, "Whole ROI").otherwise(
        F.concat(F.lit("patch "), (F.col("o_orderkey") % 4).cast("string")))
    return o.select(
        F.format_string("audit-%03d", F.col("o_custkey") % 40).alias("audit_key"),
        F.concat(F.lit("archive/"), (F.col("o_custkey") % 10).cast("string")).alias("path"),
        F.concat(F.lit("product "), F.col("o_orderstatus")).alias("product"),
        F.when(F.col("o_orderstatus") != "P", (F.col("o_custkey") % 2 + 1).cast("int")).alias("band"),
        F.col("o_orderdate").alias("time"), patch.alias("patch"), payload.alias("payload"))


def audits(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").select((F.col("o_custkey") % 40).alias("k")).distinct()
    return o.select(
        F.format_string("audit-%03d", "k").alias("audit_key"),
        F.when(F.col("k") % 3 == 0, F.lit(CURRENT)).otherwise("quality-v0").alias("code_hash"),
        F.when(F.col("k") % 11 == 0, "failed").otherwise("complete").alias("status"),
        F.when(F.col("k") % 2 == 0, "full selected observations").otherwise("sample").alias("scope"))


DIAGNOSTICS = """
audits AS (
  SELECT 'audit-' || lpad(CAST(k AS VARCHAR), 3, '0') AS audit_key, CASE WHEN k % 3 = 0 THEN 'quality-v1' ELSE 'quality-v0' END AS code_hash,
         CASE WHEN k % 11 = 0 THEN 'failed' ELSE 'complete' END AS status,
         CASE WHEN k % 2 = 0 THEN 'full selected observations' ELSE 'sample' END AS scope
  FROM (SELECT DISTINCT o_custkey % 40 AS k FROM orders)),
d0 AS (
  SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE 1000 + o_orderkey % 500 END AS pixels,
         CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey % 900 END AS strict_good FROM orders),
d1 AS (
  SELECT *, CASE WHEN strict_good > 0 THEN sqrt(o_totalprice) END AS mean,
         CASE WHEN strict_good > 0 THEN (o_custkey % 50) / 10.0::DOUBLE END AS std FROM d0),
diagnostics AS (
  SELECT 'audit-' || lpad(CAST(o_custkey % 40 AS VARCHAR), 3, '0') AS audit_key, 'archive/' || (o_custkey % 10) AS path,
         'product ' || o_orderstatus AS product, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey % 2 + 1 AS INTEGER) END AS band,
         o_orderdate AS time, CASE WHEN o_orderkey % 4 = 0 THEN 'Whole ROI' ELSE 'patch ' || (o_orderkey % 4) END AS patch,
         pixels, strict_good, strict_good + o_custkey % 100 AS good_plus_conditional,
         CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey % 20 END AS fill, o_custkey % 4 AS calibration,
         CASE WHEN o_custkey % 5 = 0 THEN 'int16' ELSE 'uint16' END AS packed_dtype,
         mean, std, mean - std AS minimum, mean + std AS maximum FROM d1),
visible AS (
  SELECT d.*, a.status, a.scope FROM diagnostics d JOIN audits a USING (audit_key)
  QUALIFY row_number() OVER (PARTITION BY d.path, d.band, d.time, d.patch
    ORDER BY a.code_hash = 'quality-v1' DESC, a.audit_key DESC, pixels, strict_good, mean, std, product, good_plus_conditional, calibration, packed_dtype) = 1)
"""


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """orders as completed archives, one per order."""
    return _archives(table(spark, folder, "orders"))


def _archives(o: DataFrame, *more: str) -> DataFrame:
    source = F.when(F.col("o_custkey") % 3 == 0, "radar").otherwise("satellite")
    band = F.when(F.col("o_custkey") % 3 != 0, (F.col("o_custkey") % 8 + 1).cast("int"))
    product = F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1))
    stored = (F.col("o_totalprice") + 0.5).cast("long")
    month = F.date_format("o_orderdate", "yyyy-MM")
    path = F.concat_ws("/", F.lit("data"), source, product, F.when(band.isNotNull(), F.format_string("C%02d", band)),
                       F.concat(F.lit("roi-"), (F.col("o_custkey") % 5).cast("string")), F.date_format("o_orderdate", "yyyy"),
                       F.date_format("o_orderdate", "MM"), F.concat(F.col("o_orderkey").cast("string"), F.lit("-raw")))
    return o.select(
        path.alias("path"), F.col("o_orderkey").alias("archive_key"), source.alias("source"), product.alias("product"), band.alias("band"),
        F.when(source == "satellite", (F.col("o_custkey") % 2 * 3 + 16).cast("int")).alias("satellite"),
        F.date_format("o_orderdate", "yyyy").cast("int").alias("year"), month.alias("month"),
        stored.alias("stored_bytes"), (stored * 7).alias("logical_bytes"),
        F.when(F.col("o_orderstatus") != "P", stored * 3).alias("source_bytes"),
        (F.col("o_custkey") % 30).alias("observations"), F.md5(F.col("o_orderkey").cast("string")).alias("archive_sha256"),
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_orderdate")).alias("start_utc"),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_orderdate") + F.expr("interval 30 days")).alias("end_utc"),
        F.col("o_orderstatus").alias("state"), F.col("o_orderdate").alias("indexed_at"), *more)


ARCHIVES = """
archives AS (
  SELECT *, 'data/' || source || '/' || product || coalesce('/C' || lpad(CAST(band AS VARCHAR), 2, '0'), '') || '/roi-' || (o_custkey % 5) || '/'
         || strftime(o_orderdate, '%Y/%m') || '/' || o_orderkey || '-raw' AS path,
         CASE WHEN source = 'satellite' THEN CAST(o_custkey % 2 * 3 + 16 AS INTEGER) END AS satellite,
         CAST(year(o_orderdate) AS INTEGER) AS year, strftime(o_orderdate, '%Y-%m') AS month, stored_bytes * 7 AS logical_bytes,
         CASE WHEN o_orderstatus <> 'P' THEN stored_bytes * 3 END AS source_bytes, o_custkey % 30 AS observations,
         md5(CAST(o_orderkey AS VARCHAR)) AS archive_sha256,
         CASE WHEN o_custkey % 7 <> 0 THEN o_orderdate END AS start_utc,
         CASE WHEN o_custkey % 11 <> 0 THEN o_orderdate + INTERVAL 30 DAY END AS end_utc, o_orderstatus AS state, o_orderdate AS indexed_at
  FROM (SELECT *, o_orderkey AS archive_key, CASE WHEN o_custkey % 3 = 0 THEN 'radar' ELSE 'satellite' END AS source,
               CASE WHEN o_custkey % 3 <> 0 THEN CAST(o_custkey % 8 + 1 AS INTEGER) END AS band,
               'P' || substr(o_orderpriority, 1, 1) AS product, CAST(round(o_totalprice) AS BIGINT) AS stored_bytes FROM orders))
"""


def assets(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem as the assets of the archives (joined on the order)."""
    # The given columns are joined; the texts made of them are many times as long and would go through the shuffle.
    both = table(spark, folder, "lineitem").join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = _archives(both, *[c for c in both.columns if c.startswith("l_")])
    us = F.unix_micros(F.col("l_shipdate").cast("timestamp")) + (F.col("l_partkey") % 1440) * 60_000_000
    return rows.select(
        "archive_key",
        F.concat_ws("-", "archive_key", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd")).alias("asset_id"),
        F.timestamp_micros(us).cast("timestamp_ntz").alias("time"),
        F.timestamp_micros(us + (F.col("l_suppkey") % 15 - 1) * 60_000_000).cast("timestamp_ntz").alias("end_time"),
        F.concat(F.lit("bucket"), (F.col("l_suppkey") % 3).cast("string")).alias("bucket"),
        F.concat_ws("/", F.lit("scan"), F.col("l_partkey"), F.col("l_linenumber")).alias("key"),
        F.concat(F.lit("e"), (F.col("l_suppkey") % 10).cast("string")).alias("etag"),
        F.when(F.col("l_tax") != 0.0, (F.col("l_quantity") * 1000 + 0.5).cast("long")).alias("source_bytes"),
        F.when(F.col("l_linenumber") <= 4, "6").when(F.col("l_linenumber") <= 6, "3").alias("mode"),
        F.when(F.col("l_returnflag") == "R", "corrupt_source").otherwise("saved").alias("status"),
        "path", "source", "product", "band", "satellite", "archive_sha256", "state")


ASSETS = """
assets AS (
  SELECT a.path, a.source, a.product, a.band, a.satellite, a.archive_sha256, a.state,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS asset_id,
         l_shipdate + to_minutes(l_partkey % 1440) AS time,
         l_shipdate + to_minutes(l_partkey % 1440 + l_suppkey % 15 - 1) AS end_time,
         'bucket' || (l_suppkey % 3) AS bucket, concat_ws('/', 'scan', l_partkey, l_linenumber) AS key, 'e' || (l_suppkey % 10) AS etag,
         CASE WHEN l_tax <> 0.0 THEN CAST(round(l_quantity * 1000) AS BIGINT) END AS source_bytes,
         CASE WHEN l_linenumber <= 4 THEN '6' WHEN l_linenumber <= 6 THEN '3' END AS mode,
         CASE WHEN l_returnflag = 'R' THEN 'corrupt_source' ELSE 'saved' END AS status
  FROM lineitem JOIN archives a ON a.archive_key = l_orderkey)
"""


def tasks(spark: SparkSession, folder: str) -> DataFrame:
    """orders as fetch tasks, one per archive, some of them unfinished."""
    a = archives(spark, folder)
    selected = F.col("observations")
    return a.select(
        F.col("path").alias("task_id"), F.concat(F.lit("run-"), (F.col("archive_key") % 9).cast("string")).alias("run_id"),
        "source", "product", F.when(F.col("archive_key") % 13 != 0, F.col("month")).alias("month"), "band", selected.alias("selected"),
        F.floor(selected / 2).cast("long").alias("checkpointed"),
        F.when(F.col("state") == "F", selected).otherwise(F.lit(0)).cast("long").alias("completed"),
        F.when(F.col("state") == "F", "complete").when(F.col("state") == "O", "fetching").otherwise("failed").alias("status"),
        (F.col("archive_key") % 1000).cast("double").alias("updated_at"))


TASKS = """
tasks AS (
  SELECT path AS task_id, 'run-' || (archive_key % 9) AS run_id, source, product, CASE WHEN archive_key % 13 <> 0 THEN month END AS month,
         band, observations AS selected, observations // 2 AS checkpointed, CASE WHEN state = 'F' THEN observations ELSE 0 END AS completed,
         CASE state WHEN 'F' THEN 'complete' WHEN 'O' THEN 'fetching' ELSE 'failed' END AS status, (archive_key % 1000)::DOUBLE AS updated_at
  FROM archives)
"""


# Fixed values of the stand-in: field, level and kind of the records in every forecast file, in file order.
FORECAST_RECORDS = [
    ("PRES", "surface", "instant"), ("PRMSL", "mean sea level", "instant"), ("TMP", "2 m above ground", "instant"),
    ("DPT", "2 m above ground", "instant"), ("UGRD", "10 m above ground", "instant"), ("VGRD", "10 m above ground", "instant"),
    ("PWAT", "entire atmosphere (considered as a single layer)", "instant"), ("APCP", "surface", "sum"), ("PRATE", "surface", "instant"),
    ("REFC", "entire atmosphere", "instant"), ("HGT", "500 mb", "instant"), ("TMP", "850 mb", "instant"), ("APCP", "surface", "sum"),
]


def forecast_listing(spark: SparkSession, folder: str) -> DataFrame:
    """events as published forecast files: every event is one lead of a six-hour cycle, so cycles grow with the table."""
    ev = table(spark, folder, "events")
    cycle = literal_micros(START) + F.floor(F.col("event_id") / 61) * 6 * 3_600_000_000
    rows = ev.select(cycle.alias("c"), (F.col("event_id") % 61).cast("int").alias("lead"), "event_id", "user_id", "value")
    late = (F.col("event_id") % 7 + 1) * 3_600_000_000
    return rows.select(
        F.timestamp_micros("c").cast("timestamp_ntz").alias("cycle"), "lead",
        F.concat(F.lit("f/"), F.date_format(F.timestamp_micros("c"), "yyyyMMddHH"), F.lit("/"), F.lpad(F.col("lead").cast("string"), 2, "0")).alias("key"),
        F.col("event_id").cast("string").alias("etag"), (F.floor(F.col("value") * 10) + 10000).cast("long").alias("size"),
        F.when(F.col("user_id") % 10 != 0, F.lit(900)).alias("index_size"),
        F.when(F.col("user_id") % 17 != 0, F.timestamp_micros(F.col("c") + late).cast("timestamp_ntz")).alias("modified"))


LISTING = f"""
listing AS (
  SELECT make_timestamp(c) AS cycle, lead, 'f/' || strftime(make_timestamp(c), '%Y%m%d%H') || '/' || lpad(CAST(lead AS VARCHAR), 2, '0') AS key,
         CAST(event_id AS VARCHAR) AS etag, CAST(floor(value * 10) AS BIGINT) + 10000 AS size, CASE WHEN user_id % 10 <> 0 THEN 900 END AS index_size,
         CASE WHEN user_id % 17 <> 0 THEN make_timestamp(c + (event_id % 7 + 1) * 3600000000) END AS modified
  FROM (SELECT {literal_micros(START)} + (event_id // 61) * 21600000000 AS c, CAST(event_id % 61 AS INTEGER) AS lead, event_id, user_id, value FROM events))
"""


def index_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Text index lines of every forecast file that has an index."""
    files = forecast_listing(spark, folder).filter("index_size is not null")
    fixed = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(lv).alias("level"), F.lit(k).alias("kind")) for f, lv, k in FORECAST_RECORDS])
    rows = files.select("key", "lead", "size", "cycle", "modified", F.posexplode(fixed).alias("i", "r"))
    rows = rows.filter((F.col("i") != 12) | (F.col("size") % 5 == 0)).filter((F.col("i") != 9) | (F.col("size") % 7 != 0))
    instant = F.when(F.col("lead") == 0, "anl").otherwise(F.concat(F.col("lead").cast("string"), F.lit(" hour fcst")))
    begin = F.greatest(F.lit(0), F.col("lead") - (F.col("size") % 4 + 1).cast("int"))
    summed = F.concat(begin.cast("string"), F.lit("-"), F.col("lead").cast("string"), F.lit(" hour acc fcst"))
    descriptor = F.when(F.col("r.kind") == "sum", summed).when((F.col("i") == 8) & (F.col("size") % 3 == 0), "0-3 hour ave fcst").otherwise(instant)
    offset = F.floor(F.col("i") / 2) * (100 + F.col("size") % 50)
    line = F.concat_ws(":", (F.col("i") + 1).cast("string"), offset.cast("long").cast("string"), F.lit("d=2024"), "r.field", "r.level", descriptor, F.lit(""))
    return rows.select("key", "lead", "size", "cycle", "modified", line.alias("line"))


_VALUES = ", ".join(f"({i}, '{f}', '{lv}', '{k}')" for i, (f, lv, k) in enumerate(FORECAST_RECORDS))
RECORDS = f"""
raw_records AS (
  SELECT key, lead, size, cycle, (i // 2) * (100 + size % 50) AS start, field, level,
         CASE WHEN kind = 'sum' THEN greatest(0, lead - (size % 4 + 1)) || '-' || lead || ' hour acc fcst'
              WHEN i = 8 AND size % 3 = 0 THEN '0-3 hour ave fcst' WHEN lead = 0 THEN 'anl' ELSE lead || ' hour fcst' END AS descriptor
  FROM listing CROSS JOIN (VALUES {_VALUES}) v(i, field, level, kind)
  WHERE index_size IS NOT NULL AND (i <> 12 OR size % 5 = 0) AND (i <> 9 OR size % 7 <> 0)),
ends AS (SELECT key, start, lead(start) OVER (PARTITION BY key ORDER BY start) AS nxt FROM (SELECT DISTINCT key, start FROM raw_records)),
records AS (SELECT r.*, coalesce(nxt, size) AS stop FROM raw_records r JOIN ends e USING (key, start))
"""


def index_records(spark: SparkSession, folder: str) -> DataFrame:
    from skyframe.sources.forecast_index import parse_byte_index

    lines = index_lines(spark, folder)
    return parse_byte_index(lines)


def storm_events(spark: SparkSession, folder: str) -> DataFrame:
    """customers as storm encounters of one to three days within the events' month."""
    c = table(spark, folder, "customer")
    start = F.lit(1704067200000000) + (F.col("c_custkey") * 37 % 40000) * 60_000_000
    return c.select(
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("event_id"), F.timestamp_micros(start).cast("timestamp_ntz").alias("start"),
        F.timestamp_micros(start + (F.col("c_nationkey") % 3 * 24 + 5) * 3_600_000_000).cast("timestamp_ntz").alias("end"))


STORMS = """
storms AS (
  SELECT 'S' || c_custkey AS event_id, TIMESTAMP '2024-01-01' + to_minutes(c_custkey * 37 % 40000) AS start,
         TIMESTAMP '2024-01-01' + to_minutes(c_custkey * 37 % 40000) + to_hours(c_nationkey % 3 * 24 + 5) AS "end" FROM customer),
storm_hours AS (
  SELECT event_id, unnest(generate_series(make_timestamp((epoch_us(start) + 3599999999) // 3600000000 * 3600000000), "end" - INTERVAL 1 MICROSECOND, INTERVAL 1 HOUR)) AS hour FROM storms)
"""


def raster_frames(spark: SparkSession, folder: str) -> DataFrame:
    """embeddings as 8 x 8 frames of two variables on a ten-minute clock."""
    e = table(spark, folder, "embeddings")
    slot = F.floor(F.col("vec_id") / 2).cast("long")
    at = F.timestamp_micros(F.lit(1704067200000000) + slot * 600_000_000).cast("timestamp_ntz")
    cells = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: ((F.col("vec_id") + i) % 3).cast("int"))
    valid = F.transform("embedding", lambda v: v.cast("double") > -0.2)
    return e.select(
        "vec_id", at.alias("time"), F.when(F.col("vec_id") % 2 == 0, "abi01c").otherwise("abi13c").alias("variable"), F.lit("native").alias("grid_id"),
        (at - F.expr("interval 1 minute")).alias("source_end"), F.col("embedding").alias("values"), valid.alias("valid"),
        cells.alias("quality"), F.transform(valid, lambda ok: F.when(ok, 0).otherwise(5)).alias("classes"), "label")


FRAMES = """
frames AS (
  SELECT vec_id, make_timestamp(1704067200000000 + vec_id // 2 * 600000000) AS time, CASE WHEN vec_id % 2 = 0 THEN 'abi01c' ELSE 'abi13c' END AS variable, label, embedding FROM embeddings),
cells AS (
  SELECT f.*, c.cell, embedding[c.cell + 1] AS value, embedding[c.cell + 1]::DOUBLE > -0.2::DOUBLE AS valid, CAST((vec_id + c.cell) % 3 AS INTEGER) AS quality,
         CASE WHEN embedding[c.cell + 1]::DOUBLE > -0.2::DOUBLE THEN 0 ELSE 5 END AS class
  FROM frames f CROSS JOIN (SELECT unnest(range(64)) AS cell) c)
"""


def raw_tracks(spark: SparkSession, folder: str) -> DataFrame:
    """events as storm-track rows, all text as in a track file."""
    ev = table(spark, folder, "events")
    lon = -75 + (F.col("event_id") * 7919 % 2000) / 100.0
    # Some storms only pass north of the region.
    lat = F.when(F.col("user_id") % 3 == 0, 22.3 + (F.col("event_id") * 10473 % 60) / 100.0).otherwise(8 + (F.col("event_id") * 10473 % 2000) / 100.0)
    return ev.select(
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("SID"), F.upper("event_type").alias("NAME"),
        F.when(F.col("event_type") == "error", "spur").otherwise("main").alias("TRACK_TYPE"),
        F.date_format("ts", "yyyy-MM-dd HH:00:00").alias("ISO_TIME"),
        F.when(F.col("event_type") == "signup", F.lit(" ")).otherwise(F.round(lat, 2).cast("string")).alias("USA_LAT"),
        F.round(F.when(F.col("event_type") == "view", lon + 360).otherwise(lon), 2).cast("string").alias("USA_LON"))


TRACKS = """
fixes AS (
  SELECT 'T' || user_id AS sid, upper(event_type) AS name, date_trunc('hour', ts)::TIMESTAMP AS time,
         ((round(CASE WHEN event_type = 'view' THEN -75 + (event_id * 7919 % 2000) / 100.0::DOUBLE + 360 ELSE -75 + (event_id * 7919 % 2000) / 100.0::DOUBLE END, 2) + 180.0::DOUBLE) % 360.0::DOUBLE) - 180.0::DOUBLE AS lon,
         round(CASE WHEN user_id % 3 = 0 THEN 22.3::DOUBLE + (event_id * 10473 % 60) / 100.0::DOUBLE ELSE 8 + (event_id * 10473 % 2000) / 100.0::DOUBLE END, 2) AS lat
  FROM events WHERE event_type NOT IN ('error', 'signup')),
settled AS (SELECT sid, time, min(lon) AS lon, min(lat) AS lat FROM fixes GROUP BY sid, time HAVING count(DISTINCT (lon, lat)) = 1),
disputed AS (SELECT sid, time FROM fixes GROUP BY sid, time HAVING count(DISTINCT (lon, lat)) > 1)
"""
