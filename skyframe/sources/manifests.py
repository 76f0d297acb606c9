"""Completion manifests and listings: reading, expanding, searching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.functions.checks import guard
from skyframe.functions.labels import dataset_name
from skyframe.functions.times import MINUTE, col, literal_micros, micros
from skyframe.operators.alignment import first_of

ASSET = ("struct<asset_id:string,time:string,end_time:string,source_url:string,bucket:string,key:string,etag:string,"
         "source_bytes:bigint,available_bands:array<int>,slot_time:string,offset_seconds:double,status:string>")
MANIFEST = ("path string, raw_path string, source string, product string, satellite int, band int, region array<double>, "
            "year int, month string, observations bigint, stored_bytes bigint, archive_sha256 string, status string, "
            f"time string, source_url string, asset_ids array<string>, assets array<{ASSET}>")


def file_sizes(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path and length of the files below a folder; the content column is never read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length")


def read_manifests(spark: SparkSession, location: str, files: DataFrame | None = None, strict: bool = False,
                   multi_line: bool = False) -> DataFrame:
    """Completed manifests. Given the file sizes, an archive without its file or of another size is
    left out, or fails the job in strict mode."""
    rows = spark.read.schema(MANIFEST).json(location, multiLine=multi_line).filter("path is not null")
    if files is None:
        return rows
    sized = rows.join(files.select(F.col("path").alias("path"), F.col("length").alias("_length")), "path", "left")
    good = F.coalesce(F.col("_length") == F.col("stored_bytes"), F.lit(False))
    checked = guard(sized, good, "An archive is missing or its size differs") if strict else sized.filter(good)
    return checked.drop("_length")


def scan_stamp(text: Column | str) -> Column:
    """Time text of a scan (year, day of year, clock, tenths) to a timestamp."""
    digits = F.rpad(F.substring(col(text), 1, 14), 14, "0")
    return F.when(F.length(col(text)) >= 13, F.try_to_timestamp(digits, F.lit("yyyyDDDHHmmssS"))).cast("timestamp_ntz")


def recovered_time(time: Column, url: Column, path: Column) -> Column:
    """Observation time from the manifest, else the source file name, else the dated folder."""
    scan = F.regexp_extract(url, r"_s(\d+)_e", 1)
    radar = F.regexp_extract(url, r"(\d{8}-\d{6})\.grib", 1)
    dated = F.regexp_extract(path, r"/((?:19|20)\d{2}/\d{2}/\d{2})/", 1)
    clock = F.regexp_extract(path, r"/(?:C\d{2}-)?(\d{6})-[^/]+$", 1)
    return F.coalesce(
        F.try_to_timestamp(time).cast("timestamp_ntz"),
        F.when(scan != "", scan_stamp(scan)),
        F.when(radar != "", F.try_to_timestamp(radar, F.lit("yyyyMMdd-HHmmss")).cast("timestamp_ntz")),
        F.when((dated != "") & (clock != ""), F.try_to_timestamp(F.concat(dated, clock), F.lit("yyyy/MM/ddHHmmss")).cast("timestamp_ntz")),
    )


def expand_assets(manifests: DataFrame) -> DataFrame:
    """One row per asset and band, with the time recovered where the manifest lacks it."""
    rows = manifests.select(
        "path", "source", "product", "satellite", "band", "region", "stored_bytes", "archive_sha256",
        F.col("time").alias("_time"), F.col("source_url").alias("_url"), F.posexplode_outer("assets").alias("row_index", "a"))
    bands = F.coalesce(F.col("a.available_bands"), F.array("band"))
    rows = rows.withColumn("_band", F.explode_outer(bands))
    url = F.coalesce("a.source_url", "_url")
    stamped = rows.select(
        "path", "source", "product", "satellite", F.col("_band").alias("band"), "region", "stored_bytes", "archive_sha256",
        "row_index", F.col("a.asset_id").alias("asset_id"), F.col("a.key").alias("key"), F.col("a.bucket").alias("bucket"),
        F.col("a.etag").alias("etag"), F.col("a.source_bytes").alias("source_bytes"), url.alias("source_url"),
        F.col("a.status").alias("asset_status"),
        recovered_time(F.coalesce("a.time", "_time"), url, F.col("path")).alias("time"),
        F.try_to_timestamp("a.end_time").cast("timestamp_ntz").alias("end_time"),
        dataset_name("path", "source").alias("dataset"))
    return guard(stamped, F.col("time").isNotNull(), "An observation has no timestamp")


def months_available(partitioned: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """Months present, from partition values alone."""
    return partitioned.select(F.format_string("%04d-%02d", F.col(year).cast("int"), F.col(month).cast("int")).alias("month")).distinct()


def search(archives: DataFrame, observations: DataFrame, source: str | None = None, start: str | None = None,
           end: str | None = None, band: int | None = None) -> DataFrame:
    """Archives whose interval may overlap the period (unknown ends count as open), then their
    observations inside it."""
    keep, inside = F.lit(True), F.lit(True)
    if source:
        keep = keep & (F.col("source") == source)
    if start:
        low = F.lit(start).cast("timestamp_ntz")
        keep, inside = keep & (F.col("end_utc").isNull() | (F.col("end_utc") >= low)), inside & (F.col("time") >= low)
    if end:
        high = F.lit(end).cast("timestamp_ntz")
        keep, inside = keep & (F.col("start_utc").isNull() | (F.col("start_utc") < high)), inside & (F.col("time") < high)
    if band is not None:
        same = F.col("band").isNull() | (F.col("band") == band)
        keep, inside = keep & same, inside & same
    candidates = archives.filter(keep).select("path")
    return observations.filter(inside).join(candidates, "path", "left_semi")


def inventory(observations: DataFrame, source: str | None = None, start: str | None = None, end: str | None = None,
              band: int | None = None, limit: int = 50_000) -> DataFrame:
    """Filtered observations, one copy each (the shared folder wins); ``limit`` or more matches fail."""
    keep = F.lit(True)
    if source:
        keep = keep & (F.col("source") == source)
    if start:
        keep = keep & (F.col("time") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        keep = keep & (F.col("time") < F.lit(end).cast("timestamp_ntz"))
    if band is not None:
        keep = keep & (F.col("band").isNull() | (F.col("band") == band))
    rows = observations.filter(keep)
    probe = rows.agg(F.count(F.lit(1)).alias("_n"))
    probe = guard(probe, F.col("_n") < limit, "Too many observations match; choose a shorter period")
    checked = rows.join(F.broadcast(probe), F.col("_n") >= 0).drop("_n")  # one row: the guard
    ident = checked.withColumn("_id", F.coalesce("asset_id", "path"))
    shared = F.col("path").contains("/roi-")
    return first_of(ident, ["_id", "band", "dataset"], [shared.desc(), F.col("path").desc()]).drop("_id", "_rank")


def selected_archives(manifests: DataFrame, source: str | None = None, product: str | None = None,
                      band: int | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Archives with the assets that lie in the period; one row per physical path."""
    keep = F.lit(True)
    for name, value in (("source", source), ("product", product)):
        if value:
            keep = keep & (F.col(name) == value)
    if band is not None:
        keep = keep & (F.col("band").isNull() | (F.col("band") == band))
    low = F.lit(start).cast("timestamp_ntz") if start else None
    high = F.lit(end).cast("timestamp_ntz") if end else None

    def inside(asset):
        stamp = F.try_to_timestamp(asset["time"]).cast("timestamp_ntz")
        test = F.lit(True)
        if low is not None:
            test = test & (stamp >= low)
        if high is not None:
            test = test & (stamp < high)
        return test

    rows = manifests.filter(keep).withColumn("assets", F.filter("assets", inside)).filter(F.size("assets") > 0)
    return first_of(rows, ["path"], [F.to_json(F.struct(*[F.col(c) for c in rows.columns]))]).drop("_rank").withColumn("selected_observations", F.size("assets").cast("long"))


def observation_index(assets: DataFrame, start: str, end: str, region: list[float], variable: Column,
                      halo_minutes: int = 70) -> DataFrame:
    """Observation pointers inside ``[start - halo, end)``; another region fails; the end time comes
    from the file name when the manifest lacks it."""
    low, high = literal_micros(start) - halo_minutes * MINUTE, literal_micros(end)
    rows = assets.filter(micros("time").between(low, high - 1))
    same = F.col("region").isNull() | (F.col("region") == F.array(*[F.lit(float(v)) for v in region]))
    rows = guard(rows, same, "The source region differs from the requested one")
    named = F.regexp_extract("source_url", r"_e(\d+)_c", 1)
    until = F.coalesce("end_time", F.when(named != "", scan_stamp(named)), F.when(F.col("source") != "satellite", F.col("time")))
    rows = guard(rows.withColumn("end_time", until), F.col("end_time").isNotNull(), "A scan end is required for causal matching")
    key = F.substring(F.sha2(F.concat_ws("|", "path", "archive_sha256"), 256), 1, 24)
    return rows.select(key.alias("archive_id"), "path", "row_index", variable.alias("variable"), "asset_id", "time", "end_time",
                       "satellite", "source", "source_url")


def parse_listing(listing: DataFrame, key: str = "key") -> DataFrame:
    """Start, end, band and mode out of listed keys of both families; other keys are dropped."""
    start = F.regexp_extract(key, r"_s(\d+)_e\d+_c\d+\.nc$", 1)
    until = F.regexp_extract(key, r"_s\d+_e(\d+)_c\d+\.nc$", 1)
    mode, band = F.regexp_extract(key, r"-M(\d)", 1), F.regexp_extract(key, r"-M\dC(\d\d)_", 1)
    radar = F.regexp_extract(key, r"_(\d{8}-\d{6})\.grib2\.gz$", 1)
    rows = listing.withColumns({
        "time": F.coalesce(F.when(start != "", scan_stamp(start)),
                           F.when(radar != "", F.try_to_timestamp(radar, F.lit("yyyyMMdd-HHmmss")).cast("timestamp_ntz"))),
        "end_time": F.when(until != "", scan_stamp(until)),
        "mode": F.nullif(mode, F.lit("")), "band": F.when(band != "", band.cast("int")),
    })
    return rows.filter(F.col("time").isNotNull())


CATALOG_FEATURE = ("struct<id:string,properties:struct<datetime:string,end_datetime:string,"
                   "source:struct<bucket:string,key:string,size:bigint,etag:string>>>")


def read_catalog(spark: SparkSession, location: str, multi_line: bool = True) -> DataFrame:
    """Assets of the catalog documents at a location, compressed or not."""
    asset = "struct<bucket:string,key:string,size:bigint,etag:string,time:string,end_time:string>"
    schema = f"type string, features array<{CATALOG_FEATURE}>, assets array<{asset}>"
    return catalog_assets(spark.read.schema(schema).json(location, multiLine=multi_line))


def catalog_assets(documents: DataFrame) -> DataFrame:
    """One row per asset for any of three layouts (an item collection, a collection that lists its
    assets, or a bare list)."""
    from_features = F.transform("features", lambda f: F.struct(
        f["properties"]["source"]["bucket"].alias("bucket"), f["properties"]["source"]["key"].alias("key"),
        f["properties"]["source"]["size"].alias("size"), f["properties"]["source"]["etag"].alias("etag"),
        f["properties"]["datetime"].alias("time"), f["properties"]["end_datetime"].alias("end_time")))
    rows = F.when(F.col("type") == "FeatureCollection", from_features).otherwise(F.col("assets"))
    out = documents.select(F.explode(rows).alias("a")).select("a.*")
    return out.withColumns({"time": F.try_to_timestamp("time").cast("timestamp_ntz"),
                            "end_time": F.try_to_timestamp("end_time").cast("timestamp_ntz")})


def catalog_extent(assets: DataFrame, start: str, end: str) -> DataFrame:
    """Requested period widened to the observations really there."""
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    return assets.agg(
        F.least(lo, F.min("time")).alias("start"),
        F.greatest(hi, F.max(F.coalesce("end_time", "time"))).alias("end"), F.count(F.lit(1)).alias("items"))


def write_catalog(assets: DataFrame, start: str, end: str, folder: str) -> None:
    """One collection row with the extent, and the items as gzipped JSON lines."""
    catalog_extent(assets, start, end).write.mode("overwrite").json(f"{folder}/collection")
    assets.write.mode("overwrite").json(f"{folder}/items", compression="gzip")


def receipt_tasks(receipts: DataFrame, files: DataFrame) -> DataFrame:
    """Task rows from completed monthly receipts whose archive exists; the newest receipt wins."""
    rows = receipts.filter(F.col("status") == "complete").select(
        "source", "product", "month", "modified", F.explode(F.coalesce("monthly_archives", "archives")).alias("a"))
    rows = rows.select("source", "product", "month", "modified", F.col("a.path").alias("task_id"), F.col("a.band").alias("band"),
                       F.coalesce("a.observations", F.lit(0)).alias("selected"))
    found = rows.join(files.select(F.col("path").alias("task_id")), "task_id", "left_semi")
    newest = first_of(found, ["task_id"], [F.col("modified").desc(), F.col("selected").desc()]).drop("_rank")
    return newest.withColumns({"checkpointed": F.col("selected"), "completed": F.col("selected"), "status": F.lit("complete")})
