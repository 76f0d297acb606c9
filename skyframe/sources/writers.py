"""Sinks: content-addressed index tables, monthly archives, exports, read-back checks, random reads."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.functions.checks import guard
from skyframe.functions.identity import fingerprint

ARCHIVE_PARTITIONS = ["source", "product", "satellite", "band", "roi", "month"]


def write_index(tables: dict[str, DataFrame], root: str, identity: str) -> DataFrame:
    """Write all tables of one selection and return one row per table with its rows, read back.

    The tables go to a folder of their own; one pointer row, written when all of them are there, makes them the
    selection's tables. A run that stops on the way leaves the earlier tables as they were, in full.
    """
    version = uuid.uuid4().hex
    counts = []
    for name, df in tables.items():
        target = f"{root}/{identity}/{version}/{name}"
        df.write.parquet(target)
        back = df.sparkSession.read.schema(df.schema).parquet(target)
        counts.append(back.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows"))
    summary = reduce(DataFrame.unionByName, counts)
    pointer = summary.agg(F.map_from_entries(F.collect_list(F.struct("table", "rows"))).alias("tables")).select(  # one entry a table
        F.lit(identity).alias("identity"), F.lit(version).alias("version"), F.current_timestamp().alias("committed_at"), "tables")
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/selections")
    return summary


def read_index(spark: SparkSession, root: str, identity: str, table: str) -> DataFrame:
    """One table of a selection as its latest complete write left it."""
    found = spark.read.parquet(f"{root}/selections").filter(F.col("identity") == identity)
    latest = found.agg(F.max_by("version", F.struct("committed_at", "version")).alias("version")).first()["version"]
    if latest is None:
        raise ValueError(f"No complete index {identity}")
    return spark.read.parquet(f"{root}/{identity}/{latest}/{table}")


def write_archives(rows: DataFrame, root: str, partitions: list[str] | None = None, sort: list[str] | None = None,
                   salt: int | None = None, max_records: int = 5_000_000) -> None:
    """One folder per source, product, satellite, band, region and month; only those written are
    replaced. ``salt`` spreads a hot folder over that many tasks; big files are split by row count."""
    parts = partitions or ARCHIVE_PARTITIONS
    keys: list[Column] = [F.col(p) for p in parts]
    if salt:
        keys.append(F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns if c not in parts]), F.lit(salt)))
    spread = rows.repartition(*keys).sortWithinPartitions(*parts, *(sort or []))
    (spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records).partitionBy(*parts).parquet(root))


def export(df: DataFrame, folder: str, kind: str = "csv") -> None:
    """Result table as CSV with a header, or JSON lines."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.csv(folder, header=True)
    elif kind == "json":
        writer.json(folder)
    else:
        raise ValueError("Export as csv or json")


def verify_readback(written: DataFrame, source: DataFrame, columns: list[str]) -> DataFrame:
    """Both sides must have the same order-free fingerprint; one row, failing the job otherwise."""
    left = source.agg(fingerprint(*columns).alias("want"))
    right = written.agg(fingerprint(*columns).alias("got"))
    both = left.unionByName(right, allowMissingColumns=True).agg(F.max("want").alias("want"), F.max("got").alias("got"))
    return guard(both, F.col("want") == F.col("got"), "The written rows differ from the source").select(
        F.col("got.rows").alias("rows"), F.lit(True).alias("verified"))


def read_frames(spark: SparkSession, requests: DataFrame, frames: DataFrame, time: str = "time", variable: str = "variable",
                strict: bool = True) -> DataFrame:
    """Frames for an ordered list of (time, variable) requests; invalid cells become NaN; a missing
    frame fails. Each request row carries ``ord``; sort by it to see the request order."""
    hits = requests.join(frames, [time, variable], "left")
    if strict:
        hits = guard(hits, F.col("values").isNotNull(), "A requested frame is missing")
    masked = F.zip_with("values", "valid", lambda v, ok: F.when(ok, v).otherwise(F.lit(float("nan")).cast("float")))
    return hits.withColumn("values", masked).select("ord", time, variable, "values")


def import_evidence(documents: DataFrame, kind: str, labels: dict[str, str], payload: str = "payload") -> DataFrame:
    """Keep only named fields of nested JSON; the key is the content hash, so importing twice adds
    nothing. ``labels`` maps output columns to ``path type`` inside the document."""
    picked = {name: F.get_json_object(payload, f"$.{spec.split()[0]}").try_cast(spec.split()[1]) for name, spec in labels.items()}
    rows = documents.select(*[c.alias(n) for n, c in picked.items()])
    kept = F.to_json(F.struct(*[F.col(n) for n in sorted(labels)]), {"ignoreNullFields": "false"})
    return rows.withColumns({"measurement_id": F.sha2(F.concat(F.lit(kind), F.lit("|"), kept), 256), "kind": F.lit(kind)}).dropDuplicates(["measurement_id"])


def run_measurements(runs: DataFrame, known: DataFrame, key: str = "run_id") -> DataFrame:
    """Run log rows as measurements, replacing known ones of the same run."""
    fresh = runs.select(F.concat(F.lit("run:"), F.col(key).cast("string")).alias("measurement_id"), F.lit("fetch_index").alias("kind"),
                        F.to_json(F.struct(*[F.col(c) for c in runs.columns])).alias("payload"))
    return known.join(fresh, "measurement_id", "left_anti").unionByName(fresh)
