"""Streams over growing folders: resumable materialisation, listings, publication cut-off, month state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.functions.checks import guard
from skyframe.functions.identity import fingerprint
from skyframe.operators.alignment import newest_version
from skyframe.operators.studies import merge_months, radar_month_cells
from skyframe.session import STATE_STORE
from skyframe.streaming.rates import counter_steps, interval_parts


def read_folder(spark: SparkSession, folder: str, schema, kind: str = "json", files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the files that appear in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(kind).load(folder)


def drain(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process everything that is there in micro-batches, then stop; a rerun goes on behind the last commit."""
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()


def batch_writer(target: str, columns: list[str], partitions: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """Write a batch under its own id, replacing a half-written one, and accept it only when what is
    read back has the same fingerprint."""

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{target}/batch={batch_id}"
        # The batch is computed once, by the write; its fingerprint is observed on the way.
        from pyspark.sql import Observation

        seen = Observation()
        observed = batch.observe(seen, fingerprint(*columns).alias("print"))
        writer = observed.write.mode("overwrite")
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.parquet(folder)
        back = batch.sparkSession.read.schema(batch.schema).parquet(folder).agg(fingerprint(*columns).alias("print")).first()["print"]
        if seen.get["print"] != back:
            raise OSError(f"Batch {batch_id} differs after writing")

    return write


def materialise(stream: DataFrame, target: str, checkpoint: str, columns: list[str], partitions: list[str] | None = None) -> None:
    """Resumable, verified materialisation of a stream into batch folders."""
    drain(stream, checkpoint, batch_writer(target, columns, partitions))


def newer_listings(stream: DataFrame, scan_keys: list[str], key: str = "asset_id", version: str = "key") -> DataFrame:
    """Listed objects that are the newest processing of their scan so far; drain it in update mode.

    State is one row per scan: its newest version and when that first came. A scan whose newest version came with this
    batch is given out; an object that is listed again, or an older processing, adds nothing, whenever it comes. Neither
    the archive nor earlier batches are read, and a batch that is run again has its first run's time and state.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    arrival = F.unix_micros(F.current_timestamp())  # one instant a batch
    rows = stream.filter(F.col(version).isNotNull()).withColumn("_arrival", arrival)
    told = F.struct("_arrival", *[F.col(c) for c in stream.columns if c not in scan_keys])
    first_told = F.struct(F.col(version), -F.col("_arrival"), F.col(key))
    newest = rows.groupBy(*scan_keys).agg(F.max_by(told, first_told).alias("_newest"))
    fresh = newest.filter(F.col("_newest._arrival") == arrival)
    return fresh.select(*[F.col(c) if c in scan_keys else F.col(f"_newest.{c}").alias(c) for c in stream.columns])


def folder_writer(target: str) -> Callable[[DataFrame, int], None]:
    """A batch under its own id; a batch that is run again replaces what it wrote before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return write


def current_listing(spark: SparkSession, archive: str, scan_keys: list[str], version: str = "key") -> DataFrame:
    """The listing as it stands: the newest processing of every scan over all batches."""
    rows = spark.read.option("basePath", archive).parquet(f"{archive}/batch=*").drop("batch")
    return newest_version(rows, scan_keys, version)[0]


def published_by(forecasts: DataFrame, available: str, cutoff: str) -> DataFrame:
    """Only what was published by the decision time; works on a stream and on a table."""
    return forecasts.filter(F.col(available) <= F.col(cutoff))


CELL_SUMS = "cell bigint, rqi_sum double, rqi_count bigint, reflectivity_count bigint"


def _batches(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, month string, batch int").option("basePath", folder).parquet(f"{folder}/batch=*")


def month_writer(target: str) -> Callable[[DataFrame, int], None]:
    """Cell sums of months that come in parts. Every batch adds its sums to the parts of the months still open; a
    month is summed up and enters the state with the batch that brings a row marked ``month_complete``.

    A marked row without a cell closes its month and adds nothing else. A batch that is run again replaces what it wrote
    before and reads no later parts. Parts lie in folders by month, so that only those of closing months are read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        sums = radar_month_cells(batch, also=[F.bool_or("month_complete").alias("closing")])
        parts = sums.withColumn("cell", F.col("cell").cast("long"))
        # A month of many cells is split, small months share a task.
        parts.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(f"{target}/parts/batch={batch_id}")
        held = _batches(batch.sparkSession, f"{target}/parts", f"{CELL_SUMS}, closing boolean").filter(F.col("batch") <= batch_id)
        closed = held.filter((F.col("batch") == batch_id) & F.col("closing")).select("month").distinct()
        whole = merge_months(held.filter("cell is not null").join(closed, "month", "left_semi"), ["month", "cell"])
        whole.write.mode("overwrite").parquet(f"{target}/months/batch={batch_id}")

    return write


def year_cells(spark: SparkSession, target: str) -> DataFrame:
    """Cell sums over the months that have entered the state; a month that is closed twice, or has rows after it
    was closed, fails."""
    rows = _batches(spark, f"{target}/months", CELL_SUMS)
    parts = _batches(spark, f"{target}/parts", f"{CELL_SUMS}, closing boolean").groupBy("month").agg(F.max("batch").alias("_latest"))
    owners = rows.groupBy("month").agg(F.min("batch").alias("_first"), F.max("batch").alias("_last")).join(parts, "month")
    once = (F.col("_first") == F.col("_last")) & (F.col("_latest") <= F.col("_first"))
    sound = guard(owners, once, "A month entered the state twice").select("month")
    return merge_months(rows.join(sound, "month", "left_semi"))


def bandwidth_intervals(snapshots: DataFrame, target: str, checkpoint: str) -> None:
    """T02 as a stream: per-task steps (stateful), summed per snapshot in every batch and appended."""

    def write(batch: DataFrame, batch_id: int) -> None:
        interval_parts(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    drain(counter_steps(snapshots), checkpoint, write)
