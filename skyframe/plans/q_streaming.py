"""Registered queries of the streaming family: the given tables written as files, streamed, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyframe.functions.times import literal_micros, micros
from skyframe.plans.q_grid import _YEAR
from skyframe.plans.registry import query, table
from skyframe.plans.standins import LISTING, OBSERVATIONS, RADAR, START, forecast_listing, observations, radar_pixels
from skyframe.operators.forecasts import valid_time
from skyframe.session import new_folder
from skyframe.streaming import ingest as ig
from skyframe.streaming import rates as rt

# events as counter snapshots: a task is a user, its counter the running size, taken modulo 20 MB so that
# it sometimes restarts; the run changes every ten days; the last snapshot of a task is its completion.
SNAPSHOTS = """
snapshots AS (
  SELECT 'all' AS scope, 'task-' || user_id AS task_id, 'run-' || (epoch_us(ts) - 1704067200000000) // 864000000000 AS run_id,
    CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1 THEN 'complete' ELSE 'fetching' END AS status,
    CAST(sum(CAST(round(value * 100) AS BIGINT) * 100) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) % 20000000 AS BIGINT) AS read_bytes,
    (epoch_us(ts) // 1000000)::DOUBLE AS snapshot_at, ts FROM events)
"""


def _snapshots(spark, folder):
    """The running counter is exact in integers; users are the tasks of the given table."""
    from pyspark.sql import Window

    ev = table(spark, folder, "events")
    up = Window.partitionBy("user_id").orderBy("ts")
    size = F.round(F.col("value") * 100).cast("long") * 100
    last = F.lead("ts").over(up).isNull()
    return ev.select(
        F.lit("all").alias("scope"), F.concat(F.lit("task-"), F.col("user_id").cast("string")).alias("task_id"),
        F.concat(F.lit("run-"), F.floor((micros("ts") - literal_micros(START)) / 864_000_000_000).cast("string")).alias("run_id"),
        F.when(last, "complete").otherwise("fetching").alias("status"),
        (F.sum(size).over(up.rowsBetween(Window.unboundedPreceding, 0)) % 20_000_000).alias("read_bytes"),
        F.lit(None).cast("double").alias("started_at"), F.floor(micros("ts") / 1_000_000).cast("double").alias("snapshot_at"))


_T01 = f"""
WITH {SNAPSHOTS},
l AS (SELECT *, lag(run_id) OVER w AS pr, lag(read_bytes) OVER w AS pb FROM snapshots WINDOW w AS (PARTITION BY task_id ORDER BY ts)),
g AS (SELECT *, sum(CASE WHEN pr IS NULL OR pr <> run_id OR read_bytes < pb THEN 1 ELSE 0 END) OVER (PARTITION BY task_id ORDER BY ts) AS k FROM l),
f AS (SELECT *, first_value(snapshot_at) OVER w AS a, first_value(read_bytes) OVER w AS b FROM g WINDOW w AS (PARTITION BY task_id, k ORDER BY ts))
SELECT task_id, run_id, status, snapshot_at, snapshot_at - a AS elapsed_seconds, CASE WHEN snapshot_at > a THEN round((read_bytes - b) * 8 / (snapshot_at - a) / 1e6, 9) END AS average_mbps FROM f"""


@query("t01_rate_monitor_stream", _T01)
def t01(spark, folder):
    root = new_folder(spark, "rates")
    _snapshots(spark, folder).write.json(f"{root}/in")
    stream = ig.read_folder(spark, f"{root}/in", rt.SNAPSHOT)
    ig.drain(rt.watch_rates(stream), f"{root}/checkpoint", lambda df, i: df.write.mode("overwrite").parquet(f"{root}/out/batch={i}"), mode="update")
    rows = spark.read.parquet(f"{root}/out").drop("batch")
    return rows.withColumn("average_mbps", F.round("average_mbps", 9))


@query("t01_rate_monitor_batch", _T01)
def t01b(spark, folder):
    return rt.watch_rates_batch(_snapshots(spark, folder)).withColumn("average_mbps", F.round("average_mbps", 9))


_T02 = f"""
WITH c AS (SELECT 'task-' || user_id AS task_id, 'run-' || (epoch_us(ts) - 1704067200000000) // 864000000000 AS run_id, epoch_us(ts) // 86400000000 * 86400.0 AS stamp, ts, event_id,
    sum(CAST(round(value * 100) AS BIGINT) * 100) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events),
hourly AS (SELECT task_id, run_id, stamp, max_by(b, (ts, event_id)) AS b FROM c GROUP BY ALL),
s AS (SELECT stamp, run_id, lag(stamp) OVER (PARTITION BY run_id ORDER BY stamp) AS p, n, lag(n) OVER (PARTITION BY run_id ORDER BY stamp) AS pn FROM (SELECT run_id, stamp, count(*) AS n FROM hourly GROUP BY ALL)),
t AS (SELECT *, lag(stamp) OVER w AS pa, lag(b) OVER w AS pb FROM hourly WINDOW w AS (PARTITION BY run_id, task_id ORDER BY stamp)),
i AS (SELECT s.run_id, s.stamp, s.p, s.stamp - s.p AS sec, count(*) FILTER (t.pa = s.p) AS kept, any_value(s.pn) AS pn, sum(CASE WHEN t.pa = s.p THEN greatest(t.b - t.pb, 0) ELSE t.b END) AS bytes,
  bool_or(coalesce(t.pa = s.p AND t.b < t.pb, false)) AS shrunk, bool_or(coalesce(t.pa <> s.p, true)) AS unk
  FROM s JOIN t ON t.run_id = s.run_id AND t.stamp = s.stamp WHERE s.p IS NOT NULL GROUP BY ALL),
r AS (SELECT *, sum(CASE WHEN kept < pn OR shrunk OR unk THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY stamp DESC) AS later FROM i),
l AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY stamp DESC) AS n FROM r WHERE later = 0),
a AS (SELECT run_id, count(*) AS intervals, sum(sec)::DOUBLE AS window_seconds, round(sum(bytes) * 8 / sum(sec) / 1e6, 9) AS recent_average_mbps, round(quantile_cont((bytes * 8 / sec / 1e6)::DOUBLE, 0.5), 9) AS recent_median_mbps
  FROM l WHERE n <= 60 GROUP BY run_id)
SELECT 'all' AS scope, s.run_id, coalesce(intervals, 0) AS intervals, coalesce(window_seconds, 0.0)::DOUBLE AS window_seconds, recent_average_mbps, recent_median_mbps
FROM (SELECT DISTINCT run_id FROM s) s LEFT JOIN a USING (run_id)"""


def _daily(spark, folder):
    """Snapshots of all tasks on common instants (days), as a monitor takes them; counters only grow."""
    from pyspark.sql import Window

    ev = table(spark, folder, "events")
    size = F.round(F.col("value") * 100).cast("long") * 100
    up = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    day = F.floor(micros("ts") / 86_400_000_000).cast("double") * 86_400.0
    run = F.concat(F.lit("run-"), F.floor((micros("ts") - literal_micros(START)) / 864_000_000_000).cast("string"))
    rows = ev.select(F.concat(F.lit("task-"), F.col("user_id").cast("string")).alias("task_id"), run.alias("run_id"), day.alias("snapshot_at"),
                     F.sum(size).over(up).alias("read_bytes"), micros("ts").alias("_us"))
    out = rows.groupBy("task_id", "run_id", "snapshot_at").agg(F.max_by("read_bytes", "_us").alias("read_bytes"))
    return out.select(F.lit("all").alias("scope"), "task_id", "run_id", F.lit("fetching").alias("status"), "read_bytes", F.lit(None).cast("double").alias("started_at"), "snapshot_at")


def _rounded(df):
    return df.withColumns({c: F.round(c, 9) for c in ("recent_average_mbps", "recent_median_mbps")})


@query("t02_bandwidth_stream", _T02)
def t02(spark, folder):
    root = new_folder(spark, "bandwidth")
    _daily(spark, folder).write.json(f"{root}/in")
    ig.bandwidth_intervals(ig.read_folder(spark, f"{root}/in", rt.SNAPSHOT), f"{root}/parts", f"{root}/checkpoint")
    return _rounded(rt.recent_bandwidth(spark.read.parquet(f"{root}/parts").drop("batch")))


@query("t02_bandwidth_batch", _T02)
def t02b(spark, folder):
    return _rounded(rt.recent_bandwidth(rt.interval_parts(rt.counter_steps_batch(_daily(spark, folder)))))


@query("t03_resumable_materialisation", f"""
WITH {OBSERVATIONS} SELECT variable, count(*) AS rows, sum(size)::BIGINT AS bytes, min(time) AS first_time, max(end_time) AS last_end FROM observations GROUP BY variable""")
def t03(spark, folder):
    """Half of the files, a run; the rest, a second run that goes on behind the first."""
    root = new_folder(spark, "materialise")
    rows = observations(spark, folder)
    schema, columns = rows.schema, ["asset_id", "variable", "size"]
    for part in ("quality < 50", "quality >= 50"):
        rows.filter(part).write.mode("append").parquet(f"{root}/in")
        ig.materialise(ig.read_folder(spark, f"{root}/in", schema, "parquet"), f"{root}/out", f"{root}/checkpoint", columns)
    done = spark.read.parquet(f"{root}/out")
    return done.groupBy("variable").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").cast("long").alias("bytes"), F.min("time").alias("first_time"), F.max("end_time").alias("last_end"))


@query("t04_listing_versions", f"""
WITH {OBSERVATIONS}
SELECT variable, band, date_trunc('hour', time)::TIMESTAMP AS scan, max(key) AS key FROM observations GROUP BY ALL""")
def t04(spark, folder):
    """Listings come twice and in two runs; a newer processing of a scan replaces the older one, and most of the second
    run's scans are older than all of the first run's."""
    root = new_folder(spark, "listing")
    rows = observations(spark, folder).select("asset_id", "variable", "band", "key", F.date_trunc("hour", "time").cast("timestamp_ntz").alias("scan"))
    for part in ("scan >= '2024-01-12'", "scan < '2024-01-20'"):
        rows.filter(part).write.mode("append").parquet(f"{root}/in")
        stream = ig.newer_listings(ig.read_folder(spark, f"{root}/in", rows.schema, "parquet"), ["variable", "band", "scan"])
        ig.drain(stream, f"{root}/checkpoint", ig.folder_writer(f"{root}/archive"), mode="update")
    return ig.current_listing(spark, f"{root}/archive", ["variable", "band", "scan"]).select("variable", "band", "scan", "key")


@query("t05_publication_cutoff", f"""
WITH {LISTING} SELECT key, cycle, lead, modified FROM listing WHERE modified <= cycle + to_hours(lead)""")
def t05(spark, folder):
    root = new_folder(spark, "forecasts")
    rows = forecast_listing(spark, folder).withColumn("valid", valid_time())
    rows.write.parquet(f"{root}/in")
    stream = ig.published_by(ig.read_folder(spark, f"{root}/in", rows.schema, "parquet"), "modified", "valid")
    ig.drain(stream, f"{root}/checkpoint", lambda df, i: df.write.mode("overwrite").parquet(f"{root}/out/batch={i}"))
    return spark.read.parquet(f"{root}/out").select("key", "cycle", "lead", "modified")


@query("t06_stale_runs", f"""
WITH {OBSERVATIONS}, h AS (SELECT user_id, arg_max(CASE WHEN quality >= 50 THEN 'running' ELSE 'failed' END, (time, asset_id)) AS status, epoch_us(max(time)) / 1000000.0::DOUBLE AS heartbeat FROM observations GROUP BY user_id)
SELECT 'run-' || user_id AS run_id, status, heartbeat, CASE WHEN status = 'running' AND 1706659200.0 - heartbeat > 120 THEN 'unknown' ELSE status END AS shown_status FROM h""")
def t06(spark, folder):
    rows = observations(spark, folder)
    last = rows.groupBy("user_id").agg(F.max(F.struct("time", "asset_id", "quality")).alias("m"))
    beats = last.select(F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"), F.when(F.col("m.quality") >= 50, "running").otherwise("failed").alias("status"),
                        (micros("m.time") / 1_000_000.0).alias("heartbeat"))
    return rt.stale_runs(beats, 1706659200.0)


_T07 = f"""
WITH {RADAR}, {_YEAR}
SELECT cell::BIGINT AS cell, round(coalesce(sum(raw) FILTER (q AND ok), 0), 6) AS rqi_sum, count(*) FILTER (q AND ok) AS rqi_count, count(*) FILTER (NOT q AND ok) AS reflectivity_count
FROM u WHERE month < '2001-12' GROUP BY cell"""


@query("t07_month_state", _T07)
def t07(spark, folder):
    """Years arrive one after the other; the last month is still open and stays out."""
    root = new_folder(spark, "months")
    rows = radar_pixels(spark, folder).withColumn("month", F.date_format("time", "yyyy-MM"))
    rows = rows.select("product", "raw", "bitmap", "month", (F.col("y") * 32 + F.col("x")).cast("long").alias("cell"), (F.col("month") < "2001-12").alias("month_complete"))
    for part in ("month < '1999-01'", "month >= '1999-01'"):
        rows.filter(part).write.mode("append").parquet(f"{root}/in")
        ig.drain(ig.read_folder(spark, f"{root}/in", rows.schema, "parquet"), f"{root}/checkpoint", ig.month_writer(f"{root}/state"))
    out = ig.year_cells(spark, f"{root}/state")
    return out.withColumn("rqi_sum", F.round("rqi_sum", 6))


@query("t07_months_in_parts", _T07)
def t07p(spark, folder):
    """Every month comes in three batches, by rows of cells; the marks that close the months come with the last one. Every
    batch is run twice."""
    root = new_folder(spark, "months")
    rows = radar_pixels(spark, folder).withColumn("month", F.date_format("time", "yyyy-MM"))
    rows = rows.select("product", "raw", "bitmap", "month", "y", (F.col("y") * 32 + F.col("x")).cast("long").alias("cell"), F.lit(False).alias("month_complete"))
    marks = rows.filter("month < '2001-12'").groupBy("month").agg(F.max("product").alias("product")).select(
        "product", F.lit(None).cast(rows.schema["raw"].dataType).alias("raw"), F.lit(0).cast(rows.schema["bitmap"].dataType).alias("bitmap"), "month",
        F.lit(None).cast("long").alias("cell"), F.lit(True).alias("month_complete"))
    write = ig.month_writer(f"{root}/state")
    for third in range(3):
        part = rows.filter(F.pmod("y", F.lit(3)) == third).drop("y")
        part = part.unionByName(marks) if third == 2 else part
        part.write.mode("append").parquet(f"{root}/in")
        ig.drain(ig.read_folder(spark, f"{root}/in", part.schema, "parquet"), f"{root}/checkpoint", lambda df, i: (write(df, i), write(df, i)))
    return ig.year_cells(spark, f"{root}/state").withColumn("rqi_sum", F.round("rqi_sum", 6))
