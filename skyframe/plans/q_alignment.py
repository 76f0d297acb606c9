"""Registered queries of the matching family."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyframe.functions.times import literal_micros
from skyframe.operators import alignment as al
from skyframe.operators.sequences import with_previous, with_running
from skyframe.plans.registry import query, table
from skyframe.plans.standins import END, OBSERVATIONS, START, observations

_T0, _T1 = literal_micros(START), literal_micros(END)
_FIRST = _T0 - 50 * 60_000_000

# Causal alignment in SQL: bucket ranks, then the one observation that may serve the next slot.
ALIGNED = f"""
bucketed AS (
  SELECT *, epoch_us(end_time) AS e, epoch_us(end_time) + ((600000000 - epoch_us(end_time) % 600000000) % 600000000) AS b
  FROM observations),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY variable, b ORDER BY e DESC, time DESC, asset_id DESC) AS r FROM bucketed),
candidate AS (
  SELECT *, b AS slot, 0 AS carried FROM ranked WHERE r = 1 AND b - e <= tolerance_s * 1000000 AND b >= {_FIRST}
  UNION ALL
  SELECT *, b + 600000000, 1 FROM ranked
  WHERE e = b AND tolerance_s = 600 AND b >= {_FIRST - 600_000_000} AND r = CASE WHEN b < {_FIRST} THEN 1 ELSE 2 END),
aligned AS (
  SELECT * EXCLUDE (k), make_timestamp(slot) AS slot_time, (epoch_us(time) - slot) / 1000000.0 AS offset_seconds FROM (
    SELECT *, row_number() OVER (PARTITION BY variable, slot ORDER BY carried) AS k FROM candidate WHERE slot < {_T1})
  WHERE k = 1)
"""


def aligned(spark, folder):
    return al.causal_align(observations(spark, folder), START, END)


@query("j01_causal_align", f"""
WITH {OBSERVATIONS}, {ALIGNED}
SELECT asset_id, variable, time, end_time, slot_time, CAST(offset_seconds AS DOUBLE) AS offset_seconds FROM aligned""")
def j01(spark, folder):
    return aligned(spark, folder).select("asset_id", "variable", "time", "end_time", "slot_time", "offset_seconds")


_PREVIOUS = f"""
WITH {OBSERVATIONS},
slotted AS (
  SELECT *, epoch_us(time) AS u, epoch_us(time) + ((3600000000 - epoch_us(time) % 3600000000) % 3600000000) AS slot
  FROM observations),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY variable, slot ORDER BY u DESC, key) AS r FROM slotted
  WHERE slot - u <= {{tolerance}} AND slot >= {_T0} AND slot < {_T1})
SELECT variable, key, time, make_timestamp(slot) AS slot_time, CAST((u - slot) / 1000000.0 AS DOUBLE) AS offset_seconds
FROM ranked WHERE r = 1"""
_MATCH = ["variable", "key", "time", "slot_time", "offset_seconds"]


@query("j02_match_previous", _PREVIOUS.format(tolerance=1_800_000_000))
def j02(spark, folder):
    return al.match_previous(observations(spark, folder), START, END, 60, 30, ["variable"]).select(*_MATCH)


@query("j02_match_exact", _PREVIOUS.format(tolerance=0))
def j02_exact(spark, folder):
    return al.match_previous(observations(spark, folder), START, END, 60, 0, ["variable"], exact=True).select(*_MATCH)


@query("j03_match_nearest", f"""
WITH {OBSERVATIONS},
slotted AS (SELECT *, epoch_us(time) AS u, ((epoch_us(time) + 1800000000) // 3600000000) * 3600000000 AS slot FROM observations),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY variable, slot ORDER BY abs(u - slot), u > slot, key) AS r FROM slotted
  WHERE abs(u - slot) <= 1740000000 AND slot >= {_T0} AND slot < {_T1})
SELECT variable, key, time, make_timestamp(slot) AS slot_time, CAST((u - slot) / 1000000.0 AS DOUBLE) AS offset_seconds
FROM ranked WHERE r = 1""")
def j03(spark, folder):
    return al.match_nearest(observations(spark, folder), START, END, 60, 29, ["variable"]).select(*_MATCH)


@query("j03_match_nearest_half_cadence", f"""
WITH RECURSIVE {OBSERVATIONS},
src AS (SELECT variable, key, time, epoch_us(time) AS u FROM observations),
inner_best AS (
  SELECT * FROM (SELECT *, ((u + 300000000) // 600000000) * 600000000 AS slot,
    row_number() OVER (PARTITION BY variable, ((u + 300000000) // 600000000) ORDER BY
      abs(u - ((u + 300000000) // 600000000) * 600000000), u > ((u + 300000000) // 600000000) * 600000000, key) AS r
    FROM src WHERE u % 600000000 <> 300000000) WHERE r = 1),
mid AS (
  SELECT *, row_number() OVER (PARTITION BY variable, u ORDER BY key) AS r, u + 300000000 AS slot
  FROM src WHERE u % 600000000 = 300000000),
slots AS (
  SELECT v.variable, s.slot, i.key AS own, l1.key AS l1, l2.key AS l2, r1.key AS r1
  FROM (SELECT DISTINCT variable FROM src) v
  CROSS JOIN (SELECT unnest(range({_T0}, {_T1}, 600000000)) AS slot) s
  LEFT JOIN inner_best i ON i.variable = v.variable AND i.slot = s.slot
  LEFT JOIN mid l1 ON l1.variable = v.variable AND l1.slot = s.slot AND l1.r = 1
  LEFT JOIN mid l2 ON l2.variable = v.variable AND l2.slot = s.slot AND l2.r = 2
  LEFT JOIN mid r1 ON r1.variable = v.variable AND r1.slot = s.slot + 600000000 AND r1.r = 1),
walk AS (
  SELECT slot, variable, own, l1, l2, r1, 0 AS taken FROM slots WHERE slot = {_T0}
  UNION ALL
  SELECT n.slot, n.variable, n.own, n.l1, n.l2, n.r1,
    CASE WHEN w.own IS NULL AND (CASE WHEN w.taken = 0 THEN w.l1 ELSE w.l2 END) IS NULL AND w.r1 IS NOT NULL THEN 1 ELSE 0 END
  FROM walk w JOIN slots n ON n.variable = w.variable AND n.slot = w.slot + 600000000),
picked AS (
  SELECT variable, slot, coalesce(own, CASE WHEN taken = 0 THEN l1 ELSE l2 END, r1) AS key FROM walk)
SELECT p.variable, p.key, s.time, make_timestamp(p.slot) AS slot_time, CAST((s.u - p.slot) / 1000000.0 AS DOUBLE) AS offset_seconds
FROM picked p JOIN src s ON s.key = p.key""")
def j03_half(spark, folder):
    return al.match_nearest(observations(spark, folder), START, END, 10, 5, ["variable"]).select(*_MATCH)


@query("j04_latest_at", f"""
WITH {OBSERVATIONS},
o AS (SELECT variable, epoch_us(time) AS u, max(key) AS key FROM observations GROUP BY ALL),
req AS (SELECT o_orderkey AS ord, list_extract(['click','error','purchase','signup','view'], CAST(o_custkey % 5 + 1 AS INTEGER)) AS variable,
        epoch_us(TIMESTAMP '2024-01-01') + (o_orderkey * 7919 % 44640) * 60000000 AS want FROM orders)
SELECT r.ord, r.variable, make_timestamp(r.want) AS time, CASE WHEN r.want - o.u <= 1200000000 THEN o.key END AS hit_key,
       CASE WHEN r.want - o.u <= 1200000000 THEN make_timestamp(o.u) END AS hit_time
FROM req r ASOF LEFT JOIN o ON r.variable = o.variable AND r.want >= o.u""")
def j04(spark, folder):
    from skyframe.plans.registry import table

    names = F.array(*[F.lit(v) for v in ("click", "error", "purchase", "signup", "view")])
    base = literal_micros(START)
    requests = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ord"), names[(F.col("o_custkey") % 5).cast("int")].alias("variable"),
        F.timestamp_micros(F.lit(base) + (F.col("o_orderkey") * 7919 % 44640) * 60_000_000).cast("timestamp_ntz").alias("time"))
    out = al.latest_at(requests, observations(spark, folder), ["variable"], 20, ties=["key"], payload=["key", "time"])
    return out.select("ord", "variable", "time", F.col("hit.key").alias("hit_key"), F.col("hit.time").alias("hit_time"))


@query("j05_decimate", f"""
WITH RECURSIVE {OBSERVATIONS},
src AS (SELECT band, variable, key, time, epoch_us(time) AS u, epoch_us(date_trunc('hour', time)) AS h FROM observations),
pick AS (
  SELECT h, variable, 0 AS mark, (SELECT NULL::VARCHAR[]) AS used FROM (SELECT DISTINCT h, variable FROM src)
  UNION ALL
  SELECT p.h, p.variable, p.mark + 1, list_append(coalesce(p.used, []), (
    SELECT arg_min(s.key, (abs(s.u - p.h - p.mark * 1800000000), s.u, s.key)) FROM src s
    WHERE s.h = p.h AND s.variable = p.variable AND NOT list_contains(coalesce(p.used, []), s.key)))
  FROM pick p WHERE p.mark < 2),
chosen AS (SELECT DISTINCT unnest(used) AS key FROM pick WHERE mark = 2)
SELECT s.variable, s.key, s.time FROM src s JOIN chosen c ON s.key = c.key""")
def j05(spark, folder):
    return al.decimate(observations(spark, folder), 2, ["variable"]).select("variable", "key", "time")


_HEIGHTS = "heights AS (SELECT satellite, epoch_us(end_time) AS e, max(asset_id) AS height_id FROM observations WHERE variable = 'view' GROUP BY ALL)"


@query("j06_height_match", f"""
WITH {OBSERVATIONS}, {_HEIGHTS},
rec AS (SELECT asset_id, satellite, end_time, epoch_us(end_time) AS w FROM observations WHERE variable <> 'view')
SELECT r.asset_id, r.satellite, r.end_time, CASE WHEN w - e <= 1200000000 THEN height_id END AS height_id,
       CASE WHEN w - e <= 1200000000 THEN CAST((w - e) / 1000000.0 AS DOUBLE) END AS height_age_seconds
FROM rec r ASOF LEFT JOIN heights h ON r.satellite = h.satellite AND r.w >= h.e""")
def j06(spark, folder):
    obs = observations(spark, folder)
    heights = obs.filter("variable = 'view'").select("satellite", "end_time", F.col("asset_id").alias("height_id"))
    records = obs.filter("variable <> 'view'").select("asset_id", "satellite", "end_time")
    return al.height_match(records, heights)


@query("j19_nearest_peers", f"""
WITH {OBSERVATIONS},
anchor AS (SELECT asset_id AS anchor_id, time AS anchor_time, epoch_us(time) AS w FROM observations WHERE variable = 'click'),
peer AS (SELECT band, epoch_us(time) AS u, min(key) AS key FROM observations WHERE variable <> 'click' GROUP BY ALL),
want AS (SELECT a.*, b.band FROM anchor a, (SELECT unnest(range(1, 9)) AS band) b),
ranked AS (
  SELECT anchor_id, anchor_time, w.band, key, make_timestamp(u) AS time,
    row_number() OVER (PARTITION BY anchor_id, w.band ORDER BY abs(u - w), u) AS r
  FROM want w JOIN peer p ON p.band = w.band AND abs(u - w) <= 90000000)
SELECT anchor_id, anchor_time, CAST(band AS INTEGER) AS band, key, time FROM ranked WHERE r = 1""")
def j19(spark, folder):
    obs = observations(spark, folder)
    bands = F.explode(F.array(*[F.lit(b) for b in range(1, 9)]))
    anchors = obs.filter("variable = 'click'").select(
        F.col("asset_id").alias("anchor_id"), F.col("time").alias("anchor_time"), bands.alias("band"))
    return al.nearest_peers(obs.filter("variable <> 'click'"), anchors, ["band"])


@query("j21_hybrid_band", f"""
WITH {OBSERVATIONS},
scan AS (SELECT satellite, time, band, min(key) AS key FROM observations GROUP BY ALL),
one AS (SELECT satellite, time, band, max(key) AS key FROM observations WHERE variable IN ('click', 'view') GROUP BY ALL),
many AS (SELECT satellite, time, band, max(key) AS key FROM observations WHERE variable IN ('error', 'purchase') GROUP BY ALL)
SELECT s.satellite, s.time, s.band, coalesce(o.key, m.key) AS key,
       CASE WHEN o.key IS NOT NULL THEN 'single' WHEN m.key IS NOT NULL THEN 'multiband' END AS origin
FROM scan s LEFT JOIN one o USING (satellite, time, band) LEFT JOIN many m USING (satellite, time, band)""")
def j21(spark, folder):
    obs = observations(spark, folder)
    keys = ["satellite", "time", "band"]

    def copies(*names):
        return obs.filter(F.col("variable").isin(*names)).groupBy(*keys).agg(
            F.max("key").alias("key"), F.lit("g1").alias("grid_hash"))

    return al.hybrid_band(obs.select(*keys).distinct(), copies("click", "view"), copies("error", "purchase"), keys, "key")


@query("j23_comparable_times", f"""
WITH {OBSERVATIONS}, wanted AS (SELECT DISTINCT date_trunc('minute', ts) AS time FROM events WHERE event_type = 'view')
SELECT asset_id, variable, time, time IN (SELECT time FROM wanted) AS comparable FROM observations WHERE variable <> 'view'""")
def j23(spark, folder):
    obs = observations(spark, folder)
    wanted = obs.filter("variable = 'view'").select("time").distinct()
    kept, omitted = al.comparable(obs.filter("variable <> 'view'"), wanted, ["time"])
    both = kept.withColumn("comparable", F.lit(True)).unionByName(omitted.withColumn("comparable", F.lit(False)))
    return both.select("asset_id", "variable", "time", "comparable")


@query("j24_observation_at", f"""
WITH {OBSERVATIONS}, {ALIGNED}
SELECT asset_id, variable, time, slot_time FROM aligned
WHERE (variable, slot_time) IN (SELECT (variable, max(slot_time)) FROM aligned GROUP BY variable, date_trunc('day', slot_time))""")
def j24(spark, folder):
    """The last slot of every variable and day."""
    rows = aligned(spark, folder)
    asked = rows.groupBy("variable", F.date_trunc("day", "slot_time").alias("_day")).agg(F.max("slot_time").alias("slot_time"))
    return al.observations_at(rows, asked).select("asset_id", "variable", "time", "slot_time")


def _window_sql(history, targets, variables, rows="aligned", start=_T0, end=_T1, ids=False):
    source = "('0x' || substr(sha256(concat_ws('/', variable, slot, asset_id)), 1, 15))::BIGINT::HUGEINT" if ids else "0"
    identity = f"substr(sha256(concat_ws('|', c.w::VARCHAR, '{history}', '{targets}', coalesce(sources::VARCHAR, 'none'))), 1, 24) AS window_id, " if ids else ""
    need = (history + targets) * variables
    return f"""
clock AS (SELECT unnest(range({start}, {end}, 600000000)) AS w),
spread AS (
  SELECT unnest(range(slot - {targets * 600_000_000}, slot + {(history - 1) * 600_000_000 + 1}, 600000000)) AS w, {source} AS source FROM {rows}),
found AS (SELECT w, count(*) AS n, sum(source) AS sources FROM spread GROUP BY w)
SELECT {identity}make_timestamp(c.w) AS time, coalesce(n, 0) = {need} AS eligible, CAST({need} - coalesce(n, 0) AS BIGINT) AS missing_observations,
       {history} AS history, {targets} AS targets
FROM clock c LEFT JOIN found f ON c.w = f.w"""


@query("w01_window_eligibility", f"WITH {OBSERVATIONS}, {ALIGNED}, {_window_sql(6, 1, 5, ids=True)}")
def w01(spark, folder):
    return al.window_index(aligned(spark, folder), START, END, 5, history=6, targets=1)


_S0, _S1 = "2024-01-08T00:00:00Z", "2024-01-22T00:00:00Z"
_SPLIT = f"split AS (SELECT * FROM aligned WHERE slot >= {literal_micros(_S0)} AND slot < {literal_micros(_S1)})"


@query("w02_training_windows", f"""
WITH {OBSERVATIONS}, {ALIGNED}, {_SPLIT}, {_window_sql(6, 1, 5, "split", literal_micros(_S0), literal_micros(_S1))}""")
def w02(spark, folder):
    return al.training_windows(aligned(spark, folder), _S0.rstrip("Z"), _S1.rstrip("Z"), 5).drop("window_id")


@query("w04_newest_version", f"""
WITH {OBSERVATIONS},
kept AS (SELECT variable, band, date_trunc('hour', time) AS scan, max(key) AS kept_key FROM observations GROUP BY ALL)
SELECT o.variable, o.band, date_trunc('hour', o.time) AS scan, o.key AS discarded_key, kept_key
FROM observations o JOIN kept k ON o.variable = k.variable AND o.band = k.band AND date_trunc('hour', o.time) = k.scan
WHERE o.key <> kept_key""")
def w04(spark, folder):
    obs = observations(spark, folder).withColumn("scan", F.date_trunc("hour", "time").cast("timestamp_ntz"))
    return al.newest_version(obs, ["variable", "band", "scan"])[1]


@query("w05_change_points", f"""
WITH {OBSERVATIONS},
l AS (SELECT *, lag(band) OVER (PARTITION BY variable ORDER BY time, key) AS from_band FROM observations)
SELECT variable, time, key, from_band, band FROM l WHERE from_band <> band""")
def w05(spark, folder):
    obs = observations(spark, folder).withColumn("_us", F.unix_micros(F.col("time").cast("timestamp")))
    rows = al.change_points(obs, ["variable"], ["_us", "key"], "band")
    return rows.select("variable", "time", "key", "from_band", "band")


@query("w05_hot_key_running", """
SELECT event_id, sum(CAST(round(value * 100) AS BIGINT)) OVER w::BIGINT AS upto, lag(event_id) OVER w AS before
FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id % 50 END AS k FROM events) WINDOW w AS (PARTITION BY k ORDER BY ts, event_id)""")
def w05h(spark, folder):
    """Ordered scans with a third of the rows in one key, which is NULL."""
    key = F.when(F.col("event_id") % 3 != 0, F.col("user_id") % 50)
    rows = table(spark, folder, "events").select(key.alias("k"), "ts", "event_id", F.round(F.col("value") * 100).cast("long").alias("v"))
    summed = with_running(rows, ["k"], ["ts", "event_id"], F.col("v"), "upto")
    return with_previous(summed, ["k"], ["ts", "event_id"], ["event_id"]).select("event_id", "upto", F.col("prev_event_id").alias("before"))
