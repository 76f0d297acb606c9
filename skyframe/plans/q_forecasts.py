"""Registered queries of the forecast family."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyframe.functions.labels import plain_descriptor
from skyframe.functions.times import literal_micros
from skyframe.operators import alignment as al
from skyframe.operators import forecasts as fc
from skyframe.plans.q_alignment import ALIGNED, aligned
from skyframe.plans.registry import query
from skyframe.plans.standins import (
    END, LISTING, OBSERVATIONS, RECORDS, START, STORMS, forecast_listing, index_lines, index_records, observations, storm_events)
from skyframe.sources import forecast_index as fi

SPECS = "specs(name, code, want_level, statistic) AS (VALUES " + ", ".join(str(s) for s in [*fi.CORE, *fi.UPPER]) + ")"
CORE_ONLY = "specs(name, code, want_level, statistic) AS (VALUES " + ", ".join(str(s) for s in fi.CORE) + ")"
MATCHED = """
matched AS (
  SELECT r.*, s.name FROM records r JOIN specs s ON r.field = s.code
  WHERE (r.level = s.want_level OR (s.want_level = 'entire atmosphere' AND starts_with(r.level, 'entire atmosphere')))
    AND CASE WHEN s.statistic = 'instant' THEN r.descriptor = CASE WHEN r.lead = 0 THEN 'anl' ELSE r.lead || ' hour fcst' END
        ELSE regexp_full_match(r.descriptor, '\\d+-\\d+ hour acc fcst') AND TRY_CAST(regexp_extract(r.descriptor, '-(\\d+) ', 1) AS INTEGER) = r.lead
             AND r.lead - TRY_CAST(regexp_extract(r.descriptor, '^(\\d+)-', 1) AS INTEGER) BETWEEN 1 AND 3 END)
"""
HOURS = "hours AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS hour)"
SERVED = """
served AS (
  SELECT h.hour, bool_or(l.key IS NOT NULL) AS listed, coalesce(bool_or(l.index_size IS NOT NULL AND l.key IS NOT NULL), false) AS indexed,
    max(l.cycle) FILTER (l.index_size IS NOT NULL AND l.modified <= h.hour - INTERVAL 10 MINUTE) AS cycle
  FROM hours h LEFT JOIN listing l ON l.cycle + to_hours(l.lead) = h.hour GROUP BY h.hour)
"""


def _with_lead(spark, folder):
    return index_records(spark, folder).join(forecast_listing(spark, folder).select("key", "lead", "cycle", "modified"), "key")


def _served(spark, folder):
    return fc.availability(fc.hour_spine(spark, START, END), forecast_listing(spark, folder))


@query("s09_byte_index", f"WITH {LISTING}, {RECORDS} SELECT key, start, stop, field, level, descriptor FROM records")
def s09(spark, folder):
    return index_records(spark, folder)


@query("f08_forecast_records", f"WITH {LISTING}, {RECORDS}, {SPECS}, {MATCHED} SELECT key, name, start, stop, descriptor FROM matched")
def f08(spark, folder):
    rows = fi.match_records(_with_lead(spark, folder), fi.spec_table(spark))
    return rows.select("key", "name", "start", "stop", "descriptor")


@query("f09_field_match", f"""WITH {LISTING}, {RECORDS} SELECT key, start, stop, level FROM records WHERE field = 'PWAT' AND starts_with(level, 'entire atmosphere')""")
def f09(spark, folder):
    return fi.match_field(index_records(spark, folder), "PWAT").select("key", "start", "stop", "level")


@query("u07_channel_union", f"WITH {CORE_ONLY.replace('specs(', 'core(')}, uni AS (SELECT * FROM core UNION SELECT * FROM (VALUES " + ", ".join(str(s) for s in fi.UPPER) + f""") u(name, code, want_level, statistic)),
{LISTING}, {RECORDS}
SELECT b.name, count(r.key) AS records FROM uni b LEFT JOIN records r ON r.field = b.code GROUP BY b.name""")
def u07c(spark, folder):
    both = fi.spec_table(spark, fi.CORE).union(fi.spec_table(spark, fi.UPPER)).distinct()
    counts = index_records(spark, folder).groupBy("field").agg(F.count(F.lit(1)).alias("n"))
    return both.join(counts, F.col("code") == F.col("field"), "left").select("name", F.coalesce("n", F.lit(0)).alias("records"))


@query("c10_plain_descriptors", f"""WITH {LISTING}, {RECORDS}
SELECT regexp_replace(descriptor, '\\d+(?:-\\d+)? hour', '<lead> hour', 'g') AS descriptor, count(*) AS records FROM records GROUP BY 1""")
def c10(spark, folder):
    return index_records(spark, folder).groupBy(plain_descriptor("descriptor").alias("descriptor")).agg(F.count(F.lit(1)).alias("records"))


@query("j07_forecast_availability", f"""
WITH {LISTING}, {HOURS}, {SERVED}
SELECT s.hour, listed, indexed, s.cycle, CAST(date_diff('hour', s.cycle, s.hour) AS INTEGER) AS lead, l.key FROM served s LEFT JOIN listing l ON l.cycle = s.cycle AND l.cycle + to_hours(l.lead) = s.hour""")
def j07(spark, folder):
    return _served(spark, folder).select("hour", "listed", "indexed", "cycle", "lead", "key")


@query("j08_forecast_fallback", f"""
WITH {LISTING}, {RECORDS}, {HOURS},
c AS (SELECT hour, unnest(range(0, 11)) AS k FROM hours),
d AS (SELECT hour, make_timestamp(epoch_us(hour) // 21600000000 * 21600000000 - k * 21600000000) AS cycle FROM c),
e AS (SELECT d.hour, d.cycle, CAST(date_diff('hour', d.cycle, d.hour) AS INTEGER) AS lead FROM d WHERE date_diff('hour', d.cycle, d.hour) <= 60),
r AS (SELECT e.*, l.key, CASE WHEN e.cycle > e.hour - INTERVAL 10 MINUTE THEN 'cycle-after-cutoff' WHEN l.key IS NULL OR l.index_size IS NULL THEN 'missing-object-or-index'
    WHEN l.modified IS NULL THEN 'unknown-availability' WHEN l.modified > e.hour - INTERVAL 10 MINUTE THEN 'archive-object-after-cutoff'
    WHEN l.key NOT IN (SELECT key FROM records WHERE field = 'REFC') THEN 'missing-field' END AS reason
  FROM e LEFT JOIN listing l ON l.cycle = e.cycle AND l.lead = e.lead),
b AS (SELECT hour, max(cycle) FILTER (reason IS NULL) AS cycle FROM r GROUP BY hour),
n AS (SELECT r.hour, r.reason, count(*) AS n FROM r JOIN b USING (hour) WHERE r.reason IS NOT NULL AND (b.cycle IS NULL OR r.cycle > b.cycle) GROUP BY ALL)
SELECT b.hour AS valid, CASE WHEN b.cycle IS NULL THEN 'unavailable' ELSE 'available' END AS status, b.cycle, CAST(date_diff('hour', b.cycle, b.hour) AS INTEGER) AS lead,
  coalesce((SELECT string_agg(reason || '=' || n, ',' ORDER BY reason) FROM n WHERE n.hour = b.hour), '') AS skipped FROM b""")
def j08(spark, folder):
    hours = fc.hour_spine(spark, START, END, name="valid")
    out = fc.select_with_reasons(hours, forecast_listing(spark, folder), index_records(spark, folder).select("key", "field"), "REFC")
    entries = F.array_sort(F.transform(F.map_entries("skipped"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))))
    return out.select("valid", "status", "cycle", "lead", F.array_join(entries, ",").alias("skipped"))


_STUDY_END = "2024-01-25T00:00:00"
REQUESTS = f"""
requests AS (SELECT DISTINCT event_id, hour, valid FROM (SELECT event_id, hour, unnest([hour, hour + INTERVAL 1 HOUR]) AS valid FROM storm_hours)
  WHERE valid < TIMESTAMP '2024-01-25')
"""


def _requests(spark, folder):
    return fc.forecast_requests(storm_events(spark, folder), _STUDY_END)


@query("j09_forecast_requests", f"WITH {STORMS}, {REQUESTS} SELECT event_id, hour, valid FROM requests")
def j09(spark, folder):
    return _requests(spark, folder)


TIMELY = f"""
asked AS (
  SELECT r.*, make_timestamp(epoch_us(valid) // 21600000000 * 21600000000 - k * 21600000000) AS cycle FROM requests r CROSS JOIN range(0, 11) t(k)),
cand AS (SELECT a.*, CAST(date_diff('hour', cycle, valid) AS INTEGER) AS lead FROM asked a WHERE cycle <= hour AND date_diff('hour', cycle, valid) <= 60),
judged AS (SELECT c.*, l.key, l.modified, CASE WHEN l.key IS NULL OR l.index_size IS NULL THEN 'missing-object-or-index' WHEN l.modified IS NULL THEN 'unknown-archive-time'
  WHEN l.modified > c.hour THEN 'archived-after-cutoff' END AS reason FROM cand c LEFT JOIN listing l ON l.cycle = c.cycle AND l.lead = c.lead),
uniq AS (SELECT key, name, min(start) AS start, min(stop) AS stop FROM matched GROUP BY key, name HAVING count(*) = 1),
members AS (SELECT * FROM judged WHERE reason IS NULL AND key IN (SELECT key FROM uniq)),
files AS (SELECT DISTINCT cycle, valid, lead, key, modified FROM judged WHERE reason IS NULL),
rows AS (SELECT f.*, u.name, u.start, u.stop FROM files f JOIN uniq u USING (key))
"""
_J10 = f"WITH {LISTING}, {RECORDS}, {CORE_ONLY}, {MATCHED}, {STORMS}, {REQUESTS}, {TIMELY}"


def _timely(spark, folder, requests=None):
    """Rows, usable pairs and gaps; only the index lines of files that serve a request are parsed."""
    requests = _requests(spark, folder) if requests is None else requests
    judged = fc.judged_requests(requests, forecast_listing(spark, folder))
    keys = fc.timely_files(judged).select("key").distinct()  # bounded by the calendar
    lines = index_lines(spark, folder).join(F.broadcast(keys), "key", "left_semi")
    return fc.timely_rows(judged, fi.parse_byte_index(lines), fi.spec_table(spark, fi.CORE))


@query("j10_timely_forecasts", f"{_J10} SELECT cycle, valid, lead, key, name, start, stop FROM rows")
def j10(spark, folder):
    return _timely(spark, folder)[0].select("cycle", "valid", "lead", "key", "name", "start", "stop")


@query("j10_forecast_gaps", f"""{_J10}
SELECT reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'missing-or-ambiguous-field', (SELECT count(*) FROM files) * 10 - (SELECT count(*) FROM rows)""")
def j10g(spark, folder):
    return _timely(spark, folder)[2]


@query("j10_event_coverage", f"{_J10} SELECT event_id, count(DISTINCT hour) AS covered_hours FROM members WHERE hour = valid GROUP BY event_id")
def j10c(spark, folder):
    requests = _requests(spark, folder)
    return fc.covered_hours(requests, _timely(spark, folder, requests)[1])


@query("j11_paired_cycles", f"""{_J10},
pairs AS (SELECT m.hour, r.name, r.cycle FROM (SELECT DISTINCT hour, cycle, valid FROM members) m JOIN rows r ON r.cycle = m.cycle AND r.valid = m.valid
  WHERE (r.valid = m.hour OR r.valid = m.hour + INTERVAL 1 HOUR) AND r.modified <= m.hour GROUP BY m.hour, r.name, r.cycle HAVING count(DISTINCT r.valid) = 2)
SELECT hour, name, max(cycle) AS latest_pair_cycle, string_agg(strftime(cycle, '%Y-%m-%dT%H:%M:%SZ'), ' ' ORDER BY cycle DESC) AS eligible_pair_cycles FROM pairs GROUP BY hour, name""")
def j11(spark, folder):
    rows, pairs, _ = _timely(spark, folder)
    return fc.paired_cycles(rows, pairs)


@query("j12_same_cycle_pairs", f"""
WITH {LISTING}, {RECORDS}, {CORE_ONLY}, {MATCHED},
uniq AS (SELECT key, name FROM matched GROUP BY key, name HAVING count(*) = 1),
f AS (SELECT l.cycle, l.lead, l.key, l.modified, u.name FROM listing l JOIN uniq u USING (key) WHERE l.index_size IS NOT NULL),
p AS (SELECT a.cycle + to_hours(a.lead) AS hour, a.name, a.cycle, a.lead, a.key AS key_first, b.key AS key_second FROM f a JOIN f b ON a.cycle = b.cycle AND a.name = b.name AND b.lead = a.lead + 1
  WHERE a.modified <= a.cycle + to_hours(a.lead) AND b.modified <= a.cycle + to_hours(a.lead))
SELECT hour, name, cycle, lead, key_first, key_second FROM p QUALIFY row_number() OVER (PARTITION BY hour, name ORDER BY cycle DESC) = 1""")
def j12(spark, folder):
    records = fi.parse_byte_index(index_lines(spark, folder), carry=["cycle", "lead", "modified"])
    return fc.same_cycle_pairs(forecast_listing(spark, folder), records, fi.spec_table(spark, fi.CORE))


@query("j13_byte_ranges", f"""{_J10}
SELECT key, start, stop, string_agg(DISTINCT name, ',' ORDER BY name) AS fields, stop - start AS bytes FROM rows GROUP BY key, start, stop""")
def j13(spark, folder):
    return fc.byte_ranges(_timely(spark, folder)[0], ["key"])


@query("j13_selected_bytes", f"""{_J10} SELECT sum(stop - start)::BIGINT AS selected_bytes FROM (SELECT DISTINCT key, start, stop FROM rows)""")
def j13b(spark, folder):
    return fc.selected_bytes(_timely(spark, folder)[0], ["key"])


@query("j14_rain_context", f"""
WITH {OBSERVATIONS}, {STORMS},
f AS (SELECT epoch_us(time) AS u, max_by(quality / 100.0::DOUBLE, value) AS vf, max(value) AS peak FROM observations GROUP BY ALL),
h AS (SELECT s.event_id, s.hour, epoch_us(s.hour) AS w FROM storm_hours s),
j AS (SELECT h.event_id, CASE WHEN w - u <= 300000000 THEN vf END AS vf, CASE WHEN w - u <= 300000000 THEN peak END AS peak FROM h ASOF LEFT JOIN f ON h.w >= f.u)
SELECT s.event_id, count(*) FILTER (vf > 0) AS hours_observed, round(coalesce(avg(vf) FILTER (vf > 0), 0), 9) AS valid_fraction, max(peak) FILTER (vf > 0) AS peak
FROM storms s LEFT JOIN j USING (event_id) GROUP BY s.event_id""")
def j14(spark, folder):
    # Of equal values the first observation counts, as in the order of the table.
    first = F.when(F.col("quality").isNotNull() & F.col("value").isNotNull(), F.struct("value", -F.col("asset_id")))
    frames = observations(spark, folder).groupBy("time").agg(
        F.max_by(F.col("quality") / 100.0, first).alias("valid_fraction"), F.max("value").alias("peak"))
    out = fc.rain_context(storm_events(spark, folder), frames)
    return out.withColumn("valid_fraction", F.round("valid_fraction", 9))


@query("a13_month_summary", f"""
WITH {LISTING}, {HOURS}, {SERVED},
cy AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 18:00:00', INTERVAL 6 HOUR)) AS cycle),
pc AS (SELECT cycle, count(DISTINCT lead) AS leads, count(*) AS n, count(index_size) AS ix, sum(size) AS b FROM listing GROUP BY cycle),
a AS (SELECT strftime(cycle, '%Y-%m') AS month, count(*) AS cycles_expected, count(leads) AS cycles_listed, count(*) FILTER (leads = 61) AS complete_cycles,
  coalesce(sum(n), 0)::BIGINT AS objects, coalesce(sum(ix), 0)::BIGINT AS indexed_objects, coalesce(sum(b), 0)::BIGINT AS listed_bytes FROM cy LEFT JOIN pc USING (cycle) GROUP BY 1),
h AS (SELECT strftime(s.hour, '%Y-%m') AS month, count(*) AS hours_expected, count(*) FILTER (listed) AS hours_listed, count(*) FILTER (indexed) AS hours_indexed,
  count(s.cycle) AS hours_asof, coalesce(sum(l.size), 0)::BIGINT AS asof_bytes FROM served s LEFT JOIN listing l ON l.cycle = s.cycle AND l.cycle + to_hours(l.lead) = s.hour GROUP BY 1)
SELECT * FROM a JOIN h USING (month)""")
def a13(spark, folder):
    return fc.month_summary(spark, forecast_listing(spark, folder), START, END)


@query("a13_lead_histogram", f"WITH {LISTING}, {HOURS}, {SERVED} SELECT CAST(date_diff('hour', cycle, hour) AS INTEGER) AS lead, count(*) AS objects FROM served WHERE cycle IS NOT NULL GROUP BY 1")
def a13l(spark, folder):
    return fc.lead_histogram(_served(spark, folder))


@query("w07_gap_runs", f"""
WITH {LISTING}, {HOURS}, {SERVED},
m AS (SELECT hour, row_number() OVER (ORDER BY hour) AS r FROM served WHERE cycle IS NULL)
SELECT min(hour) AS start, max(hour) + INTERVAL 1 HOUR AS "end", count(*) AS hours FROM m GROUP BY hour - to_hours(r)""")
def w07(spark, folder):
    return fc.gap_runs(_served(spark, folder).filter("cycle is null"))


@query("a14_field_summary", f"""
WITH {LISTING}, {RECORDS}
SELECT field, count(DISTINCT key) AS samples, string_agg(DISTINCT level, '|' ORDER BY level) AS levels,
  string_agg(DISTINCT regexp_replace(descriptor, '\\d+(?:-\\d+)? hour', '<lead> hour', 'g'), '|' ORDER BY regexp_replace(descriptor, '\\d+(?:-\\d+)? hour', '<lead> hour', 'g')) AS descriptors FROM records GROUP BY field""")
def a14(spark, folder):
    return fc.field_summary(index_records(spark, folder), ["key"])


@query("a14_channel_summary", f"""
WITH {LISTING}, {RECORDS}, {SPECS}, {MATCHED},
p AS (SELECT key, name, count(*) AS n, min(stop - start) AS b FROM (SELECT DISTINCT key, name, start, stop FROM matched) GROUP BY ALL)
SELECT s.name, count(*) FILTER (n = 1) AS samples, count(*) FILTER (n > 1) AS ambiguous, round(quantile_cont(b::DOUBLE, 0.1) FILTER (n = 1), 6) AS p10,
  round(quantile_cont(b::DOUBLE, 0.5) FILTER (n = 1), 6) AS median, round(quantile_cont(b::DOUBLE, 0.9) FILTER (n = 1), 6) AS p90
FROM specs s LEFT JOIN p USING (name) GROUP BY s.name""")
def a14c(spark, folder):
    out = fc.channel_summary(_with_lead(spark, folder), fi.spec_table(spark), ["key"])
    return out.withColumns({c: F.round(c, 6) for c in ("p10", "median", "p90")})


@query("a14_profile_sizes", f"""
WITH {LISTING}, {RECORDS}, {CORE_ONLY}, {MATCHED},
p AS (SELECT key, name, count(*) AS n FROM (SELECT DISTINCT key, name, start, stop FROM matched) GROUP BY ALL),
w AS (SELECT key FROM p GROUP BY key HAVING count(*) FILTER (n = 1) = 10)
SELECT key, sum(stop - start)::BIGINT AS profile_bytes FROM (SELECT DISTINCT key, start, stop FROM matched WHERE key IN (SELECT key FROM w)) GROUP BY key""")
def a14p(spark, folder):
    return fc.profile_sizes(_with_lead(spark, folder), fi.spec_table(spark, fi.CORE), ["key"])


@query("a14_accumulation_windows", f"""
WITH {LISTING}, {RECORDS}, {CORE_ONLY}, {MATCHED}
SELECT CAST(lead - CAST(regexp_extract(descriptor, '^(\\d+)-', 1) AS INTEGER) AS INTEGER) AS window_hours, count(*) AS records FROM matched WHERE name = 'precipitation_accumulation' GROUP BY 1""")
def a14w(spark, folder):
    return fc.accumulation_windows(_with_lead(spark, folder), fi.spec_table(spark, fi.CORE))


@query("a15_storm_coverage", f"""
WITH {LISTING}, {HOURS}, {SERVED}, {STORMS}
SELECT event_id, count(*) AS hours, count(*) FILTER (indexed) AS indexed, count(cycle) AS asof FROM storm_hours LEFT JOIN served USING (hour) GROUP BY event_id""")
def a15(spark, folder):
    return fc.storm_coverage(fc.event_hours(storm_events(spark, folder)), _served(spark, folder))


@query("a26_message_medians", f"""
WITH {LISTING}, {RECORDS}
SELECT field, level, count(*) AS samples, round(quantile_cont((stop - start)::DOUBLE, 0.5), 6) AS median_bytes FROM records GROUP BY ALL""")
def a26(spark, folder):
    rows = index_records(spark, folder).withColumn("bytes", F.col("stop") - F.col("start"))
    return fc.message_medians(rows, ["field", "level"], ["bytes"]).withColumn("median_bytes", F.round("median_bytes", 6))


@query("a35_window_availability", f"""
WITH {OBSERVATIONS}, {ALIGNED}, {HOURS},
s AS (SELECT slot FROM aligned GROUP BY slot HAVING count(DISTINCT variable) = 5),
t AS (SELECT hour, o, count(s.slot) AS n FROM hours CROSS JOIN (SELECT unnest([-10, 0, 10]) AS o) CROSS JOIN (SELECT unnest(range(-60, 10, 10)) AS l)
  LEFT JOIN s ON s.slot = epoch_us(hour) + CAST(o + l AS BIGINT) * 60000000 GROUP BY hour, o)
SELECT hour, count(*) FILTER (n = 7) AS complete_windows FROM t GROUP BY hour""")
def a35(spark, folder):
    return fc.window_availability(aligned(spark, folder), fc.hour_spine(spark, START, END), 5)


@query("w14_cycle_samples", f"""
WITH {LISTING},
c AS (SELECT DISTINCT cycle, strftime(cycle, '%Y-%m') AS month, hour(cycle) // 6 AS o FROM listing),
p AS (SELECT *, row_number() OVER (PARTITION BY month, o ORDER BY cycle) - 1 AS pos, count(*) OVER (PARTITION BY month, o) AS n FROM c)
SELECT l.cycle, l.lead, l.key FROM listing l JOIN p USING (cycle) WHERE pos = n * o // 4 AND l.lead IN (0, 1, 2, 3, 6, 12, 24, 36, 60) AND index_size IS NOT NULL""")
def w14(spark, folder):
    return fc.cycle_samples(forecast_listing(spark, folder), START.rstrip("Z"))


@query("w14_hourly_samples", f"""
WITH {LISTING}, {HOURS}, {SERVED},
p AS (SELECT hour, cycle, hour(hour) AS h, row_number() OVER (PARTITION BY strftime(hour, '%Y-%m'), hour(hour) ORDER BY hour) - 1 AS pos,
  count(*) OVER (PARTITION BY strftime(hour, '%Y-%m'), hour(hour)) AS n FROM served WHERE cycle IS NOT NULL)
SELECT hour, cycle, CAST(date_diff('hour', cycle, hour) AS INTEGER) AS lead FROM p WHERE pos = n * h // 24""")
def w14h(spark, folder):
    return fc.hourly_samples(_served(spark, folder)).select("hour", "cycle", "lead")


@query("e01_event_hours", f"WITH {STORMS} SELECT event_id, hour FROM storm_hours")
def e01(spark, folder):
    return fc.event_hours(storm_events(spark, folder)).select("event_id", "hour")


@query("e03_frame_times", f"""
WITH {STORMS} SELECT event_id, hour, unnest(generate_series(hour - INTERVAL 50 MINUTE, hour + INTERVAL 60 MINUTE, INTERVAL 10 MINUTE)) AS time FROM storm_hours""")
def e03(spark, folder):
    return fc.sample_times(fc.event_hours(storm_events(spark, folder)).select("event_id", "hour"))


@query("e06_hourly_at_minute", f"""
WITH {OBSERVATIONS}, {HOURS},
s AS (SELECT *, epoch_us(time) AS u, epoch_us(time) + ((600000000 - epoch_us(time) % 600000000) % 600000000) AS slot FROM observations),
m AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY u DESC, key) AS r FROM s WHERE slot - u <= 300000000 AND slot < {literal_micros(END)})
SELECT h.hour, m.asset_id, m.time AS source_time FROM hours h LEFT JOIN m ON m.r = 1 AND m.slot = epoch_us(h.hour) + 600000000""")
def e06(spark, folder):
    matched = al.match_previous(observations(spark, folder).withColumn("variable", F.lit("all")), START, END, 10, 5, ["variable"])
    return fc.hourly_at_minute(matched.withColumnRenamed("time", "source_time"), START, END)
