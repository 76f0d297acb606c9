from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyframe.functions import labels
from skyframe.functions import times as tm
from skyframe.functions.checks import require_empty
from skyframe.operators import forecasts as fc
from skyframe.operators import inventory as iv
from skyframe.operators import merges as mg
from skyframe.operators import reports as rp
from skyframe.sources import forecast_index as fi
from skyframe.sources import manifests as mf
from skyframe.sources import writers as wr


def test_byte_index_example(spark):
    lines = [("k", f"{i}:{o}:d:F{i}:L:anl:", 240) for i, o in enumerate((0, 120, 120))] + [("k", "not a line", 240)]
    df = spark.createDataFrame(lines, "key string, line string, size long")
    rows = fi.parse_byte_index(df).orderBy("field").collect()
    assert [(r.start, r.stop) for r in rows] == [(0, 120), (120, 240), (120, 240)]
    with pytest.raises(Exception, match="Malformed"):
        fi.parse_byte_index(df.withColumn("size", F.lit(100).cast("long"))).collect()


def test_record_predicates(spark):
    rows = [("APCP", "surface", "0-3 hour acc fcst"), ("APCP", "surface", "2-3 hour max fcst"), ("APCP", "surface", "0-4 hour acc fcst"),
            ("PRATE", "surface", "3 hour fcst"), ("PRATE", "surface", "0-3 hour ave fcst"), ("PWAT", "entire atmosphere (single layer)", "3 hour fcst"), ("TMP", "surface", "3 hour fcst")]
    df = spark.createDataFrame([(*r, 3) for r in rows], "field string, level string, descriptor string, lead int")
    got = sorted(r.name for r in fi.match_records(df, fi.spec_table(spark)).collect())
    assert got == ["precipitable_water", "precipitation_accumulation", "precipitation_rate"]
    with pytest.raises(ValueError):
        fi.match_field(df, "NOPE")


def _listing(spark, rows):
    return spark.createDataFrame(rows, "cycle timestamp_ntz, lead int, key string, etag string, size long, index_size int, modified timestamp_ntz")


def test_fallback_example(spark):
    day = datetime(2024, 6, 1)
    listing = _listing(spark, [(day.replace(hour=18), 2, "new", "e", 9, 1, day.replace(hour=19, minute=51)),
                               (day.replace(hour=12), 8, "old", "e", 9, 1, day.replace(hour=13, minute=40))])
    fields = spark.createDataFrame([("new", "REFC"), ("old", "REFC")], "key string, field string")
    hours = spark.createDataFrame([(day.replace(hour=20),)], "valid timestamp_ntz")
    row = fc.select_with_reasons(hours, listing, fields, "REFC").first()
    assert (row.status, row.lead, row.skipped) == ("available", 8, {"archive-object-after-cutoff": 1})
    none = fc.select_with_reasons(hours, listing, fields.filter("key = 'none'"), "REFC").first()
    assert none.status == "unavailable" and none.skipped == {"archive-object-after-cutoff": 1, "missing-field": 1, "missing-object-or-index": 8}
    served = fc.availability(hours.withColumnRenamed("valid", "hour"), listing).first()
    assert (served.listed, served.indexed, served.lead) == (True, True, 8)


def test_requests_and_pairs(spark):
    start = datetime(2024, 8, 10, 0, 30)
    events = spark.createDataFrame([("E", start, start + timedelta(hours=1))], "event_id string, start timestamp_ntz, end timestamp_ntz")
    asked = fc.forecast_requests(events, "2024-08-11T00:00:00").orderBy("valid").collect()
    assert [(r.hour.hour, r.valid.hour) for r in asked] == [(1, 1), (1, 2)]
    cycle = datetime(2024, 8, 9, 18)
    listing = _listing(spark, [(cycle, 7, "a", "e", 500, 1, cycle), (cycle, 8, "b", "e", 500, 1, cycle),
                               (cycle + timedelta(hours=6), 1, "late", "e", 500, 1, cycle + timedelta(hours=9))])
    records = spark.createDataFrame([(k, 0, 100, "PRES", "surface", f"{lead} hour fcst") for k, lead in (("a", 7), ("b", 8), ("late", 1))],
                                    "key string, start long, stop long, field string, level string, descriptor string")
    rows, members, gaps = fc.timely_forecasts(spark.createDataFrame(asked), listing, records, fi.spec_table(spark, fi.CORE))
    pairs = fc.paired_cycles(rows, members).collect()
    assert [(p.name, p.latest_pair_cycle) for p in pairs] == [("surface_pressure", cycle)]
    reasons = {r.reason: r.n for r in gaps.collect()}
    assert reasons["archived-after-cutoff"] == 1 and reasons["missing-or-ambiguous-field"] == 18
    assert fc.selected_bytes(rows, ["key"]).first().selected_bytes == 200
    both = fc.same_cycle_pairs(listing, records, fi.spec_table(spark, fi.CORE)).collect()
    assert [(r.hour, r.cycle) for r in both] == [(datetime(2024, 8, 10, 1), cycle)]


def test_snapshot_merge_conflicts(spark):
    schema = "path string, sha256 string, stored_bytes long, note string"
    one = spark.createDataFrame([("p", "s", 8, "first"), ("q", None, 1, "first")], schema)
    two = spark.createDataFrame([("p", "s", 8, "second"), ("q", "x", 1, "second")], schema)
    assert {r.path: r.note for r in mg.merge_archives([one, two]).collect()} == {"p": "second", "q": "second"}
    with pytest.raises(Exception, match="Conflicting archive"):
        mg.merge_archives([one, two.withColumn("sha256", F.lit("other"))]).collect()
    cases = spark.createDataFrame([("c", 1.0)], "case_id string, seconds double")
    assert mg.merge_benchmarks([cases, cases]).count() == 1
    with pytest.raises(Exception, match="Conflicting benchmark"):
        mg.merge_benchmarks([cases, cases.withColumn("seconds", F.lit(2.0))]).collect()
    runs = spark.createDataFrame([("r", "complete", 5.0)], "run_id string, status string, wall_seconds double")
    with pytest.raises(Exception, match="completed fetch run"):
        mg.merge_fetch_runs([runs, runs.withColumn("wall_seconds", F.lit(6.0))]).collect()
    part = runs.withColumns({"status": F.lit("partial"), "wall_seconds": F.lit(9.0)})
    assert mg.merge_fetch_runs([part, runs]).first().status == "complete"


def test_verified_archive_completes_its_task(spark):
    tasks = spark.createDataFrame([("p", "r", "s", "x", "2024-01", 1, 4, 2, 0, "fetching", 1.0), ("z", "r", "s", "x", "2024-01", 1, 4, 4, 4, "complete", 1.0)],
                                  "task_id string, run_id string, source string, product string, month string, band int, selected long, checkpointed long, completed long, status string, updated_at double")
    archives = spark.createDataFrame([("p", 8, "s", "x", "2024-01", 1), ("n", 3, "s", "x", "2024-01", 1)], "path string, observations long, source string, product string, month string, band int")
    got = {r.task_id: (r.status, r.completed, r.selected, r.run_id) for r in mg.correct_tasks(tasks, archives, 5.0).collect()}
    assert got == {"p": ("complete", 8, 8, "r"), "z": ("unknown", 4, 4, "r"), "n": ("complete", 3, 3, "manifest-merge")}


def test_month_merge_and_adoption(spark):
    t = datetime(2024, 1, 1)
    old = spark.createDataFrame([("a", t, "old")], "asset_id string, time timestamp_ntz, origin string")
    new = spark.createDataFrame([("a", t, "new"), ("b", t, "new")], old.schema)
    assert [(r.asset_id, r.origin) for r in mg.merge_month(old, new).collect()] == [("a", "old"), ("b", "new")]
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "asset_id string")
    shared = spark.createDataFrame([("a", "h")], "asset_id string, content string")
    older = spark.createDataFrame([("a", "h"), ("b", "g"), ("b", "g")], "asset_id string, content string")
    got = {r.asset_id: (r.action, r.duplicates_removed) for r in mg.adoption_audit(wanted, shared, older).collect()}
    assert got == {"a": ("already_shared", 1), "b": ("moved", 1), "c": ("not_present", 0)}
    with pytest.raises(Exception, match="differ in content"):
        mg.adoption_audit(wanted, shared, older.withColumn("content", F.lit("zz"))).collect()


def test_storage_totals_example(spark):
    rows = [("x", 2, 6, 30, 30, 1.0), ("y", 1, 100, None, 100, 0.5)]
    df = spark.createDataFrame(rows, "path string, observations long, stored_bytes long, source_bytes long, known_asset_bytes long, source_size_coverage double")
    row = iv.storage_totals(df).first()
    assert row.source_bytes is None and row.known_source_bytes == 30 and row.source_coverage == 0.5 and row.known_asset_source_bytes == 130
    known = iv.storage_totals(df.filter("path = 'x'")).withColumns({"text": labels.ratio_text()})
    assert known.first().text == "20.0% of source (80.0% smaller)"
    empty = iv.storage_totals(df.filter("path = 'none'")).first()
    assert empty.source_bytes is None and empty.archives == 0 and empty.source_coverage == 0.0


def test_acquisition_coverage_example(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(t + timedelta(minutes=10 * i), "6") for i in range(6)], "time timestamp_ntz, mode string")
    rows = iv.acquisition_coverage(df, "2024-01-01T00:00:00", "2024-01-01T02:00:00").orderBy("hour").collect()
    assert [(r.observed_files, r.expected_files) for r in rows] == [(6, 6), (0, None)] and rows[1].note


def test_reconciliation_variants(spark):
    def run(archived, invalid=()):
        listed = spark.createDataFrame([("m", a) for a in "abc"], "month string, asset_id string")
        have = spark.createDataFrame([("m", a) for a in archived], listed.schema)
        bad = spark.createDataFrame([("m", a) for a in invalid], listed.schema) if invalid else listed.limit(0)
        return iv.reconcile(listed, have, bad, ["month"]).first()

    assert run("abc").consistent and run("ab", "c").consistent
    for archived, invalid in (("ab", ""), ("abca", ""), ("abcd", ""), ("abc", "c")):
        assert not run(archived, invalid).consistent
    with pytest.raises(Exception, match="already archived"):
        ids = spark.createDataFrame([("a",)], "asset_id string")
        iv.merge_new_rows(ids, ids, ids).collect()


def test_guards(spark):
    assets = spark.createDataFrame([("a", 5), ("b", 0)], "asset_id string, size long")
    good, empty = iv.split_empty(assets)
    assert good.count() == 1 and empty.first().reason == "zero_byte_noaa_object"
    with pytest.raises(Exception, match="negative"):
        iv.split_empty(assets.withColumn("size", F.lit(-1).cast("long")))[0].collect()
    with pytest.raises(Exception, match="violations"):
        require_empty(assets, "violations found").collect()
    issue = spark.createDataFrame([("a", "u", "e", 5, "t", "p", "r", 5, "e", "confirmed_corrupt_source")],
                                  "asset_id string, source_url string, etag string, source_bytes long, time string, product string, region string, download_bytes long, proof_etag string, status string")
    facts = spark.createDataFrame([("a", "u", "e", 5, "t")], "asset_id string, source_url string, etag string, size long, time string")
    assert iv.confirmed_issues(issue, facts, "p", "r").count() == 1
    with pytest.raises(Exception, match="does not match"):
        iv.confirmed_issues(issue.withColumn("etag", F.lit("other")), facts, "p", "r").collect()
    with pytest.raises(Exception, match="Too many"):
        obs = spark.createDataFrame([("a", "p", 1, "d", "s")], "asset_id string, path string, band int, dataset string, source string")
        mf.inventory(obs, limit=1).collect()


def test_times(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 5), datetime(2024, 1, 1, 1, 0))], "a timestamp_ntz, b timestamp_ntz")
    slots = df.select(tm.clock_slots("a", "b", 30).alias("s")).first().s
    assert slots == [datetime(2024, 1, 1, 0, 30)]
    with pytest.raises(ValueError):
        tm.clock_slots("a", "b", 7)
    texts = df.select(tm.clock_text(F.lit(3661.9)).alias("x"), tm.clock_text(F.lit(-5.0)).alias("y"), tm.clock_text(F.lit(None).cast("double")).alias("z")).first()
    assert tuple(texts) == ("01:01:01", "00:00:00", "--")
    sizes = df.select(labels.size_text(F.lit(None).cast("long")).alias("a"), labels.size_text(F.lit(1536)).alias("b"), labels.size_text(F.lit(12)).alias("c")).first()
    assert tuple(sizes) == ("unavailable", "1.5 KiB", "12 B")
    stamp = spark.range(1).select(mf.scan_stamp(F.lit("20240011230455")).alias("t")).first().t
    assert stamp == datetime(2024, 1, 1, 12, 30, 45, 500000)


def test_writers(spark, tmp_path):
    rows = spark.range(20).select("id", (F.col("id") % 2).alias("part"))
    wr.write_archives(rows, str(tmp_path / "a"), ["part"])
    wr.write_archives(rows.filter("part = 1").withColumn("id", F.col("id") + 100), str(tmp_path / "a"), ["part"])
    back = spark.read.parquet(str(tmp_path / "a"))
    assert back.filter("part = 0").count() == 10 and back.filter("part = 1").agg(F.min("id")).first()[0] == 101
    with pytest.raises(Exception, match="differ"):
        wr.verify_readback(rows.filter("id < 19"), rows, ["id"]).collect()
    with pytest.raises(ValueError):
        wr.export(rows, str(tmp_path / "b"), "xml")


def test_compact_tree_at_any_depth(spark):
    deep = '{"status":"s","records":[1,2],"asset_ids":["a"],"x":[{"assets":[],"y":{"features":"none","missing_times":[0],"é":1.50}},[{"hourly_matches":1}]]}'
    rows = spark.createDataFrame([(1, deep), (2, "[]"), (3, "no json"), (4, None), (5, "")], "id int, doc string")
    got = {r.id: r.out for r in rows.select("id", rp.compact_tree("doc").alias("out")).collect()}
    assert got == {1: '{"status":"s","x":[{"y":{"é":1.5,"missing_times_count":1},"assets_count":0},[{}]],"records_count":2}', 2: "[]", 3: None, 4: None, 5: None}


def test_an_index_write_that_stops_leaves_the_earlier_tables(spark, tmp_path):
    small, large = spark.range(3), spark.range(7)
    wr.write_index({"observations": small, "windows": small}, str(tmp_path), "study")
    broken = large.select(F.expr("CASE WHEN id = 5 THEN raise_error('lost') ELSE id END").cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        wr.write_index({"observations": large, "windows": broken}, str(tmp_path), "study")
    assert [wr.read_index(spark, str(tmp_path), "study", t).count() for t in ("observations", "windows")] == [3, 3]
    wr.write_index({"observations": large, "windows": small}, str(tmp_path), "study")
    assert wr.read_index(spark, str(tmp_path), "study", "observations").count() == 7
    with pytest.raises(ValueError):
        wr.read_index(spark, str(tmp_path), "other", "windows")


def test_records_that_carry_their_file_need_no_listing(spark):
    at = datetime(2024, 8, 9, 18)
    lines = [(f"f{lead}", lead, 500, at, at + timedelta(hours=late), f"{i}:{i * 10}:d:REFC:entire atmosphere:{lead} hour fcst:")
             for lead, late in ((3, 1), (4, 3), (5, 9), (7, 1)) for i in range(1 + (lead == 7))]
    df = spark.createDataFrame(lines, "key string, lead int, size long, cycle timestamp_ntz, modified timestamp_ntz, line string")
    records = fi.parse_byte_index(df, carry=["cycle", "lead", "modified"])
    got = fc.same_cycle_pairs(None, records, fi.spec_table(spark, fi.CORE)).collect()
    assert [(r.hour, r.lead, r.key_first, r.key_second) for r in got] == [(at + timedelta(hours=3), 3, "f3", "f4")]
