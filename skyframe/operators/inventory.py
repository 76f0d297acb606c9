"""Archive, task and selection tables: totals, coverage, progress, reconciliation, predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.functions.checks import guard
from skyframe.functions.times import HOUR, SECOND, instant, literal_micros, micros
from skyframe.operators.alignment import first_of
from skyframe.operators.sequences import with_element_ordinal, with_previous

# Fixed value: instant at which the eastern satellite changed from 16 to 19.
EAST_TRANSITION = "2025-04-07T15:00:00Z"


def all_known_sum(column: str) -> Column:
    """Sum that is NULL unless every row of a non-empty group is known."""
    return F.when((F.count(F.lit(1)) > 0) & (F.count(column) == F.count(F.lit(1))), F.sum(column).cast("long"))


def storage_totals(archives: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Totals with all-known source size, the known subsets and coverage shares."""
    n = F.count(F.lit(1))
    known_stored = F.sum(F.when(F.col("source_bytes").isNotNull(), F.col("stored_bytes")))
    part = F.coalesce(F.col("source_size_coverage"), F.when(F.col("source_bytes").isNotNull(), 1.0).otherwise(0.0))
    return archives.groupBy(*(keys or [])).agg(
        n.alias("archives"), F.coalesce(F.sum("observations"), F.lit(0)).cast("long").alias("observations"),
        F.coalesce(F.sum("stored_bytes"), F.lit(0)).cast("long").alias("stored_bytes"),
        all_known_sum("source_bytes").alias("source_bytes"),
        F.coalesce(F.sum("source_bytes"), F.lit(0)).cast("long").alias("known_source_bytes"),
        F.coalesce(F.sum("known_asset_bytes"), F.lit(0)).cast("long").alias("known_asset_source_bytes"),
        F.coalesce(known_stored, F.lit(0)).cast("long").alias("known_stored_bytes"),
        F.coalesce(F.count("source_bytes") / F.nullif(n, F.lit(0)), F.lit(0.0)).alias("source_coverage"),
        F.coalesce(F.avg(part), F.lit(0.0)).alias("listed_asset_size_coverage"))


def archive_source_sizes(assets: DataFrame, key: str = "path") -> DataFrame:
    """Source size of each archive from its assets: whole only when every asset is known."""
    return assets.groupBy(key).agg(
        all_known_sum("source_bytes").alias("source_bytes"), F.sum("source_bytes").cast("long").alias("known_asset_bytes"),
        (F.count("source_bytes") / F.count(F.lit(1))).alias("source_size_coverage"))


def size_rollup(archives: DataFrame) -> DataFrame:
    """A10: product, product-year and product-month sizes in one pass; ``known`` needs every row known."""
    rolled = archives.rollup("product", "year", "month").agg(
        F.grouping_id().alias("_level"), F.sum("stored_bytes").cast("long").alias("stored_bytes"),
        all_known_sum("source_bytes").alias("source_bytes"), F.bool_and(F.col("source_bytes").isNotNull()).alias("known"))
    level = F.when(F.col("_level") == 0, "month").when(F.col("_level") == 1, "year").when(F.col("_level") == 3, "product").otherwise("all")
    return rolled.withColumn("level", level).drop("_level")


def inventory_totals(archives: DataFrame, assets: DataFrame) -> DataFrame:
    """Unique source objects by identity, unknown sizes, and listed, physical and logical bytes."""
    objects = assets.groupBy("bucket", "key", "etag").agg(F.max("source_bytes").alias("_size"))
    by_object = objects.agg(
        F.count(F.lit(1)).alias("source_objects"), F.count_if(F.col("_size").isNull()).alias("unknown_objects"),
        F.sum("_size").cast("long").alias("listed_bytes"))
    by_archive = archives.agg(
        F.count(F.lit(1)).alias("archives"), F.sum("stored_bytes").cast("long").alias("physical_bytes"),
        F.sum("logical_bytes").cast("long").alias("logical_bytes"), F.sum("observations").cast("long").alias("observations"))
    both = by_object.unionByName(by_archive, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def coverage_facts(assets: DataFrame, key: str = "path", gap_seconds: int = 900) -> DataFrame:
    """Per archive observations, duplicate times, ends, long gaps, nonpositive scans."""
    rows = assets.select(key, "time", "end_time", "asset_id", micros("time").alias("_us"))
    rows = with_previous(rows, [key], ["_us", "asset_id"], ["_us"], prefix="_prev")
    gap = F.col("_us") - F.col("_prev_us") > gap_seconds * SECOND
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("observations"),
        (F.count(F.lit(1)) - F.count_distinct("_us")).alias("duplicate_times"),
        F.min("time").alias("first_time"), F.max("time").alias("last_time"),
        F.count_if(gap).alias("long_gaps"), F.count_if(micros("end_time") <= F.col("_us")).alias("nonpositive_scans"))


def mode_histogram(assets: DataFrame, keys: list[str], mode: str = "mode") -> DataFrame:
    """Scan-mode counts in long form."""
    return assets.filter(F.col(mode).isNotNull()).groupBy(*keys, mode).agg(F.count(F.lit(1)).alias("scans"))


def progress_states(selected: DataFrame, archived: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Per (product, satellite, month, band) how many objects are archived, corrupt, checkpointed or
    pending. Archived beats checkpointed; a checkpoint counts only its verified prefix."""
    # All that is told of an asset goes through one shuffle, by the asset alone, so that checkpoints without a product meet
    # its products there; an asset's products are few.
    sound = F.col("next_index").between(0, F.size("asset_ids"))
    prefix = checkpoints.filter(sound).select(
        F.lit(2).alias("_told"), "product", "stamp", F.explode(F.slice("asset_ids", F.lit(1), F.col("next_index"))).alias("asset_id"))
    places = ["satellite", "month", "band"]
    told = selected.select(F.lit(0).alias("_told"), "product", "asset_id", *places).unionByName(
        archived.select(F.lit(1).alias("_told"), "product", "asset_id", *places, F.struct("path", "status").alias("_archived")), True).unionByName(prefix, True)
    which = F.col("_told")
    objects = told.repartition("asset_id").groupBy("asset_id", "product").agg(
        *[F.coalesce(F.max(F.when(which == 0, F.col(c))), F.max(F.when(which == 1, F.col(c)))).alias(c) for c in places],
        F.max("_archived")["status"].alias("_archived"), F.max(F.when(which == 1, 1)).alias("_is"), F.min("_told").alias("_first"), F.max("stamp").alias("_stamp"))
    own, loose = F.when(F.col("product").isNotNull(), F.col("_stamp")), F.when(F.col("product").isNull(), F.col("_stamp"))
    rows = objects.withColumn("_own", own).withColumn("_loose", F.max(loose).over(Window.partitionBy("asset_id"))).filter("_first < 2")
    state = (F.when(F.col("_archived") == "corrupt_source", "corrupt_source").when(F.col("_is") == 1, "archived")
             .when(F.coalesce("_own", "_loose").isNotNull(), "checkpointed").otherwise("pending"))
    rows = rows.withColumn("state", state)
    out = rows.groupBy("product", "satellite", "month", "band").agg(
        F.count(F.lit(1)).alias("selected_objects"),
        *[F.count_if(F.col("state") == s).alias(f"{s}_objects") for s in ("archived", "corrupt_source", "checkpointed", "pending")],
        F.max(F.when(F.col("state") == "checkpointed", F.coalesce("_own", "_loose"))).alias("last_checkpoint"))
    done = F.col("selected_objects") - F.col("pending_objects")
    label = (F.when((F.col("pending_objects") == 0) & (F.col("checkpointed_objects") == 0), "complete")
             .when(F.col("checkpointed_objects") > 0, "in_progress").otherwise("pending"))
    return out.withColumns({"accounted_pct": F.round(100.0 * done / F.col("selected_objects"), 2), "state": label})


def acquisition_coverage(assets: DataFrame, start: str, end: str, regional: bool = False, bands: int = 1,
                         time: str = "time", mode: str = "mode") -> DataFrame:
    """Observed against expected files per hour, hours without files included."""
    first = literal_micros(start) // HOUR * HOUR
    spine = assets.sparkSession.range(first, literal_micros(end), HOUR).select(F.col("id").alias("_hour"))
    seen = assets.groupBy((micros(time) - F.pmod(micros(time), F.lit(HOUR))).alias("_hour")).agg(
        F.count(F.lit(1)).alias("_n"), F.sort_array(F.collect_set(mode)).alias("_modes"))
    rows = spine.join(seen, "_hour", "left")
    only = F.when(F.size("_modes") == 1, F.col("_modes")[0])
    per_band = F.lit(12) if regional else F.when(only == "6", 6).when(only == "3", 4)
    expected = per_band * bands
    return rows.select(
        instant("_hour").alias("hour"), F.coalesce("_n", F.lit(0)).alias("observed_files"),
        F.coalesce(F.array_join("_modes", ","), F.lit("")).alias("scan_modes"), expected.cast("long").alias("expected_files"),
        F.when(per_band.isNull(), "not inferred for absent, mixed or unsupported scan modes").otherwise("").alias("note"))


def selection_summary(assets: DataFrame, expected: DataFrame, matches: DataFrame) -> DataFrame:
    """Files, megabytes, expected and missing slots, shifted matches."""
    files = assets.agg(F.count(F.lit(1)).alias("files"), (F.sum("size") / 1e6).alias("source_mb"))
    slots = expected.join(matches.select("slot_time").distinct().withColumn("_hit", F.lit(1)), "slot_time", "left").agg(
        F.count(F.lit(1)).alias("expected_slots"), F.count_if(F.col("_hit").isNull()).alias("missing_slots"))
    shifted = matches.agg(F.count_if(F.col("offset_seconds") != 0).alias("shifted_matches"))
    facts = files.unionByName(slots, True).unionByName(shifted, True)
    return facts.agg(*[F.max(c).alias(c) for c in facts.columns])


def task_progress_table(tasks: DataFrame, pattern: str = "%raw.zarr.zip") -> DataFrame:
    """Accounted and verified counts of every raw archive's task with a NULL-safe percentage, its start and its last
    update, by month, product, band and task."""
    done = F.greatest("checkpointed", "completed")
    started = F.get_json_object("metrics_json", "$.attempt_started_at").try_cast("double")

    def stamp(seconds):
        return F.timestamp_micros((seconds * SECOND).cast("long")).cast("timestamp_ntz")

    return tasks.filter(F.col("task_id").like(pattern)).select(
        "source", "product", "month", "band", "selected", done.alias("accounted"), F.col("completed").alias("verified"),
        F.round(100.0 * done / F.nullif("selected", F.lit(0)), 1).alias("percent"), "status",
        stamp(started).alias("started_utc"), stamp(F.col("updated_at")).alias("updated_utc"), F.col("task_id").alias("archive")).orderBy("month", "product", "band", "archive")


def archive_accounting(members: DataFrame, key: str = "path") -> DataFrame:
    """Logical bytes by role (array shape times item size), stored payload, its metadata part, overhead.

    members: one row per container member: name, shape, itemsize, is_metadata, stored, archive_bytes.
    """
    logical = F.aggregate("shape", F.lit(1).cast("long"), lambda a, x: a * x) * F.col("itemsize")
    name = F.col("name")
    role = (F.when(name.startswith("DQF") | (name == "bitmap_valid"), "quality")
            .when(name.startswith("CMI") | (name == "measurement"), "measurement")
            .when(name.isin("time", "latitude", "longitude", "x", "y"), "coordinate"))
    rows = members.withColumns({"_logical": F.when(~F.col("is_metadata"), logical), "_role": role})

    def total(which):
        return F.coalesce(F.sum(F.when(F.col("_role") == which, F.col("_logical"))), F.lit(0)).cast("long")

    out = rows.groupBy(key).agg(
        total("measurement").alias("logical_measurement_bytes"), total("quality").alias("logical_quality_bytes"),
        total("coordinate").alias("logical_coordinate_bytes"), F.sum("stored").cast("long").alias("member_bytes"),
        F.coalesce(F.sum(F.when(F.col("is_metadata"), F.col("stored"))), F.lit(0)).cast("long").alias("metadata_bytes"),
        F.max("archive_bytes").alias("_whole"))
    return out.withColumn("container_overhead_bytes", F.col("_whole") - F.col("member_bytes")).drop("_whole")


def member_source_bytes(members: DataFrame, catalog: DataFrame, manifest: DataFrame, checkpoints: DataFrame, key: str = "path") -> DataFrame:
    """Source size of a member: catalog sizes when all its ids are known, else its manifest's when all
    known, else the month checkpoint's total, else NULL.

    members: the key, month, asset_ids, any others that stay; catalog: asset_id, size; manifest: the key, source_bytes per
    asset; checkpoints: month, listed_bytes. A short key keeps the shuffles small.
    """
    ids = members.select(key, F.explode("asset_ids").alias("asset_id")).join(
        catalog.groupBy("asset_id").agg(F.max("size").alias("size")), "asset_id", "left")
    by_catalog = ids.groupBy(key).agg(all_known_sum("size").alias("_catalog"))
    by_manifest = manifest.groupBy(key).agg(all_known_sum("source_bytes").alias("_manifest"))
    rows = members.join(by_catalog, key, "left").join(by_manifest, key, "left").join(
        checkpoints.select("month", F.col("listed_bytes").alias("_listed")), "month", "left")
    return rows.select(*[c for c in members.columns if c != "asset_ids"], F.coalesce("_catalog", "_manifest", "_listed").alias("source_bytes"))


def merge_new_rows(prior: DataFrame, listed: DataFrame, issues: DataFrame, key: str = "asset_id") -> DataFrame:
    """Prior rows plus listed ones not yet there, without quarantined assets; an archived asset that is
    quarantined fails the job."""
    flagged = issues.select(key).distinct().withColumn("_bad", F.lit(1))
    old = prior.join(flagged, key, "left")
    old = guard(old, F.col("_bad").isNull(), "A quarantined source is already archived").drop("_bad")
    new = listed.join(prior.select(key), key, "left_anti").join(flagged, key, "left_anti")
    return old.withColumn("kind", F.lit("old")).unionByName(new.withColumn("kind", F.lit("new")))


def reconcile(listed: DataFrame, archived: DataFrame, invalid: DataFrame, keys: list[str], ident: str = "asset_id") -> DataFrame:
    """Per period: listed, archived and invalid counts and every kind of disagreement."""
    sides = [df.select(*keys, ident, F.lit(flag).alias("_side")) for df, flag in ((listed, 1), (archived, 2), (invalid, 4))]
    rows = sides[0].unionByName(sides[1]).unionByName(sides[2])
    each = rows.groupBy(*keys, ident).agg(
        F.max((F.col("_side") == 1).cast("int")).alias("l"), F.count_if(F.col("_side") == 2).alias("a"),
        F.max((F.col("_side") == 4).cast("int")).alias("i"))
    out = each.groupBy(*keys).agg(
        F.sum("l").alias("listed"), F.count_if(F.col("a") > 0).alias("archived"), F.sum("i").cast("long").alias("invalid"),
        F.count_if((F.col("l") == 1) & (F.col("a") == 0) & (F.col("i") == 0)).alias("not_archived"),
        F.count_if((F.col("a") > 0) & (F.col("l") == 0)).alias("not_listed"),
        F.count_if((F.col("a") > 0) & (F.col("i") == 1)).alias("archived_but_invalid"),
        F.count_if(F.col("a") > 1).alias("archived_twice"))
    bad = F.col("not_archived") + F.col("not_listed") + F.col("archived_but_invalid") + F.col("archived_twice")
    return out.withColumns({"listed": F.col("listed").cast("long"), "consistent": bad == 0})


def band_account(present: DataFrame, missing: DataFrame, keys: list[str], bands: list[int]) -> DataFrame:
    """Present and declared-missing bands must be disjoint and together complete."""
    rows = present.select(*keys, F.col("band"), F.lit(1).alias("_p"), F.lit(0).alias("_m")).unionByName(
        missing.select(*keys, F.col("band"), F.lit(0).alias("_p"), F.lit(1).alias("_m")))
    each = rows.filter(F.col("band").isin(bands)).groupBy(*keys, "band").agg(F.max("_p").alias("_p"), F.max("_m").alias("_m"))
    return each.groupBy(*keys).agg(
        F.sum("_p").cast("long").alias("present"), F.sum("_m").cast("long").alias("missing"),
        (F.bool_and(F.col("_p") + F.col("_m") == 1) & (F.count(F.lit(1)) == len(bands))).alias("accounted"))


def zero_byte_identity(records: DataFrame) -> DataFrame:
    """A zero-byte source must carry the empty object's etag; returns the ones that do not."""
    # Fixed value: MD5 of no bytes.
    return records.filter((F.col("size") == 0) & (F.col("etag") != "d41d8cd98f00b204e9800998ecf8427e"))


def spine_completeness(tasks: DataFrame, first_month: str, last_month: str, bands: list[int]) -> DataFrame:
    """Every month and band, measured or not."""
    months = F.explode(F.expr(f"sequence(date'{first_month}-01', date'{last_month}-01', interval 1 month)"))
    spine = tasks.sparkSession.range(1).select(months.alias("_m")).select(
        F.date_format("_m", "yyyy-MM").alias("month"), F.explode(F.array(*[F.lit(b) for b in bands])).alias("band"))
    measured = tasks.groupBy("month", "band").agg(
        F.sum("selected").cast("long").alias("selected"), F.sum(F.greatest("checkpointed", "completed")).cast("long").alias("accounted"),
        F.sum("completed").cast("long").alias("verified"), F.max("updated_at").alias("updated_at"),
        F.bool_and(F.col("status") == "complete").alias("_complete"))
    out = spine.join(measured, ["month", "band"], "left")
    state = (F.when(F.col("selected").isNull(), "not inventoried / not started")
             .when(F.col("_complete"), "verified").otherwise("checkpointed / interrupted"))
    return out.withColumns({"percent": F.round(100.0 * F.col("accounted") / F.nullif("selected", F.lit(0)), 1), "status": state}).drop("_complete")


def match_evidence(evidence: DataFrame, listing: DataFrame, key: str = "asset_id") -> DataFrame:
    """Gap evidence against the current listing; unmatched rows are counted, not dropped."""
    found = evidence.join(listing.select(key).distinct().withColumn("_hit", F.lit(1)), key, "left")
    return found.withColumn("matched", F.col("_hit").isNotNull()).drop("_hit")


def filter_tasks(tasks: DataFrame, start: str | None = None, end: str | None = None, source: str | None = None,
                 product: str | None = None, band: int | None = None) -> DataFrame:
    """tasks whose whole month intersects ``[start, end)``; no month only passes without dates."""
    keep = F.lit(True)
    for name, value in (("source", source), ("product", product), ("band", band)):
        if value is not None:
            keep = keep & (F.col(name) == value)
    if start or end:
        month = F.to_date(F.concat("month", F.lit("-01")))
        begin, stop = month.cast("timestamp_ntz"), F.add_months(month, 1).cast("timestamp_ntz")
        keep = keep & F.col("month").isNotNull()
        if start:
            keep = keep & (stop > F.lit(start).cast("timestamp_ntz"))
        if end:
            keep = keep & (begin < F.lit(end).cast("timestamp_ntz"))
    return tasks.filter(keep)


def prune_period(partitioned: DataFrame, start: str, end: str, date: str = "date") -> DataFrame:
    """date-folder pruning: whole days touched by ``[start, end)``, on the partition column."""
    last = instant(F.lit(literal_micros(end) - 1)).cast("date")
    return partitioned.filter((F.col(date) >= F.lit(start).cast("timestamp_ntz").cast("date")) & (F.col(date) <= last))


def split_empty(assets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """usable assets and zero-byte ones with their reason; a negative size fails."""
    # The check is part of each condition: as a filter of its own it could run behind the other one.
    sound = F.when(F.col("size") < 0, F.raise_error(F.lit("A listed size is negative")).cast("boolean"))
    usable, empty = sound.otherwise(F.col("size") > 0), sound.otherwise(F.col("size") == 0)
    return assets.filter(usable), assets.filter(empty).withColumn("reason", F.lit("zero_byte_noaa_object"))


def confirmed_issues(issues: DataFrame, assets: DataFrame, product: str, region: str) -> DataFrame:
    """confirmed corruption whose evidence equals the asset in every respect; any other fails."""
    facts = assets.select("asset_id", *[F.col(c).alias(f"_{c}") for c in ("source_url", "etag", "size", "time")])
    rows = issues.filter(F.col("status") == "confirmed_corrupt_source").join(facts, "asset_id", "left")
    same = (
        (F.col("source_url") == F.col("_source_url")) & (F.col("etag") == F.col("_etag")) & (F.col("source_bytes") == F.col("_size"))
        & (F.col("time") == F.col("_time")) & (F.col("product") == product) & (F.col("region") == region)
        & (F.col("download_bytes") == F.col("_size")) & (F.col("proof_etag") == F.lower(F.regexp_replace("_etag", '"', ""))))
    return guard(rows, same, "Corrupt-source evidence does not match the selected source").select(*issues.columns)


def east_satellite(time: Column | str) -> Column:
    """the eastern satellite at an instant."""
    return F.when(micros(time) < literal_micros(EAST_TRANSITION), 16).otherwise(19)


def satellite_segments(requests: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """requests cut where the satellite changes, each piece with its satellite."""
    cut = literal_micros(EAST_TRANSITION)
    lo, hi = micros(start), micros(end)
    before = F.when(lo < cut, F.struct(lo.alias("lo"), F.least(hi, F.lit(cut)).alias("hi"), F.lit(16).alias("satellite")))
    after = F.when(hi > cut, F.struct(F.greatest(lo, F.lit(cut)).alias("lo"), hi.alias("hi"), F.lit(19).alias("satellite")))
    rows = requests.withColumn("_s", F.explode(F.array_compact(F.array(before, after))))
    rest = [c for c in requests.columns if c not in (start, end)]
    return rows.select(*rest, instant(F.col("_s.lo")).alias(start), instant(F.col("_s.hi")).alias(end), "_s.satellite")


def partition_problems(parts: DataFrame, start: str = "start", end: str = "end", label: str = "label") -> DataFrame:
    """partitions off a month boundary, with a repeated label, or not joining their predecessor."""
    clock = Window.partitionBy(F.lit(0)).orderBy(start, label)  # a study has a handful of partitions
    rows = parts.withColumn(f"prev_{end}", F.lag(end).over(clock))
    labels = parts.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.join(labels, label)
    whole = (F.date_trunc("month", start).cast("timestamp_ntz") == F.col(start)) & (F.date_trunc("month", end).cast("timestamp_ntz") == F.col(end))
    problem = (F.when(F.col(start) >= F.col(end), "empty").when(~whole, "not on a month boundary")
               .when(F.col("_n") > 1, "repeated label")
               .when(F.col(f"prev_{end}") < F.col(start), "gap").when(F.col(f"prev_{end}") > F.col(start), "overlap"))
    return rows.withColumn("problem", problem).filter("problem is not null").select(*parts.columns, "problem")


def choose_product(requests: DataFrame, archives: DataFrame, single: str, multi: str) -> DataFrame:
    """single-band product when any requested band is already archived that way, else multiband."""
    have = archives.select("satellite", "band").distinct()
    wanted = requests.select("request_id", "satellite", F.explode("bands").alias("band"))
    hit = wanted.join(have, ["satellite", "band"], "left_semi").select("request_id").distinct().withColumn("_hit", F.lit(1))
    return requests.join(hit, "request_id", "left").select(
        *requests.columns, F.when(F.col("_hit") == 1, single).otherwise(multi).alias("product"))


def backup_members(members: DataFrame) -> DataFrame:
    """F16: members of yearly bundles in the columns of the size summary."""
    return members.select(
        "source", "product", "band", F.substring("month", 1, 4).alias("year"), F.substring("month", 6, 2).alias("month"),
        "stored_bytes", "source_bytes", "observations", F.col("member").alias("path"), F.lit("monthly member of a yearly bundle").alias("kind"))


def receipt_problems(requests: DataFrame, receipts: DataFrame, region: str, bands: list[int]) -> DataFrame:
    """Receipts that do not match their request, or declare an empty month without evidence."""
    names = ["product", "start", "end", "region", "bands", "status", "selected_assets", "coverage"]
    rows = requests.select("month", F.col("product").alias("want_product"), F.col("start").alias("want_start"), F.col("end").alias("want_end")).join(
        receipts.select("month", *names), "month", "left")
    same = ((F.col("product") == F.col("want_product")) & (F.col("start") == F.col("want_start")) & (F.col("end") == F.col("want_end"))
            & (F.col("region") == region) & (F.array_sort("bands") == F.array(*[F.lit(b) for b in sorted(bands)])))
    proven = (F.col("selected_assets") == 0) & (F.size("coverage") > 0) & F.forall("coverage", lambda n: n == 0)
    problem = (F.when(F.col("status").isNull(), "no receipt").when(~F.coalesce(same, F.lit(False)), "other request")
               .when(~F.col("status").isin("complete", "unavailable"), "incomplete")
               .when((F.col("status") == "unavailable") & ~F.coalesce(proven, F.lit(False)), "no empty-selection evidence"))
    return rows.withColumn("problem", problem).filter("problem is not null").select("month", "problem")


def latest_run(runs: DataFrame, keys: list[str], order: str = "started_at") -> DataFrame:
    """The latest run of every group; reused attempts are not runs."""
    return first_of(runs.filter("not reused"), keys, [F.col(order).desc(), F.col("run_id").desc()]).drop("_rank")


def ordered_catalog(assets: DataFrame) -> DataFrame:
    """Stable catalog order (time, band with none first, key)."""
    return assets.orderBy("time", F.coalesce("band", F.lit(0)), "key")


def month_owner(matches: DataFrame, source_time: str = "source_time", slot: str = "slot_time") -> DataFrame:
    """A matched slot belongs to the month of its source, an unmatched one to its own month."""
    owner = F.date_format(F.coalesce(source_time, slot), "yyyy-MM")
    return matches.withColumn("owner_month", owner)


def batch_problems(batches: DataFrame, key: str = "unit") -> DataFrame:
    """Units whose verified batches do not run without a gap from 0 to the declared length."""
    rows = with_previous(batches, [key], ["start"], ["stop"])
    broken = F.col("start") != F.coalesce("prev_stop", F.lit(0))
    out = rows.groupBy(key).agg(F.count_if(broken).alias("breaks"), F.max("stop").alias("last_stop"), F.max("length").alias("length"))
    return out.filter((F.col("breaks") > 0) | (F.col("last_stop") != F.col("length")))


def band_sequences(scans: DataFrame, series: list[str], time: str = "time") -> DataFrame:
    """Multiband scans as one sequence per band with a running index; a scan of another grid fails.

    scans: series columns, time, grid_hash, images array of (band, origin, size).
    """
    rows = with_element_ordinal(scans.select(*series, time, "grid_hash", "images"), series, micros(time), "images", "band", "origin", "scan_index",
                                ("grid_hash", "The grid changed between scans"))
    image = [F.col(f"_element.{c}").alias(c) for c in ("band", "origin", "size")]
    return rows.select(*series, time, F.col("_size").alias("available_bands"), *image, "scan_index")


def completion_offsets(attempts: DataFrame, bands: list[int]) -> DataFrame:
    """Seconds from the first writer start to the first finished band and to the first complete month.

    attempts: month, band, started_at, ended_at (seconds).
    """
    known = attempts.filter("started_at is not null and ended_at is not null")
    per = known.groupBy("month", "band").agg(F.max("ended_at").alias("_end"), F.min("started_at").alias("_start"),
                                             F.min("ended_at").alias("_first"))
    whole = F.when((F.count(F.lit(1)) == len(bands)) & F.bool_and(F.col("band").isin(bands)), F.max("_end"))
    months = per.groupBy("month").agg(whole.alias("_done"), F.min("_start").alias("_start"), F.min("_first").alias("_first"))
    return months.agg(
        (F.min("_first") - F.min("_start")).alias("first_band_seconds"),
        (F.min("_done") - F.min("_start")).alias("first_month_seconds"))


def band_tails(attempts: DataFrame, slow_band: int) -> DataFrame:
    """Per month how long the slow band went on after all the others (months with that band and another)."""
    known = attempts.filter("started_at is not null and ended_at is not null")
    per = known.groupBy("month", "band").agg(F.max("ended_at").alias("_end"))
    slow, rest = F.col("band") == slow_band, F.col("band") != slow_band
    out = per.groupBy("month").agg(F.max(F.when(slow, F.col("_end"))).alias("_slow"), F.max(F.when(rest, F.col("_end"))).alias("_rest"))
    return out.filter("_slow is not null and _rest is not null").select(
        "month", F.greatest(F.lit(0.0), F.col("_slow") - F.col("_rest")).alias("tail_seconds"))


