"""Diagnostics, audits and measurements: flattening, visible versions, calendar rollups, samples."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.functions.labels import series_label
from skyframe.functions.times import SECOND, micros
from skyframe.operators.alignment import first_of
from skyframe.session import written
from skyframe.operators.sequences import islands, with_ordinal

# Counters carried by a diagnostics payload.
COUNTERS = ["pixels", "strict_good", "good_plus_conditional", "valid_zero", "valid_negative", "fill", "no_coverage",
            "bitmap_missing", "nonfinite", "outside_range", "quality_unknown", "ambiguous_shear_zero", "calibration_nonfinite"]
STATISTICS = ["minimum", "maximum", "mean", "std", "q25", "median", "q75"]
PREVIEW_ROWS = 1000


def flatten_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One parse of the payload, then tolerant casts: a malformed field is NULL, an absent counter 0."""
    plain = ",".join(f"{c}:string" for c in [*COUNTERS, "calibration", "packed_dtype"])
    stats = ",".join(f"{s}:string" for s in STATISTICS)
    parsed = F.from_json(payload, f"struct<{plain},strict_stats:struct<{stats}>>")
    # Through a generator the document is parsed once; field by field Spark would parse it again for each.
    rows = df.select("*", F.explode(F.array(parsed)).alias("_p"))
    return rows.select(
        *[c for c in df.columns if c != payload],
        *[F.coalesce(F.col(f"_p.{c}").try_cast("bigint"), F.lit(0)).alias(c) for c in COUNTERS],
        *[F.col(f"_p.strict_stats.{s}").try_cast("double").alias(s) for s in STATISTICS],
        F.col("_p.calibration").alias("calibration"), F.col("_p.packed_dtype").alias("packed_dtype"))


def visible_diagnostics(diagnostics: DataFrame, audits: DataFrame, current: str) -> DataFrame:
    """Per (path, band, time, patch) the row of the current algorithm, else of the highest audit key."""
    facts = audits.select("audit_key", F.col("code_hash").alias("_code"))
    rows = diagnostics.join(facts, "audit_key")
    newest = [(F.col("_code") == current).desc(), F.col("audit_key").desc()]
    return first_of(rows, ["path", "band", "time", "patch"], newest).select(*diagnostics.columns)


def calendar_rollup(flat: DataFrame, unit: str = "month") -> DataFrame:
    """Counts and pixel-weighted moments per product, band, patch and calendar unit."""
    if unit not in ("day", "week", "month", "year"):
        raise ValueError("Choose day, week, month or year")
    n, mean, std = F.col("strict_good"), F.col("mean"), F.col("std")
    sums = flat.groupBy("product", "band", "patch", F.date_trunc(unit, "time").cast("timestamp_ntz").alias("period")).agg(
        F.count(F.lit(1)).alias("observations"), *[F.sum(c).alias(c) for c in COUNTERS],
        F.sum(mean * n).alias("_value"), F.sum((std * std + mean * mean) * n).alias("_square"),
        F.min("minimum").alias("minimum"), F.max("maximum").alias("maximum"))
    weight = F.nullif(F.col("strict_good"), F.lit(0))
    out = sums.withColumn("mean", F.col("_value") / weight)
    spread = F.greatest(F.lit(0.0), F.col("_square") / weight - F.col("mean") * F.col("mean"))
    out = out.withColumn("std", F.when(F.col("mean").isNotNull(), F.sqrt(spread)))
    out = out.withColumns({f"{c}_percent": 100.0 * F.col(c) / F.nullif("pixels", F.lit(0)) for c in COUNTERS[1:]})
    return out.withColumn("series", series_label("product", "band")).drop("_value", "_square")


def count_rollup(flat: DataFrame, unit: str, counters: list[str]) -> DataFrame:
    """Plain counter sums per calendar unit (counts pool, quartiles do not)."""
    return flat.groupBy("product", "band", "patch", F.date_trunc(unit, "time").cast("timestamp_ntz").alias("period")).agg(
        F.count(F.lit(1)).alias("observations"), *[F.sum(c).alias(c) for c in counters])


def metadata_drift(flat: DataFrame, scope: str) -> DataFrame:
    """Distinct calibration encodings and packed types per path, product and band, one scope only."""
    return flat.filter(F.col("patch") == scope).groupBy("path", "product", "band").agg(
        F.count(F.lit(1)).alias("observations"), F.count_distinct("calibration").alias("calibration_encodings"),
        F.count_distinct("packed_dtype").alias("packed_dtypes"))


def preview(flat: DataFrame, order: list[str], rows: int = PREVIEW_ROWS) -> DataFrame:
    """Bounded report preview (top rows by the key columns)."""
    return flat.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(rows)


def storage_representations(archives: DataFrame, columns: list[str]) -> DataFrame:
    """Per product the byte totals of each representation in long form, in GiB."""
    sums = archives.groupBy("product").agg(*[F.sum(c).cast("long").alias(c) for c in columns])
    long = sums.unpivot("product", columns, "representation", "bytes")
    return long.withColumn("gib", F.col("bytes") / 1024**3)


def quality_matrix(rollup: DataFrame, periods: list, scope: str) -> DataFrame:
    """Series by date matrix of the strict-good percentage."""
    return rollup.filter(F.col("patch") == scope).groupBy("series").pivot("period", periods).agg(
        F.first("strict_good_percent", ignorenulls=True))


def patch_quality(rollup: DataFrame) -> DataFrame:
    """Pooled strict-good percentage per series and patch."""
    sums = rollup.groupBy("series", "patch").agg(F.sum("strict_good").alias("strict_good"), F.sum("pixels").alias("pixels"))
    return sums.withColumn("good_percent", 100.0 * F.col("strict_good") / F.nullif("pixels", F.lit(0)))


def audit_scope(audits: DataFrame, visible: DataFrame, inventory: DataFrame, scope: str, full: str) -> DataFrame:
    """Available against audited observations, failed audits, and whether every audit was full."""
    have = inventory.agg(F.coalesce(F.sum("selected_observations"), F.lit(0)).cast("long").alias("available_observations"))
    seen = visible.agg(F.count_if(F.col("patch") == scope).alias("audited_observations"))
    state = audits.agg(
        F.count_if(F.col("status") == "failed").alias("failed_archive_audits"),
        F.coalesce(F.bool_and(F.col("scope") == full), F.lit(False)).alias("_full"))
    label = F.when(F.col("_full"), "full requested audit").otherwise("representative sample / incomplete audit")
    facts = have.unionByName(seen, True).unionByName(state, True)
    one = facts.agg(*[F.max(c).alias(c) for c in facts.columns])
    return one.withColumn("audit_scope", label).drop("_full")


# Fields of a measurement that are kept, fields that mark one as timed, branches that hold more of them.
MEASURES = ["satellite", "repeat", "wall_seconds", "wall_s", "read_bytes", "returned_bytes", "stored_bytes", "write_seconds", "download_seconds",
            "local_decode_crop_seconds", "reader_seconds", "reader_wait_seconds", "source_retries", "peak_rss_bytes"]
TIMED = ["wall_seconds", "wall_s", "write_seconds", "download_seconds"]
BRANCHES = ["rows", "monthly_archives", "monthly_metrics", "evidence"]
MEDIANS = ["wall_seconds", "returned_bytes", "peak_rss_bytes", "download_seconds", "local_decode_crop_seconds"]


def measurement_rows(measurements: DataFrame) -> DataFrame:
    """One row per timed record of a nested measurement, however deep it lies.

    The documents are opened level by level: a text is parsed once, for its record's fields and its branches, whose members
    are the next level's documents, as texts. There are as many rounds as the deepest document has levels, over ever fewer
    rows. A text that is no JSON object has neither.
    """
    own = ["stage:string", "scope:string", "method:string", "product:string", "band:int", "profile:struct<read_mode:string>", *[f"{m}:double" for m in MEASURES]]
    whole = f"struct<{','.join([*own, *[f'{b}:array<string>' for b in BRANCHES]])}>"
    level, found = measurements.select(F.col("kind").alias("_kind"), F.col("payload").alias("n")), []
    while True:
        texts = level.filter(F.col("n").startswith("{"))
        # Through a generator: field by field Spark would parse the document again for each.
        fields = texts.select("_kind", F.col("n").alias("_text"), F.explode(F.array(F.from_json("n", whole))).alias("n"))
        # A field that is there without a number marks a record too; only that takes another look at the text.
        named = F.coalesce(F.arrays_overlap(F.json_object_keys("_text"), F.array(*[F.lit(t) for t in TIMED])), F.lit(False))
        timed = F.when(F.coalesce(*[F.col(f"n.{t}") for t in TIMED]).isNotNull(), F.lit(True)).otherwise(named)
        none = F.array().cast("array<string>")
        held = written(fields.select(
            "_kind", timed.alias("_timed"), F.concat(F.col("_kind"), F.lit(":"), F.coalesce("n.stage", "n.scope", F.lit(""))).alias("scope"),
            F.coalesce("n.method", "n.profile.read_mode").alias("method"), F.col("n.product").alias("product"),
            F.col("n.band").alias("band"), *[F.col(f"n.{m}").alias(m) for m in MEASURES],
            F.flatten(F.array(*[F.coalesce(f"n.{b}", none) for b in BRANCHES])).alias("_below")), "measurements")
        found.append(held.filter("_timed").drop("_kind", "_timed", "_below"))
        if not held.filter(F.size("_below") > 0).limit(1).count():
            break
        children = held.select("_kind", F.explode("_below").alias("c"))
        # A child that carries a summary is represented by it. Only a text with that word, or an escaped one, can have the key.
        may = F.col("c").contains("summary") | F.col("c").contains("\\")
        summed = F.coalesce(F.when(may, F.array_contains(F.json_object_keys("c"), "summary")), F.lit(False))
        level = children.select("_kind", F.when(summed, F.get_json_object("c", "$.summary")).otherwise(F.col("c")).alias("n"))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def benchmark_medians(rows: DataFrame, values: list[str] | None = None) -> DataFrame:
    """Exact medians per (scope, method, satellite, band); NULL group values are groups of their own."""
    keys, values = ["scope", "method", "satellite", "band"], values or MEDIANS
    named = rows.filter(F.col("method").isNotNull())
    # The runs of one benchmark are few: Spark's exact percentile holds a group's distinct values in one buffer.
    return named.groupBy(*keys).agg(*[F.percentile(F.col(v).cast("double"), 0.5).alias(v) for v in values])


def throughput(runs: DataFrame, seconds: str = "wall_seconds", data: str = "source_bytes") -> DataFrame:
    """Megabits per second of each run, NULL without elapsed time."""
    rate = 8.0 * F.coalesce(F.col(data), F.lit(0)) / F.col(seconds) / 1e6
    return runs.withColumn("throughput_mbps", F.when(F.col(seconds) > 0, rate))


def validation_rollup(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean valid percentage per patch, and counts per status."""
    by_patch = rows.groupBy("patch").agg(F.avg("valid_pct").alias("valid_pct"))
    by_status = rows.groupBy("status").agg(F.count(F.lit(1)).alias("observations"))
    return by_patch, by_status


def longest_outage(frames: DataFrame, keys: list[str], order: list[str], valid: str = "valid_pixels") -> DataFrame:
    """Longest run of consecutive frames without a valid pixel."""
    runs = islands(frames, keys, order, F.col(valid) > 0)
    sizes = runs.groupBy(*keys, "island").agg(F.count_if(F.col(valid) == 0).alias("_n"))
    return sizes.groupBy(*keys).agg(F.max("_n").alias("longest_invalid_frames"))


def even_sample(rows: DataFrame, keys: list[str], order: list[str], count: int) -> DataFrame:
    """Evenly spaced rows per key (position ``floor(i (n-1) / (k-1))``), all of them when there are few."""
    placed = with_ordinal(rows, keys, order, "_pos")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    both = placed.join(sizes, keys)
    picks = F.least(F.lit(count), F.col("_n"))
    at = F.transform(F.sequence(F.lit(0), F.lit(count - 1)),
                     lambda i: F.when(picks == 1, F.lit(0)).when(i < picks, F.floor(i * (F.col("_n") - 1) / (picks - 1))))
    return both.filter(F.array_contains(F.array_compact(at), F.col("_pos"))).select(*rows.columns)


def quarter_sample(rows: DataFrame, keys: list[str], time: str = "time", ident: str = "asset_id") -> DataFrame:
    """Per key and represented quarter the first observation and the one nearest noon of that first day."""
    us = micros(time)
    tagged = rows.withColumn("_us", us).withColumn("_quarter", F.date_trunc("quarter", time))
    group = [*keys, "_quarter"]
    first = tagged.groupBy(*group).agg(F.min(F.struct("_us", ident)).alias("_first"))
    noon = F.col("_first._us") - F.pmod(F.col("_first._us"), F.lit(86400 * SECOND)) + 43200 * SECOND
    both = tagged.join(first.withColumn("_noon", noon), group)
    near = both.groupBy(*group).agg(
        F.min(F.struct(F.abs(F.col("_us") - F.col("_noon")).alias("gap"), F.col("_us"), F.col(ident))).alias("_near"))
    picked = first.join(near, group).select(*group, F.explode(F.array_distinct(F.array(
        F.col(f"_first.{ident}"), F.col(f"_near.{ident}")))).alias(ident))
    return tagged.join(picked, [*group, ident], "left_semi").select(*rows.columns)


def representative_scans(rows: DataFrame, start_us: int, end_us: int, band: str = "band", time: str = "time", key: str = "key") -> DataFrame:
    """Scans nearest midnight and noon of the first, middle and last day, per band."""
    day = 86400 * SECOND
    first = start_us - start_us % day
    days = ((end_us - 1) - (end_us - 1) % day - first) // day + 1
    chosen = sorted({0, days // 2, days - 1})
    dated = rows.withColumn("_us", micros(time)).withColumn("_day", F.floor((F.col("_us") - first) / day).cast("long"))
    dated = dated.filter(F.col("_day").isin(chosen))
    marks = dated.withColumn("_hour", F.explode(F.array(F.lit(0), F.lit(12))))
    target = F.lit(first) + F.col("_day") * day + F.col("_hour") * (3600 * SECOND)
    order = [F.abs(F.col("_us") - target), F.col("_us"), F.col(key)]
    best = first_of(marks, ["_day", "_hour", band], order)
    return best.select(*rows.columns).dropDuplicates([key])


def temporal_blocks(slots: DataFrame, origin_us: int, width: int, halo: int = 5, slot: str = "slot_time",
                    step_us: int = 600 * SECOND) -> DataFrame:
    """Every slot in its block, and the last ``halo`` slots of a block again as history of the next."""
    at = ((micros(slot) - origin_us) / step_us).cast("long")
    home = F.floor(F.col("_i") / width).cast("long")
    rows = slots.withColumn("_i", at).withColumn("_home", home)
    owns = F.struct(F.col("_home").alias("block"), F.lit(False).alias("is_halo"))
    lends = F.when(F.col("_i") >= (F.col("_home") + 1) * width - halo,
                   F.struct((F.col("_home") + 1).alias("block"), F.lit(True).alias("is_halo")))
    return rows.withColumn("_b", F.explode(F.array_compact(F.array(owns, lends)))).select(
        *slots.columns, "_b.block", "_b.is_halo")


# Lists that a run summary replaces by their lengths, and all fields that it leaves out.
COUNTED = ["records", "assets", "features", "missing_times"]
OMITTED = {"records", "assets", "features", "hourly_matches", "expected_times", "shifted_matches", "missing_times", "source_metadata_json", "asset_ids"}


def _without_inventories(pairs):
    """One parsed JSON object; the objects inside it have come through here before."""
    fields = dict(pairs)
    counts = {f"{name}_count": len(fields[name]) for name in COUNTED if isinstance(fields.get(name), list)}
    return {name: value for name, value in fields.items() if name not in OMITTED} | counts


def compact_tree(payload: Column | str) -> Column:
    """C11 for documents of any shape and depth: at every level the omitted fields go and counted lists leave their
    length; all other fields stay as they are. NULL and text that is not JSON give NULL. No fixed schema can say this, so
    it is one pass of the JSON parser over Arrow batches."""

    @F.pandas_udf("string")
    def shorten(texts: pd.Series) -> pd.Series:
        def one(text):
            try:
                return None if text is None else json.dumps(json.loads(text, object_pairs_hook=_without_inventories), separators=(",", ":"), ensure_ascii=False)
            except (ValueError, RecursionError):
                return None

        return texts.map(one)

    return shorten(payload)


def compact_payload(payload: str, kept: str, nested: str | None = None):
    """C11: a run summary without its object lists: the kept fields (a DDL list), the length of every counted
    list, and the same for the entries of one nested list."""
    plain = [part.split(":")[0].strip() for part in kept.split(",")]
    lists = ",".join(f"{c}:array<string>" for c in COUNTED)
    node = f"struct<{kept},{lists}>"
    whole = f"struct<{kept},{lists},{nested}:array<{node}>>" if nested else node

    def shorten(value, extra=()):
        fields = [value[name].alias(name) for name in plain]
        fields += [F.when(value[c].isNotNull(), F.size(value[c])).alias(f"{c}_count") for c in COUNTED]
        return F.struct(*fields, *extra)

    parsed = F.from_json(payload, whole)
    extra = [F.transform(parsed[nested], lambda v: shorten(v)).alias(nested)] if nested else []
    return F.to_json(shorten(parsed, extra))
