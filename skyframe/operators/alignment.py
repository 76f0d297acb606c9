"""Time matching of irregular observations: slots, as-of lookups, decimation, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.functions.checks import guard
from skyframe.functions.identity import hash_number
from skyframe.functions.times import HOUR, MINUTE, SECOND, ceil_to, instant, literal_micros, micros
from skyframe.operators.sequences import asof_latest, asof_nearest, join_on, with_previous

# The two source families and how old a matched observation may be, in seconds.
SATELLITE_TOLERANCE = 600
RADAR_TOLERANCE = 300
SLOT_MINUTES = 10
HISTORY_HALO_MINUTES = 50


def first_of(df: DataFrame, keys: list[str], order: list[Column], keep: int = 1, rank: str = "_rank") -> DataFrame:
    """First ``keep`` rows per key. Spark limits every map task to ``keep`` rows per key before the
    shuffle (window group limit), so a hot key moves only a few rows."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(rank) <= keep)


def causal_align(obs: DataFrame, start: str, end: str, variable: str = "variable", time: str = "time",
                 end_time: str = "end_time", asset_id: str = "asset_id", tolerance_s: str = "tolerance_s",
                 step_minutes: int = SLOT_MINUTES, halo_minutes: int = HISTORY_HALO_MINUTES) -> DataFrame:
    """Per slot and variable the latest finished observation, never from the future, never twice.

    An observation ending in ``(slot - step, slot]`` can only serve that slot, except one that ends
    exactly on the previous slot while the tolerance equals the step. That leaves a closed form over
    per-bucket ranks, so neither slots nor observations are visited in sequence.
    """
    step = step_minutes * MINUTE
    first = -(-(literal_micros(start) - halo_minutes * MINUTE) // step) * step
    last = literal_micros(end)
    rows = guard(obs, F.col(tolerance_s) * SECOND <= step, "The tolerance may not exceed the slot step")
    rows = rows.withColumn("_end", micros(end_time)).withColumn("_bucket", ceil_to("_end", step))
    rows = rows.filter(F.col("_bucket").between(first - step, last - 1))
    newest = [F.col("_end").desc(), F.col(time).desc(), F.col(asset_id).desc()]
    top = first_of(rows, [variable, "_bucket"], newest, keep=2)
    age = F.col("_bucket") - F.col("_end")
    own = top.filter((F.col("_rank") == 1) & (age <= F.col(tolerance_s) * SECOND) & (F.col("_bucket") >= first))
    own = own.withColumn("_slot", F.col("_bucket")).withColumn("_carried", F.lit(0))
    # The bucket's owner is used up by its own slot, unless that slot lies before the requested range.
    spare = F.when(F.col("_bucket") < first, 1).otherwise(2)
    late = top.filter((age == 0) & (F.col(tolerance_s) * SECOND == step) & (F.col("_rank") == spare))
    late = late.withColumn("_slot", F.col("_bucket") + step).withColumn("_carried", F.lit(1))
    candidates = own.unionByName(late).filter(F.col("_slot") < last)
    chosen = first_of(candidates, [variable, "_slot"], [F.col("_carried")], rank="_choice")
    return chosen.select(
        *obs.columns, instant("_slot").alias("slot_time"),
        ((micros(time) - F.col("_slot")) / SECOND).alias("offset_seconds"))


def match_previous(assets: DataFrame, start: str, end: str, cadence_minutes: int, tolerance_minutes: float,
                   keys: list[str], time: str = "time", key: str = "key", exact: bool = False) -> DataFrame:
    """Per slot the nearest source at or before it (or exactly on it)."""
    step, tolerance = _match_limits(cadence_minutes, 0 if exact else tolerance_minutes)
    rows = assets.withColumn("_us", micros(time)).withColumn("_slot", ceil_to("_us", step))
    rows = rows.filter((F.col("_slot") - F.col("_us") <= tolerance)
                       & F.col("_slot").between(literal_micros(start), literal_micros(end) - 1))
    best = first_of(rows, [*keys, "_slot"], [F.col("_us").desc(), F.col(key)])
    return _matched(best, assets)


def match_nearest(assets: DataFrame, start: str, end: str, cadence_minutes: int, tolerance_minutes: float,
                  keys: list[str], time: str = "time", key: str = "key") -> DataFrame:
    """Per slot the nearest source, the past one on a tie, none used twice; slots taken in order.

    Only a source exactly half-way between two slots can serve either. Whether a slot spends one of
    its right-hand half-way sources depends on at most the slot before it, and only when it has no
    nearer source and exactly one left-hand one: then the answer is copied from the slot before.
    So the chain is "last slot with a definite answer", one ordered scan over slots.
    """
    step, tolerance = _match_limits(cadence_minutes, tolerance_minutes)
    first, last = literal_micros(start), literal_micros(end)
    rows = assets.withColumn("_us", micros(time))
    rows = rows.withColumn("_slot", F.col("_us") + step // 2 - F.pmod(F.col("_us") + step // 2, F.lit(step)))
    rows = rows.withColumn("_gap", F.abs(F.col("_us") - F.col("_slot")))
    inner = rows.filter((F.col("_gap") <= tolerance) & (F.col("_gap") < step // 2))
    inner = inner.filter(F.col("_slot").between(first, last - 1))
    best = first_of(inner, [*keys, "_slot"], [F.col("_gap"), F.col("_us") > F.col("_slot"), F.col(key)])
    if tolerance < step / 2:
        return _matched(best, assets)

    record = F.struct(*[F.col(c) for c in assets.columns], F.col("_us"))
    middle = first_of(rows.filter(F.col("_gap") * 2 == step), [*keys, "_slot"], [F.col(key)], keep=2)
    middle = middle.select(*keys, "_slot", F.col("_rank").alias("_n"), record.alias("_row"))
    as_left = middle.select(*keys, "_slot", F.when(F.col("_n") == 1, F.col("_row")).alias("l1"),
                            F.when(F.col("_n") == 2, F.col("_row")).alias("l2"))
    as_right = middle.filter("_n = 1").select(
        *keys, (F.col("_slot") - step).alias("_slot"), F.col("_row").alias("r1"))
    own = best.select(*keys, "_slot", record.alias("own"))
    slots = own.unionByName(as_left, True).unionByName(as_right, True)
    slots = slots.filter(F.col("_slot").between(first, last - 1)).groupBy(*keys, "_slot").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("own", "l1", "l2", "r1")])
    has = {c: F.col(c).isNotNull() for c in ("own", "l1", "l2", "r1")}
    definite = (
        F.when(has["own"] | has["l2"] | ~has["r1"], 0)
        .when(~has["l1"], 1)
        .when(F.col("_slot") == first, 0)
    )
    # One row per slot and key: the calendar bounds this window, however many sources there are. A slot
    # with a left-hand source always has the slot before it in the table.
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("_definite", definite)
    slots = slots.withColumn("_spent", F.coalesce(F.last("_definite", ignorenulls=True).over(before), F.lit(0)))
    taken = F.when(F.col("_slot") == first, 0).otherwise(F.col("_spent"))
    left = F.when(taken == 0, F.col("l1")).otherwise(F.col("l2"))
    pick = F.coalesce(F.col("own"), left, F.col("r1"))
    picked = slots.withColumn("_pick", pick).filter("_pick is not null").select("_slot", "_pick.*")
    return _matched(picked, assets)


def _match_limits(cadence_minutes: int, tolerance_minutes: float) -> tuple[int, int]:
    if cadence_minutes < 1 or not 0 <= tolerance_minutes <= cadence_minutes / 2:
        raise ValueError("The tolerance must lie between zero and half the cadence")
    return cadence_minutes * MINUTE, int(tolerance_minutes * MINUTE)


def _matched(rows: DataFrame, assets: DataFrame) -> DataFrame:
    return rows.select(*assets.columns, instant("_slot").alias("slot_time"),
                       ((F.col("_us") - F.col("_slot")) / SECOND).alias("offset_seconds"))


def latest_at(requests: DataFrame, obs: DataFrame, keys: list[str], tolerance_minutes: float,
              at: str = "time", obs_time: str = "time", ties: list[str] | None = None,
              payload: list[str] | None = None, strict: bool = False) -> DataFrame:
    """Per request the latest observation at or before it within the tolerance; reuse allowed.

    ``strict`` fails the job on a request without an observation.
    """
    left = requests.withColumn("_want", micros(at))
    right = obs.withColumn("_have", micros(obs_time))
    out = asof_latest(left, right, keys, "_want", "_have", ties or [], payload or obs.columns,
                      tolerance_us=int(tolerance_minutes * MINUTE)).drop("_want")
    if strict:
        out = guard(out, F.col("hit").isNotNull(), "No observation for a requested time")
    return out


def decimate(assets: DataFrame, count: int, keys: list[str], time: str = "time", key: str = "key") -> DataFrame:
    """At most ``count`` scans per hour and key, nearest to evenly spaced marks, none reused.

    A mark loses at most ``count - 1`` candidates to earlier marks, so its ``count`` nearest are
    enough. Only those (``count`` squared rows at most) are folded per hour.
    """
    if count < 1:
        raise ValueError("Ask for at least one scan per hour")
    rows = assets.withColumn("_us", micros(time))
    rows = rows.withColumn("_hour", F.col("_us") - F.pmod("_us", F.lit(HOUR)))
    marks = F.array(*[F.lit(HOUR * i // count) for i in range(count)])
    spread = rows.select(*keys, "_hour", "_us", F.col(key).alias("_key"), F.posexplode(marks).alias("_mark", "_offset"))
    spread = spread.withColumn("_gap", F.abs(F.col("_us") - F.col("_hour") - F.col("_offset")))
    near = first_of(spread, [*keys, "_hour", "_mark"], [F.col("_gap"), F.col("_us"), F.col("_key")], keep=count)
    if count == 1:
        picked = near.select(*keys, "_us", "_key")
    else:
        bags = near.groupBy(*keys, "_hour").agg(F.sort_array(F.collect_list(
            F.struct("_mark", "_gap", "_us", "_key"))).alias("_bag"))
        key_type = assets.schema[key].dataType.simpleString()
        empty = F.expr(f"cast(array() as array<struct<_us:bigint,_key:{key_type}>>)")

        def take(done, mark):
            free = F.filter("_bag", lambda c: (c["_mark"] == mark) & ~F.exists(
                done, lambda d: (d["_us"] == c["_us"]) & (d["_key"] == c["_key"])))
            chosen = F.transform(F.slice(free, 1, 1), lambda c: F.struct(c["_us"].alias("_us"), c["_key"].alias("_key")))
            return F.concat(done, chosen)

        folded = bags.withColumn("_picked", F.aggregate(F.sequence(F.lit(0), F.lit(count - 1)), empty, take))
        picked = folded.select(*keys, F.explode("_picked").alias("_p")).select(*keys, "_p.*")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    condition = (F.col("a._us") == F.col("p._us")) & (F.col(f"a.{key}") == F.col("p._key"))
    for part in same:
        condition = condition & part
    return rows.alias("a").join(picked.alias("p"), condition, "left_semi").select(*assets.columns)


def height_match(records: DataFrame, heights: DataFrame, satellite: str = "satellite", end_time: str = "end_time",
                 height_end: str = "end_time", height_id: str = "height_id", max_minutes: int = 20) -> DataFrame:
    """Per record the latest height product of the same satellite that had ended, at most 20 min old."""
    left = records.withColumn("_want", micros(end_time))
    right = heights.withColumn("_have", micros(height_end))
    hits = asof_latest(left, right, [satellite], "_want", "_have", [height_id], [height_id],
                       tolerance_us=max_minutes * MINUTE)
    return hits.select(*records.columns, F.col(f"hit.{height_id}").alias(height_id),
                       ((F.col("_want") - F.col("hit._us")) / SECOND).alias("height_age_seconds"))


def nearest_peers(assets: DataFrame, anchors: DataFrame, peer_keys: list[str], time: str = "time", key: str = "key",
                  anchor_time: str = "anchor_time", limit_seconds: int = 90) -> DataFrame:
    """Per anchor and peer key the nearest asset within the limit (earlier, then smaller key, on a tie).

    ``anchors`` carries one row per (anchor, peer key). One as-of scan over the distinct instants that are asked for
    replaces a range join; anchors meet its hits by equality and are not scanned themselves.
    """
    left = anchors.withColumn("_want", micros(anchor_time))
    right = assets.withColumn("_have", micros(time)).groupBy(*peer_keys, "_have").agg(F.min(key).alias(key))
    hits = asof_nearest(left.select(*peer_keys, "_want").distinct(), right, peer_keys, "_want", "_have", [key], limit_seconds * SECOND)
    out = join_on(left, hits.filter("hit is not null"), [*peer_keys, "_want"], "inner")
    return out.select(*anchors.columns, F.col(f"hit.{key}").alias(key), instant(F.col("hit._us")).alias(time))


def comparable(obs: DataFrame, requested: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Observations exactly on requested times, and the ones left out."""
    return obs.join(requested, on, "left_semi"), obs.join(requested, on, "left_anti")


def observations_at(aligned: DataFrame, requests: DataFrame) -> DataFrame:
    """The aligned observation of every requested slot and variable; fails when one has none."""
    found = requests.select("slot_time", "variable").distinct().join(aligned, ["slot_time", "variable"], "left")
    return guard(found, F.col("asset_id").isNotNull(), "No observation for the slot")


def window_index(aligned: DataFrame, start: str, end: str, variables: int, history: int = 6, targets: int = 0,
                 variable: str = "variable", slot: str = "slot_time", asset_id: str = "asset_id",
                 step_minutes: int = SLOT_MINUTES, spine: DataFrame | None = None) -> DataFrame:
    """For every slot, whether all its history and target frames exist for all variables.

    Each aligned row is sent to the few windows that contain it, so no ordered window is needed.
    The window id is a mergeable digest of its sources.
    """
    step = step_minutes * MINUTE
    first, last = -(-literal_micros(start) // step) * step, literal_micros(end)
    spread = F.sequence(F.col("_us") - targets * step, F.col("_us") + (history - 1) * step, F.lit(step))
    hits = aligned.withColumn("_us", micros(slot)).select(
        F.col(variable).alias("_variable"), F.col(asset_id).alias("_id"), "_us", F.explode(spread).alias("_window"))
    hits = hits.filter(F.col("_window").between(first, last - 1))
    spark = aligned.sparkSession
    clock = spark.range(first, last, step).select(F.col("id").alias("_window"))
    need = (history + targets) * variables
    source = F.concat_ws("/", "_variable", "_us", "_id")
    found = hits.groupBy("_window").agg(
        F.count(F.lit(1)).alias("_found"), F.sum(hash_number(source).cast("decimal(38,0)")).alias("_sources"))
    out = clock.join(found, "_window", "left").withColumn("_found", F.coalesce("_found", F.lit(0)))
    identity = F.substring(F.sha2(F.concat_ws(
        "|", F.col("_window").cast("string"), F.lit(str(history)), F.lit(str(targets)),
        F.coalesce(F.col("_sources").cast("string"), F.lit("none"))), 256), 1, 24)
    return out.select(
        identity.alias("window_id"), instant("_window").alias("time"),
        (F.col("_found") == need).alias("eligible"), (F.lit(need) - F.col("_found")).cast("long").alias("missing_observations"),
        F.lit(history).alias("history"), F.lit(targets).alias("targets"))


def training_windows(aligned: DataFrame, begin: str, end: str, variables: int, history: int = 6) -> DataFrame:
    """Windows that use aligned rows of one split only: six past frames and one target."""
    inside = aligned.filter((F.col("slot_time") >= F.lit(begin).cast("timestamp_ntz"))
                            & (F.col("slot_time") < F.lit(end).cast("timestamp_ntz")))
    return window_index(inside, begin, end, variables, history=history, targets=1)


def newest_version(assets: DataFrame, keys: list[str], key: str = "key") -> tuple[DataFrame, DataFrame]:
    """Keep the newest processing of each scan; second table pairs every discarded key with the kept one."""
    kept = assets.groupBy(*keys).agg(F.max(key).alias("kept_key"))
    joined = assets.join(kept, keys)
    newest = joined.filter(F.col(key) == F.col("kept_key")).drop("kept_key")
    discarded = joined.filter(F.col(key) != F.col("kept_key")).select(
        *keys, F.col(key).alias("discarded_key"), "kept_key")
    return newest, discarded


def change_points(assets: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the preceding row's."""
    rows = with_previous(assets, keys, order, [value], prefix="from_")
    return rows.filter(F.col(f"from_{value}") != F.col(value))


def hybrid_band(wanted: DataFrame, single: DataFrame, multi: DataFrame, keys: list[str], payload: str,
                grid: str = "grid_hash") -> DataFrame:
    """Take the single-band copy where the same scan exists on the same grid, else the multiband one."""
    one = single.select(*keys, F.col(payload).alias("_one"), F.col(grid).alias("_one_grid"))
    many = multi.select(*keys, F.col(payload).alias("_many"), F.col(grid).alias("_many_grid"))
    rows = wanted.join(one, keys, "left").join(many, keys, "left")
    rows = guard(rows, F.col("_one_grid").isNull() | F.col("_many_grid").isNull()
                 | (F.col("_one_grid") == F.col("_many_grid")), "The two sources use different grids")
    origin = F.when(F.col("_one").isNotNull(), "single").when(F.col("_many").isNotNull(), "multiband")
    return rows.select(*keys, F.coalesce("_one", "_many").alias(payload), origin.alias("origin"))
