"""Study analytics: forecast verification, frozen samples, radar years, scenarios, size estimates, pilots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframe.functions import decode as dc
from skyframe.functions.checks import guard
from skyframe.functions.times import HOUR, MINUTE, instant, literal_micros, micros
from skyframe.operators.alignment import decimate, first_of
from skyframe.operators.quantiles import exact_quantiles
from skyframe.operators.sequences import join_on

# Scenario name, bands, scans per hour.
EIGHT_BANDS = (1, 2, 3, 7, 8, 9, 10, 13)
SCENARIOS = [("eight_6ph", EIGHT_BANDS, 6), ("eight_3ph", EIGHT_BANDS, 3), ("eight_1ph", EIGHT_BANDS, 1), ("sixteen_6ph", tuple(range(1, 17)), 6)]
# Fixed value: bytes of provenance allowed per stored band file.
PROVENANCE_BYTES = 2048


def join_truth(forecast: DataFrame, truth: DataFrame, initial: DataFrame) -> DataFrame:
    """Forecast, observation and persistence of one pixel side by side, with their joint validity.

    forecast: run, variable, lead, cell, predicted, support, valid_time; truth: run, variable, lead, cell,
    observed, valid, source_end; initial: run, variable, cell, initial. A truth that ends after its valid
    time fails the job. Every forecast pixel stays: without truth or persistence it is not joint.
    """
    rows = forecast.join(truth, ["run", "variable", "lead", "cell"], "left").join(initial, ["run", "variable", "cell"], "left")
    rows = guard(rows, F.col("source_end").isNull() | (F.col("source_end") <= F.col("valid_time")), "Evaluation holds future observations")
    ok = F.col("support") & F.col("valid") & dc.finite("predicted") & dc.finite("observed") & dc.finite("initial")
    return rows.withColumn("joint", F.coalesce(ok, F.lit(False)))


def verify_forecast(joined: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Pixels, valid share, MAE, RMSE, bias, and persistence MAE and RMSE; NULL without pixels."""
    e = F.when(F.col("joint"), F.col("predicted").cast("double") - F.col("observed").cast("double"))
    p = F.when(F.col("joint"), F.col("initial").cast("double") - F.col("observed").cast("double"))
    return joined.groupBy(*(keys or ["variable", "lead"])).agg(
        F.count_if("joint").alias("pixels"), F.avg(F.col("joint").cast("double")).alias("valid_fraction"),
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"),
        F.avg(F.abs(p)).alias("persistence_mae"), F.sqrt(F.avg(p * p)).alias("persistence_rmse"))


def frames_for(frames: DataFrame, targets: DataFrame, offsets: list[int], variables: int, strict: bool = False) -> DataFrame:
    """Frames of each target at the given minute offsets, for targets that have all of them in
    time (every variable at every offset, no source ending after its frame). ``strict`` fails otherwise.

    frames: time, variable, source_end, values, valid; targets: target (and columns to keep).
    """
    need = targets.withColumn("_o", F.explode(F.array(*[F.lit(o) for o in offsets])))
    need = need.withColumn("time", instant(micros("target") + F.col("_o").cast("long") * MINUTE)).drop("_o")
    hits = need.join(frames, "time", "left")
    causal = F.coalesce(F.col("source_end") <= F.col("time"), F.lit(False))
    whole = hits.groupBy("target").agg(
        F.count_distinct(F.when(F.col("variable").isNotNull(), F.struct("time", "variable"))).alias("_n"), F.bool_and(causal).alias("_causal"))
    good = (F.col("_n") == len(offsets) * variables) & F.col("_causal")
    whole = guard(whole, good, "The history is incomplete or not causal") if strict else whole.filter(good)
    return hits.join(whole.select("target"), "target", "left_semi")


def joint_support(picked: DataFrame) -> DataFrame:
    """Per target the share of cells valid in every frame and band, and how many that are."""
    cells = picked.select("target", F.posexplode(F.arrays_zip("values", "valid")).alias("cell", "p"))
    per = cells.groupBy("target", "cell").agg(F.bool_and(F.col("p.valid") & dc.finite(F.col("p.values"))).alias("_ok"))
    return per.groupBy("target").agg(F.count_if("_ok").alias("supported_cells"), F.avg(F.col("_ok").cast("double")).alias("supported_fraction"))


def band_validity(picked: DataFrame) -> DataFrame:
    """Valid share per target and band."""
    good = F.aggregate(F.arrays_zip("values", "valid"), F.lit(0), lambda n, p: n + F.when(p["valid"] & ~F.isnan(p["values"]), 1).otherwise(0))
    return picked.groupBy("target", "variable").agg((F.sum(good) / F.sum(F.size("values"))).alias("valid_fraction"))


def comparison_targets(hours: DataFrame) -> DataFrame:
    """Three targets around each hour."""
    return hours.withColumn("target", F.explode(F.transform(
        F.array(*[F.lit(m * MINUTE) for m in (-10, 0, 10)]), lambda o: instant(micros("hour") + o))))


def radar_month_cells(pixels: DataFrame, quality_product: str = "RadarQualityIndex_00.00", also: list[Column] | None = None) -> DataFrame:
    """A16, one month at a time: per cell the sum and count of valid quality and the count of valid
    reflectivity. Quality outside [0, 1] is not valid and is counted apart by the class totals. ``also`` are further
    aggregates of the same rows."""
    rows = _radar_valid(pixels, quality_product)
    quality = F.col("product") == quality_product
    return rows.groupBy("month", "cell").agg(
        F.coalesce(F.sum(F.when(quality & F.col("_valid"), F.col("raw"))), F.lit(0.0)).alias("rqi_sum"),
        F.count_if(quality & F.col("_valid")).alias("rqi_count"), F.count_if(~quality & F.col("_valid")).alias("reflectivity_count"), *(also or []))


def _radar_valid(pixels: DataFrame, quality_product: str) -> DataFrame:
    rows = dc.with_product(pixels)
    bitmap, finite = F.col("bitmap") == 1, dc.finite("raw")
    missing = bitmap & finite & (F.col("raw") == F.col("missing"))
    uncovered = bitmap & finite & (F.col("raw") == F.col("no_coverage"))
    plain = bitmap & finite & ~missing & ~uncovered
    outside = plain & (F.col("product") == quality_product) & ~F.col("raw").between(0, 1)
    return rows.withColumns({"_gap": ~bitmap, "_nonfinite": bitmap & ~finite, "_missing": missing, "_uncovered": uncovered,
                             "_outside": outside, "_valid": plain & ~outside})


def radar_class_totals(pixels: DataFrame, quality_product: str = "RadarQualityIndex_00.00") -> DataFrame:
    """Pixel class totals per product."""
    rows = _radar_valid(pixels, quality_product)
    return rows.groupBy("product").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("_gap").alias("bitmap_gaps"), F.count_if("_nonfinite").alias("nonfinite"),
        F.count_if("_missing").alias("missing_sentinel"), F.count_if("_uncovered").alias("no_coverage_sentinel"),
        F.count_if("_outside").alias("out_of_range"), F.count_if("_valid").alias("valid"),
        F.count_if(F.col("_valid") & (F.col("raw") == 0)).alias("valid_zero"), F.count_if(F.col("_valid") & (F.col("raw") < 0)).alias("valid_negative"))


def merge_months(months: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Whole-period cell sums from monthly ones, or those of months from their parts."""
    return months.groupBy(*(keys or ["cell"])).agg(*[F.sum(c).alias(c) for c in ("rqi_sum", "rqi_count", "reflectivity_count")])


def radar_year_cells(cells: DataFrame, reflectivity_reads: DataFrame) -> DataFrame:
    """Per cell mean quality (NULL without any) and the share of reads with valid reflectivity."""
    rows = cells.join(F.broadcast(reflectivity_reads.select(F.col("reads").alias("_reads"))), F.col("_reads") >= 0)  # one row
    return rows.select("cell", (F.col("rqi_sum") / F.nullif("rqi_count", F.lit(0))).alias("mean_rqi"),
                       (F.col("reflectivity_count") / F.nullif("_reads", F.lit(0))).alias("availability"))


def radar_year_summary(year: DataFrame) -> DataFrame:
    """Cells, those with any reflectivity in 1 % and 50 % of reads, and the highest share."""
    return year.agg(F.count(F.lit(1)).alias("cells"), F.max("availability").alias("max_availability"),
                    F.count_if(F.col("availability") >= 0.01).alias("cells_1_percent"), F.count_if(F.col("availability") >= 0.5).alias("cells_50_percent"))


def scenario_assets(assets: DataFrame, scenarios=None) -> DataFrame:
    """The files each scenario would keep (its bands, its scans per hour and band)."""
    parts = []
    for name, bands, cadence in scenarios or SCENARIOS:
        inside = assets.filter(F.col("band").isin(*bands))
        parts.append(decimate(inside, cadence, ["band"]).withColumn("scenario", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b), parts)


def scenario_months(kept: DataFrame, start: str, end: str, scenarios=None) -> DataFrame:
    """Per scenario and month files, distinct scan times, bytes, nominal files and the shortfall."""
    spark = kept.sparkSession
    fixed = spark.createDataFrame([(n, len(b) * c) for n, b, c in scenarios or SCENARIOS], "scenario string, per_hour int")
    first, last = literal_micros(start), literal_micros(end)
    hours = spark.range(first - first % HOUR, last, HOUR).select(F.date_format(instant("id"), "yyyy-MM").alias("month"))
    spine = hours.groupBy("month").agg(F.count(F.lit(1)).alias("_hours"))
    sums = kept.groupBy("scenario", F.date_format("time", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("band_files"), F.count_distinct("time").alias("distinct_scan_times"), F.sum("size").cast("long").alias("listed_bytes"))
    out = sums.join(F.broadcast(fixed), "scenario").join(spine, "month")  # four fixed scenarios
    nominal = F.col("_hours") * F.col("per_hour")
    return out.select("scenario", "month", "band_files", "distinct_scan_times", "listed_bytes", nominal.alias("nominal_files"),
                      F.greatest(F.lit(0).cast("long"), nominal - F.col("band_files")).alias("missing_files"))


def scenario_counts(kept: DataFrame) -> DataFrame:
    """Files per scenario, month, satellite and band."""
    return kept.groupBy("scenario", F.date_format("time", "yyyy-MM").alias("month"), "satellite", "band").agg(F.count(F.lit(1)).alias("files"))


def size_estimate(counts: DataFrame, samples: DataFrame, metric: str, allowance: int = 0) -> DataFrame:
    """Per scenario files times the sampled quantile of the metric per satellite and band; NULL as soon
    as one needed group has no sample. ``allowance`` adds bytes per file."""
    levels = exact_quantiles(samples, ["satellite", "band"], F.col(metric), [0.1, 0.5, 0.9], ["_low", "_central", "_high"], bounded=True)
    rows = counts.filter("files > 0").join(levels, ["satellite", "band"], "left")
    known = F.bool_and(F.col("_central").isNotNull())
    out = rows.groupBy("scenario").agg(*[
        F.when(known, F.sum(F.col("files") * (F.col(f"_{q}") + F.lit(allowance)))).alias(q) for q in ("low", "central", "high")])
    return out


def choose_configuration(runs: DataFrame, config: list[str], resources: list[Column], value: str = "seconds",
                         slack: float = 1.05, keys: list[str] | None = None) -> DataFrame:
    """Median per configuration over verified runs; of those within the slack of the fastest the one
    with the least resources; one row per key."""
    keys = keys or []
    medians = exact_quantiles(runs.filter("verified"), [*keys, *config], F.col(value), [0.5], ["median"], bounded=True)
    best = Window.partitionBy(*(keys or [F.lit(0)]))  # configurations, not runs
    near = medians.withColumn("_best", F.min("median").over(best)).filter(F.col("median") <= F.col("_best") * slack).drop("_best")
    return first_of(near, keys or [F.lit(0)], [*resources, F.col("median")]).drop("_rank")


def finalist_configurations(runs: DataFrame, config: list[str], resources: list[Column], value: str = "seconds", keys: list[str] | None = None) -> DataFrame:
    """The preferred configuration and its fastest alternative."""
    keys = keys or []
    preferred = choose_configuration(runs, config, resources, value, keys=keys).withColumn("role", F.lit("preferred"))
    medians = exact_quantiles(runs.filter("verified"), [*keys, *config], F.col(value), [0.5], ["median"], bounded=True)
    others = medians.join(preferred.select(*keys, *config), [*keys, *config], "left_anti")
    runner_up = first_of(others, keys or [F.lit(0)], [F.col("median"), *[F.col(c) for c in config]]).drop("_rank")
    return preferred.unionByName(runner_up.withColumn("role", F.lit("alternative")))


def compare_parallax(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Per frame the corrected minus uncorrected difference over jointly valid cells, display limits
    over both, the largest difference and the common share.

    cells: keys, plain, plain_valid, moved, moved_valid.
    """
    joint = F.col("plain_valid") & F.col("moved_valid")
    rows = cells.withColumn("_both", joint)
    diff = F.when(F.col("_both"), F.col("moved") - F.col("plain"))
    out = rows.groupBy(*keys).agg(
        F.avg(diff).alias("mean_difference"), F.greatest(F.max(F.abs(diff)), F.lit(1e-6)).alias("limit"), F.avg(F.col("_both").cast("double")).alias("common_share"))
    pooled = rows.filter("_both").select(*keys, F.explode(F.array("plain", "moved")).alias("v"))
    edges = exact_quantiles(pooled, keys, F.col("v"), [0.02, 0.98], ["low", "high"])
    return join_on(out, edges, keys)


def pilot_observations(obs: DataFrame, hours: tuple[int, ...] = (4, 16), variable: str = "variable", time: str = "time", ident: str = "asset_id") -> DataFrame:
    """Per variable the observation whose hour of day is nearest each pilot hour (earliest on a tie)."""
    marks = obs.withColumn("pilot_hour", F.explode(F.array(*[F.lit(h) for h in hours])))
    best = first_of(marks, [variable, "pilot_hour"], [F.abs(F.hour(time) - F.col("pilot_hour")), F.col(time), F.col(ident)])
    return best.select(variable, ident, time).distinct()


def pilot_displacement(moved: DataFrame, keys: list[str]) -> DataFrame:
    """Per pilot observation the median and largest displacement and the valid share."""
    facts = moved.groupBy(*keys).agg(F.max("displacement_km").alias("max_km"), F.avg(F.col("valid").cast("double")).alias("valid_fraction"))
    medians = exact_quantiles(moved, keys, F.col("displacement_km"), [0.5], ["median_km"])
    return join_on(facts, medians, keys)


