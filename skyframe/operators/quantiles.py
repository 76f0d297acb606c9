"""Exact linear quantiles per group without gathering a group in one task.

Values are first counted by (group, value), then ranked by one ordered scan that cuts hot groups into
value ranges (see ``sequences``). The answer is exact whatever the cuts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.operators.sequences import with_running


def exact_quantiles(df: DataFrame, keys: list[str], value: Column, probabilities: list[float], names: list[str],
                    bounded: bool = False) -> DataFrame:
    """One row per group: keys, then one column per probability (linear interpolation between ranks).

    ``bounded`` promises small groups (runs of a benchmark, sampled messages); then Spark's own exact
    percentile, which holds a group's distinct values in one buffer, does.
    """
    if bounded:
        found = df.groupBy(*keys).agg(F.percentile(value.cast("double"), probabilities).alias("_p"))
        return found.select(*keys, *[F.col("_p")[i].alias(n) for i, n in enumerate(names)])
    marker = keys or ["_all"]
    source = df.select(*[F.col(k) for k in keys], value.cast("double").alias("_v"))
    if not keys:
        source = source.withColumn("_all", F.lit(0))
    # NULLs stay as rows of no weight: a filter here would be pushed below the caller's expressions and
    # repeat them. The test on the count keeps that column in every use of the table, so that Spark shuffles
    # it once and reuses the exchange.
    counted = source.groupBy(*marker, "_v").agg(F.count("_v").alias("_n")).filter(F.col("_n") >= 0)
    ranked = with_running(counted, marker, ["_v"], F.col("_n"), "_upto", total="_total")

    parts, points = quantile_parts("_n", "_upto", "_total", "_v", probabilities, names)
    return ranked.groupBy(*marker).agg(*parts).select(*keys, *points)


def quantile_parts(count: str, upto: str, total: str, value: str, probabilities: list[float], names: list[str]) -> tuple[list[Column], list[Column]]:
    """Aggregates over counted and ranked values of a group, and the columns that make quantiles of them."""
    def value_at(rank):
        return F.max(F.when((F.col(upto) - F.col(count) <= rank) & (rank < F.col(upto)), F.col(value)))

    prefix = f"_{count}"
    parts, points = [F.max(total).alias(f"{prefix}_all")], []
    for i, p in enumerate(probabilities):
        low = F.floor((F.col(total) - 1) * F.lit(float(p)))
        parts += [value_at(low).alias(f"{prefix}_low{i}"), value_at(low + 1).alias(f"{prefix}_high{i}")]
        at = (F.col(f"{prefix}_all") - 1) * F.lit(float(p))
        step = F.coalesce(F.col(f"{prefix}_high{i}") - F.col(f"{prefix}_low{i}"), F.lit(0.0))
        points.append((F.col(f"{prefix}_low{i}") + step * (at - F.floor(at))).alias(names[i]))
    return parts, points
