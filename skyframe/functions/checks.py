"""Row and table guards that run inside the plan, so nothing is collected to check it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def guard(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """Pass every row through; a row that breaks ``condition`` (false or NULL) fails the job."""
    return df.filter(F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def require_empty(violations: DataFrame, message: str) -> DataFrame:
    """One-row table ``violations=0``, failing the job if any row is present."""
    counted = violations.agg(F.count(F.lit(1)).alias("violations"))
    return guard(counted, F.col("violations") == 0, message)
