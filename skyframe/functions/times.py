"""Time columns. Instants are handled as integer microseconds; intervals are half-open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def micros(value) -> Column:
    """UTC microseconds of a timestamp (with or without zone)."""
    return F.unix_micros(col(value).cast("timestamp"))


def instant(value) -> Column:
    """Microseconds back to a zone-free UTC timestamp."""
    return F.timestamp_micros(col(value)).cast("timestamp_ntz")


def literal_micros(text: str) -> int:
    """Microseconds of an ISO text, read as UTC when it has no zone."""
    from datetime import datetime, timezone

    stamp = datetime.fromisoformat(text.replace("Z", "+00:00"))
    if stamp.tzinfo is None:
        stamp = stamp.replace(tzinfo=timezone.utc)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    delta = stamp - epoch
    return (delta.days * 86400 + delta.seconds) * SECOND + delta.microseconds


def floor_to(us, step: int) -> Column:
    us = col(us)
    return us - F.pmod(us, F.lit(step))


def ceil_to(us, step: int) -> Column:
    us = col(us)
    return us + F.pmod(-us, F.lit(step))


def parse_utc(text) -> Column:
    """ISO text (``Z``, offset or bare) to a UTC timestamp; C01."""
    return F.to_timestamp(col(text)).cast("timestamp_ntz")


def iso_text(stamp) -> Column:
    """UTC text ending in Z; C01."""
    return F.date_format(col(stamp), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def floor_hour(stamp) -> Column:
    """C13 hour floor."""
    return F.date_trunc("hour", col(stamp)).cast("timestamp_ntz")


def month_label(stamp) -> Column:
    return F.date_format(col(stamp), "yyyy-MM")


def month_start(stamp) -> Column:
    return F.date_trunc("month", col(stamp)).cast("timestamp_ntz")


def clock_slots(start, end, cadence_minutes: int) -> Column:
    """Array of cadence-aligned slots in ``[start, end)``; explode it to get rows."""
    if cadence_minutes < 1 or 60 % cadence_minutes:
        raise ValueError("The cadence must be a positive divisor of 60 minutes")
    step = cadence_minutes * MINUTE
    first, last = ceil_to(micros(start), step), micros(end) - 1
    return F.when(
        first <= last,
        F.transform(F.sequence(first, last, F.lit(step)), instant),
    ).otherwise(F.array().cast("array<timestamp_ntz>"))


def month_segments(start, end) -> Column:
    """Array of ``(month, start, end)`` pieces of ``[start, end)`` cut at month boundaries."""
    start, end = col(start), col(end)
    months = F.sequence(
        F.date_trunc("month", start).cast("timestamp"),
        F.date_trunc("month", F.timestamp_micros(micros(end) - 1)).cast("timestamp"),
        F.expr("interval 1 month"),
    )
    return F.transform(
        months,
        lambda m: F.struct(
            F.date_format(m, "yyyy-MM").alias("month"),
            F.greatest(m.cast("timestamp_ntz"), start.cast("timestamp_ntz")).alias("start"),
            F.least(F.add_months(m.cast("date"), 1).cast("timestamp_ntz"), end.cast("timestamp_ntz")).alias("end"),
        ),
    )


def clock_text(seconds) -> Column:
    """HH:MM:SS, ``--`` when unknown, never negative."""
    whole = F.greatest(F.lit(0), F.floor(col(seconds))).cast("long")
    return F.when(col(seconds).isNull(), F.lit("--")).otherwise(
        F.format_string(
            "%02d:%02d:%02d",
            F.floor(whole / 3600).cast("long"),
            F.floor(F.pmod(whole, F.lit(3600)) / 60).cast("long"),
            F.pmod(whole, F.lit(60)),
        )
    )
