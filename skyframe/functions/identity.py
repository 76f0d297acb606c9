"""Content identities and order-free fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(columns: list[str], length: int = 20) -> Column:
    """Leading hex of SHA-256 over the JSON of the columns in name order (NULLs kept)."""
    record = F.struct(*[F.col(c) for c in sorted(columns)])
    return F.substring(F.sha2(F.to_json(record, {"ignoreNullFields": "false"}), 256), 1, length)


def hash_number(text: Column) -> Column:
    """First 60 bits of SHA-256 as a positive long, the same in any engine."""
    return F.conv(F.substring(F.sha2(text.cast("string"), 256), 1, 15), 16, 10).cast("long")


def id_set_digest(ids: Column) -> Column:
    """Order-free digest of a set of ids as an aggregate: mergeable, so a hot group never gathers."""
    number = hash_number(ids)
    return F.concat_ws(":", F.count(ids).cast("string"), F.sum(number.cast("decimal(38,0)")).cast("string"))


def fingerprint(*columns: str) -> Column:
    """Order-free fingerprint of rows as one aggregate struct."""
    row = F.xxhash64(*[F.col(c) for c in columns])
    return F.struct(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(row).alias("xor"),
        F.sum(row.cast("decimal(38,0)")).alias("total"),
    )
