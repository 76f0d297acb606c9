"""Byte indexes of forecast files and the field tables that select records from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyframe.functions.checks import guard

# Chosen record per channel: name, field code, level, statistic.
CORE = [
    ("surface_pressure", "PRES", "surface", "instant"),
    ("sea_level_pressure", "PRMSL", "mean sea level", "instant"),
    ("air_temperature_2m", "TMP", "2 m above ground", "instant"),
    ("dew_point_2m", "DPT", "2 m above ground", "instant"),
    ("wind_u_10m", "UGRD", "10 m above ground", "instant"),
    ("wind_v_10m", "VGRD", "10 m above ground", "instant"),
    ("precipitable_water", "PWAT", "entire atmosphere", "instant"),
    ("precipitation_accumulation", "APCP", "surface", "native-accumulation"),
    ("precipitation_rate", "PRATE", "surface", "instant"),
    ("composite_reflectivity", "REFC", "entire atmosphere", "instant"),
]
UPPER = [
    ("height_500", "HGT", "500 mb", "instant"),
    ("temperature_850", "TMP", "850 mb", "instant"),
    ("humidity_850", "SPFH", "850 mb", "instant"),
    ("wind_u_850", "UGRD", "850 mb", "instant"),
    ("wind_v_850", "VGRD", "850 mb", "instant"),
    ("pressure_velocity_700", "VVEL", "700 mb", "instant"),
]

# Field code and level prefix of the looser single-field match.
FIELD_LEVELS = [
    ("PRES", "surface"), ("PRMSL", "mean sea level"), ("DPT", "2 m above ground"), ("REFC", "entire atmosphere"),
    ("HGT", "500 mb"), ("APCP", "surface"), ("PRATE", "surface"), ("TMP", "2 m above ground"),
    ("UGRD", "10 m above ground"), ("VGRD", "10 m above ground"), ("PWAT", "entire atmosphere"),
]
SPEC_SCHEMA = "name string, code string, want_level string, statistic string"


def spec_table(spark: SparkSession, specs: list[tuple] | None = None) -> DataFrame:
    """The record choices as a dimension (U07: both lists together unless one is given)."""
    return spark.createDataFrame(specs or [*CORE, *UPPER], SPEC_SCHEMA)


def parse_byte_index(lines: DataFrame, key: str = "key", line: str = "line", size: str = "size", carry: list[str] | None = None) -> DataFrame:
    """Records with their byte range; a range ends at the next distinct offset of the file, the last
    at the file size. Lines without an offset are skipped; an offset beyond the file fails. ``carry`` names columns
    of the file (its lead, its publication) that stay with its records, so that nothing has to join them back."""
    carry = carry or []
    # Through a generator a line is split once; column by column Spark would split it again for each.
    split = lines.select(key, *carry, size, F.explode(F.array(F.split(line, ":"))).alias("_parts"))
    parts = F.col("_parts")
    number = F.get(parts, F.lit(1))
    rows = split.filter((F.size(parts) >= 6) & number.rlike(r"^\d+$")).select(
        key, *carry, size, number.cast("long").alias("start"), parts[3].alias("field"), parts[4].alias("level"), parts[5].alias("descriptor"))
    rows = guard(rows, F.col("start") < F.col(size), "Malformed index offsets")
    # One file's index is small, so a window over it does; equal offsets share their end.
    later = Window.partitionBy(key).orderBy("start").rangeBetween(1, Window.unboundedFollowing)
    stop = F.coalesce(F.min("start").over(later), F.col(size))
    return rows.select(key, *carry, "start", stop.alias("stop"), "field", "level", "descriptor")


def match_records(records: DataFrame, specs: DataFrame, lead: str = "lead") -> DataFrame:
    """records that satisfy a choice: field, level (a prefix for the whole atmosphere) and the
    descriptor for the lead; accumulations end at the lead and span one to three hours."""
    joined = records.join(F.broadcast(specs), F.col("field") == F.col("code"))  # a fixed list of choices
    whole = F.col("want_level") == "entire atmosphere"
    level = (F.col("level") == F.col("want_level")) | (whole & F.col("level").startswith("entire atmosphere"))
    instant = F.when(F.col(lead) == 0, "anl").otherwise(F.concat(F.col(lead).cast("string"), F.lit(" hour fcst")))
    window = r"^(\d+)-(\d+) hour acc fcst$"
    begin = F.regexp_extract("descriptor", window, 1).try_cast("int")
    finish = F.regexp_extract("descriptor", window, 2).try_cast("int")
    summed = (finish == F.col(lead)) & (F.col(lead) - begin).between(1, 3)
    right = F.when(F.col("statistic") == "instant", F.col("descriptor") == instant).otherwise(F.coalesce(summed, F.lit(False)))
    return joined.filter(level & right).drop("code", "want_level")


def match_field(records: DataFrame, code: str) -> DataFrame:
    """looser match of one field by code and level prefix."""
    level = dict(FIELD_LEVELS).get(code)
    if level is None:
        raise ValueError(f"Unsupported field {code}")
    return records.filter((F.col("field") == code) & F.col("level").startswith(level))
