"""Printable labels: sizes, ratios, units, series names, dataset names, descriptors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyframe.functions.times import col

UNITS = ("B", "KiB", "MiB", "GiB", "TiB")


def size_text(value: Column | str) -> Column:
    """Bytes with a binary unit and one decimal; ``unavailable`` when unknown."""
    value = col(value).cast("double")
    out = F.when(value.isNull(), F.lit("unavailable"))
    for power, unit in enumerate(UNITS):
        shown = F.format_number(value / 1024**power, 0 if power == 0 else 1)
        text = F.concat(shown, F.lit(" " + unit))
        last = power == len(UNITS) - 1
        out = out.otherwise(text) if last else out.when(F.abs(value / 1024**power) < 1024, text)
    return out


def ratio_text(source="source_bytes", stored="stored_bytes", known_source="known_source_bytes",
               known_stored="known_stored_bytes") -> Column:
    """Stored size as a share of the source, from the known subset when the total is unknown."""
    whole = col(source).isNotNull()
    base = F.when(whole, col(source)).otherwise(col(known_source))
    kept = F.when(whole, col(stored)).otherwise(F.coalesce(col(known_stored), col(stored)))
    ratio = kept / base
    word = F.when(ratio < 1, "smaller").when(ratio > 1, "larger").otherwise("the same size")
    detail = F.when(ratio != 1, F.concat(F.format_string("%.1f%% ", 100 * F.abs(ratio - 1)), word)).otherwise(word)
    return F.when(base.isNull() | (base == 0), "unavailable").otherwise(
        F.concat(F.format_string("%.1f%% of source (", 100 * ratio), detail, F.lit(")")))


def variable_unit(variable: Column | str) -> Column:
    """C14: unit of a variable: reflectance for the first six bands, kelvin for the rest, dBZ for radar."""
    band = F.regexp_extract(col(variable), r"^abi(\d+)c$", 1)
    number = F.when(band != "", band.cast("int"))
    return F.when(number <= 6, "1").when(number > 6, "K").otherwise("dBZ")


def series_label(product: Column | str, band: Column | str) -> Column:
    """C14: product, followed by the band when there is one."""
    return F.when(col(band).isNull(), col(product)).otherwise(
        F.concat(col(product), F.format_string(" C%02d", col(band).cast("int"))))


def dataset_name(path: Column | str, source: Column | str) -> Column:
    """logical dataset of a path: what follows the source folder, without the region folder and
    everything below it, and for satellite data without a trailing band folder."""
    after = F.element_at(F.split(col(path), F.concat(F.lit("/"), col(source), F.lit("/")), 2), -1)
    bare = F.regexp_replace(after, r"/roi-[^/]+(?:/.*)?$", "")
    return F.when(col(source) == "satellite", F.regexp_replace(bare, r"/C\d{2}$", "")).otherwise(bare)


def plain_descriptor(descriptor: Column | str) -> Column:
    """Forecast descriptor with its hours blanked."""
    return F.regexp_replace(col(descriptor), r"\d+(?:-\d+)? hour", "<lead> hour")
