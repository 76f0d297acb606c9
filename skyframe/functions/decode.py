"""Packed pixels to physical values, and the three class ladders (decode, audit, display)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.functions.times import col

# Public radar products with unit, missing and no-coverage sentinels, minutes between
# files, minutes accumulated, nominal interval, and whether zero also means "no coverage".
PRODUCTS = [
    ("MultiSensor_QPE_01H_Pass2_00.00", "mm", -1.0, -3.0, 60, 60, 60, False),
    ("MultiSensor_QPE_01H_Pass1_00.00", "mm", -1.0, -3.0, 60, 60, 60, False),
    ("RadarOnly_QPE_01H_00.00", "mm", -1.0, -3.0, 2, 60, 60, False),
    ("PrecipRate_00.00", "mm h-1", -1.0, -3.0, 2, 0, 0, False),
    ("MergedReflectivityQCComposite_00.50", "dBZ", -99.0, -999.0, 2, 0, 0, False),
    ("MergedBaseReflectivityQC_00.50", "dBZ", -99.0, -999.0, 2, 0, 0, False),
    ("RadarQualityIndex_00.00", "1", -1.0, -3.0, 2, 0, 0, False),
    ("MergedAzShear_0-2kmAGL_00.50", "0.001 s-1", 0.0, 0.0, 2, 0, 0, True),
    ("MergedAzShear_3-6kmAGL_00.50", "0.001 s-1", 0.0, 0.0, 2, 0, 0, True),
]
PRODUCT_SCHEMA = ("product string, unit string, missing double, no_coverage double, frequency_minutes int, "
                  "accumulation_minutes int, interval_minutes int, zero_ambiguous boolean")

# Readable names of the products.
ALIASES = {
    "precipitation-rate": "PrecipRate_00.00",
    "composite-reflectivity": "MergedReflectivityQCComposite_00.50",
    "base-reflectivity": "MergedBaseReflectivityQC_00.50",
    "radar-only-qpe-1h": "RadarOnly_QPE_01H_00.00",
    "low-level-azimuthal-shear": "MergedAzShear_0-2kmAGL_00.50",
    "mid-level-azimuthal-shear": "MergedAzShear_3-6kmAGL_00.50",
    "radar-quality-index": "RadarQualityIndex_00.00",
    "multisensor-qpe-pass1": "MultiSensor_QPE_01H_Pass1_00.00",
    "multisensor-qpe-pass2": "MultiSensor_QPE_01H_Pass2_00.00",
}

# Meaning of the exclusive class codes.
CLASS_NAMES = {
    0: "valid", 1: "missing_fill", 2: "no_coverage", 3: "bitmap_missing", 4: "nonfinite",
    5: "quality_flag", 6: "outside_valid_range", 7: "ambiguous_shear_zero", 8: "quality_unknown",
    9: "conditional_quality", 10: "invalid_calibration",
}


def product_table(spark: SparkSession) -> DataFrame:
    """The product dimension (nine fixed rows, safe to broadcast)."""
    return spark.createDataFrame(PRODUCTS, PRODUCT_SCHEMA)


def with_product(df: DataFrame, product: str = "product") -> DataFrame:
    """Add the product's sentinel columns; an unknown product fails the job."""
    dimension = F.broadcast(product_table(df.sparkSession).withColumnRenamed("product", product))
    joined = df.join(dimension, product, "left")
    known = F.when(F.col("unit").isNotNull(), True).otherwise(F.raise_error(F.lit("Unknown product")).cast("boolean"))
    return joined.filter(known)


def product_key(name: Column | str) -> Column:
    """Readable name (any case) or exact key to the product key; anything else fails."""
    exact = {row[0]: row[0] for row in PRODUCTS}
    pairs = [F.lit(x) for kv in {**ALIASES, **exact}.items() for x in kv]
    table = F.create_map(*pairs)
    return F.coalesce(table[F.lower(col(name))], table[col(name)],
                      F.raise_error(F.lit("Unknown product name")).cast("string"))


def unsigned16(value: Column | str, flag: Column | None = None) -> Column:
    """Reinterpret a signed 16-bit container, where ``flag`` holds (everywhere without one)."""
    plain = col(value).cast("int")
    masked = plain.bitwiseAND(F.lit(65535))
    return masked if flag is None else F.when(flag, masked).otherwise(plain)


def finite(value: Column | str) -> Column:
    value = col(value).cast("double")
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def to_physical(encoded: Column, scale: Column | str, offset: Column | str) -> Column:
    """Packed to physical as float32."""
    return (encoded.cast("double") * col(scale) + col(offset)).cast("float")


def radar_class(raw="raw", missing="missing", no_coverage="no_coverage", bitmap="bitmap") -> Column:
    """Bitmap over nonfinite over no coverage over fill."""
    raw = col(raw)
    return (
        F.when(col(bitmap) == 0, 3).when(~finite(raw), 4)
        .when(raw == col(no_coverage), 2).when(raw == col(missing), 1).otherwise(0)
    )


def satellite_class(raw="raw", encoded="encoded", physical="physical", quality="quality", fill="fill",
                    low="low", high="high") -> Column:
    """Calibration over nonfinite over fill over range over quality."""
    raw, encoded, quality = col(raw), col(encoded), col(quality)
    graded = F.when(quality.isNull(), 8).when(quality == 1, 9).when(quality != 0, 5).otherwise(0)
    return (
        F.when(finite(raw) & ~finite(physical), 10).when(~finite(raw), 4)
        .when((raw == col(fill)) | (encoded == col(fill)), 1)
        .when((encoded < col(low)) | (encoded > col(high)), 6).otherwise(graded)
    )


def class_valid(code="class", policy: str = "good") -> Column:
    """Validity of a decoded pixel; ``conditional`` also accepts class 9."""
    code = col(code)
    return (code == 0) | (code == 9) if policy == "conditional" else code == 0


def display_class_satellite(raw="raw", quality="quality", fill="fill", low="low", high="high") -> Column:
    """P05 satellite: range, then any nonzero quality, then fill, then nonfinite (last wins)."""
    raw, quality = col(raw), col(quality)
    return (
        F.when(~finite(raw), 4).when(raw == col(fill), 1).when(quality != 0, 5)
        .when((raw < col(low)) | (raw > col(high)), 6).otherwise(0)
    )


def display_class_radar(raw="raw", missing="missing", no_coverage="no_coverage", ambiguous="zero_ambiguous",
                        bitmap="bitmap") -> Column:
    """P05 radar: ambiguous zero or sentinels, then nonfinite, then bitmap (last wins)."""
    raw, ambiguous = col(raw), col(ambiguous)
    return (
        F.when(col(bitmap) == 0, 3).when(~finite(raw), 4)
        .when(ambiguous & (raw == 0), 7).when(~ambiguous & (raw == col(no_coverage)), 2)
        .when(~ambiguous & (raw == col(missing)), 1).otherwise(0)
    )


def restore_calibration(df: DataFrame, metadata: str = "source_metadata_json", band_variable: str = "CMI") -> DataFrame:
    """Every observation keeps the scale, offset, fill and limits of its own scan, and whether its container is
    unsigned; limits of a signed one are taken as they are.

    The parsed document goes through a generator: field by field Spark would parse it again for each.
    """
    attrs = ("struct<scale_factor:double,add_offset:double,_FillValue:int,valid_range:array<int>,"
             "_Unsigned:string,units:string>")
    schema = f"struct<dataset:map<string,string>,variables:map<string,struct<attrs:{attrs}>>>"
    parsed = F.from_json(metadata, schema)["variables"][band_variable]["attrs"]
    flag = F.coalesce(F.lower("_attrs._Unsigned") == "true", F.lit(False))
    return df.select("*", F.explode(F.array(parsed)).alias("_attrs")).select(
        *df.columns,
        F.coalesce("_attrs.scale_factor", F.lit(1.0)).alias("scale"),
        F.coalesce("_attrs.add_offset", F.lit(0.0)).alias("offset"),
        F.col("_attrs._FillValue").alias("fill"),
        unsigned16(F.col("_attrs.valid_range")[0], flag).alias("low"),
        unsigned16(F.col("_attrs.valid_range")[1], flag).alias("high"),
        F.col("_attrs.units").alias("units"),
        flag.alias("unsigned"),
    )


def with_audit(df: DataFrame, kind: str) -> DataFrame:
    """Overlapping flags plus the exclusive ``class`` and the ``value``, for ``radar`` or ``satellite`` pixels.

    Radar input columns: raw, missing, no_coverage, zero_ambiguous, bitmap (NULL when absent).
    Satellite input columns: raw, encoded, physical, quality (NULL when absent), fill, low, high.
    The flags are columns that build on each other, so that no test is repeated.
    """
    raw, no, c = F.col("raw"), F.lit(False), F.col

    def known(condition):
        return F.coalesce(condition, no)

    if kind == "radar":
        plain = ~c("zero_ambiguous")
        first = {
            "value": raw.cast("double"), "ambiguous_shear_zero": known(c("zero_ambiguous") & (raw == 0)),
            "fill": known(plain & (raw == c("missing"))), "no_coverage": known(plain & (raw == c("no_coverage"))),
            "bitmap_missing": known(c("bitmap") == 0), "outside_range": no, "nonfinite": ~finite(raw)}
    else:
        first = {
            "value": c("physical").cast("double"), "ambiguous_shear_zero": no, "fill": known(raw == c("fill")), "no_coverage": no,
            "bitmap_missing": no, "outside_range": known((c("encoded") < c("low")) | (c("encoded") > c("high"))), "nonfinite": ~finite(raw)}
    rows = df.withColumns(first)
    rows = rows.withColumn("calibration_nonfinite", no if kind == "radar" else ~c("nonfinite") & ~finite("value"))
    bad = ["nonfinite", "calibration_nonfinite", "fill", "no_coverage", "bitmap_missing", "outside_range", "ambiguous_shear_zero"]
    numeric = ~c(bad[0])
    for name in bad[1:]:
        numeric = numeric & ~c(name)
    rows = rows.withColumn("numeric_valid", numeric)
    if kind == "radar":
        graded = {"strict_good": c("numeric_valid"), "good_plus_conditional": c("numeric_valid"), "quality_unknown": no}
        base = F.lit(0)
    else:
        quality = c("quality")
        graded = {"strict_good": c("numeric_valid") & known(quality == 0), "good_plus_conditional": c("numeric_valid") & known(quality.isin(0, 1)),
                  "quality_unknown": quality.isNull()}
        base = F.when(~c("numeric_valid"), 0).when(quality.isNull(), 8).when(quality == 1, 9).when(quality != 0, 5).otherwise(0)
    code = (
        F.when(c("bitmap_missing"), 3).when(c("calibration_nonfinite"), 10).when(c("nonfinite"), 4).when(c("no_coverage"), 2)
        .when(c("fill"), 1).when(c("outside_range"), 6).when(c("ambiguous_shear_zero"), 7).otherwise(base))
    rows = rows.withColumns({**graded, "class": code, "raw_zero": known(raw == 0)})
    return rows.withColumns({"valid_zero": c("strict_good") & known(c("value") == 0), "valid_negative": c("strict_good") & known(c("value") < 0)})
