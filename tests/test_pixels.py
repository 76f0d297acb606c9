import pytest
from pyspark.sql import functions as F

from skyframe.functions import decode as dc
from skyframe.operators import pixels as px
from skyframe.operators import reports as rp


def _satellite(spark, raws, quality, scale=0.5, offset=2.0):
    rows = [(i, r, q, scale, offset, 65535, 0, 65534) for i, (r, q) in enumerate(zip(raws, quality))]
    return spark.createDataFrame(rows, "i int, raw int, quality int, scale double, offset double, fill int, low int, high int")


def test_satellite_example(spark):
    df = _satellite(spark, [-1, -2, 1, 2, 3], [0, 1, 0, 2, 0])
    rows = px.decode_satellite(df).orderBy("i").collect()
    assert [r["class"] for r in rows] == [1, 9, 0, 5, 0]
    assert rows[2].value == 2.5 and rows[1].value is None
    loose = px.decode_satellite(df, "conditional").orderBy("i").collect()
    assert loose[1].value == pytest.approx(65534 * 0.5 + 2)
    broken = px.decode_satellite(_satellite(spark, [1, 2], [0, 0], scale=float("inf"))).collect()
    assert not any(r.valid for r in broken) and {r["class"] for r in broken} == {10}
    unknown = px.decode_satellite(_satellite(spark, [1], [None])).first()
    assert unknown["class"] == 8 and not unknown.valid and unknown.out_quality == 255


def test_radar_example(spark):
    rows = [(i, "MergedReflectivityQCComposite_00.50", r, b) for i, (r, b) in enumerate(zip([-20.0, 0.0, -99.0, -999.0, 7.0], [1, 1, 1, 1, 0]))]
    out = px.decode_radar(spark.createDataFrame(rows, "i int, product string, raw double, bitmap int")).orderBy("i").collect()
    assert [r.valid for r in out] == [True, True, False, False, False]
    assert [r["class"] for r in out] == [0, 0, 1, 2, 3] and out[0].value == -20.0
    shear = spark.createDataFrame([("MergedAzShear_0-2kmAGL_00.50", 0.0, 1)], "product string, raw double, bitmap int")
    with pytest.raises(Exception, match="unambiguous"):
        px.decode_radar(shear).collect()
    with pytest.raises(Exception, match="Unknown product"):
        px.decode_radar(shear.withColumn("product", F.lit("nothing"))).collect()


def test_scan_calibration_stays_with_its_scan(spark):
    meta = '{"variables":{"CMI":{"attrs":{"scale_factor":%d,"add_offset":0,"_FillValue":65535,"valid_range":[0,-2]%s}}}}'
    df = spark.createDataFrame([(1, 10, meta % (2, ',"_Unsigned":"True"')), (2, 10, meta % (7, ""))], "scan int, raw int, source_metadata_json string")
    rows = dc.restore_calibration(df).orderBy("scan").collect()
    assert [r.raw * r.scale + r.offset for r in rows] == [20.0, 70.0]
    assert (rows[0].low, rows[0].high) == (0, 65534) and (rows[1].low, rows[1].high) == (0, -2)


def test_signed_scans_stay_signed(spark):
    meta = '{"variables":{"CMI":{"attrs":{"scale_factor":1,"add_offset":0,"_Unsigned":"false","valid_range":[-100,100]}}}}'
    df = dc.restore_calibration(spark.createDataFrame([(-10, 0, meta)], "raw int, quality int, source_metadata_json string"))
    row = px.decode_satellite(df).first()
    assert (row["class"], row.value) == (0, -10.0)


def test_pixel_statistics_example(spark):
    df = _satellite(spark, [0, -2, -1, 4], [0, 1, 0, 3]).withColumns({"encoded": dc.unsigned16("raw"), "fill": F.lit(-1)})
    df = df.withColumn("physical", dc.to_physical(F.col("encoded"), "scale", "offset")).withColumn("frame", F.lit(1))
    row = px.pixel_statistics(df, ["frame"], "satellite").first()
    assert (row.strict_good, row.good_plus_conditional, row.fill, row.pixels) == (1, 2, 1, 4)
    assert row.strict_good_percent == 25.0 and row.strict_median == 2.0
    none = px.pixel_statistics(df.withColumn("quality", F.lit(None).cast("int")), ["frame"], "satellite").first()
    assert none.quality_unknown == 4 and none.strict_mean is None


def test_class_ladders_differ(spark):
    df = _satellite(spark, [-1], [2]).withColumns({"encoded": dc.unsigned16("raw"), "physical": F.lit(1.0), "fill": F.lit(-1), "low": F.lit(0), "high": F.lit(10)})
    for raw, want in ((-1, (1, 1, 1)), (-5, (6, 6, 5))):
        rows = df.withColumn("raw", F.lit(raw)).withColumn("decode", dc.satellite_class()).withColumn("display", dc.display_class_satellite())
        row = dc.with_audit(rows, "satellite").first()
        assert (row.decode, row["class"], row.display) == want


def test_training_moments_refuse_constant_channels(spark):
    rows = [("a", "2024-01-01 00:10:00", 1.0, True), ("a", "2024-01-01 00:20:00", 3.0, True), ("b", "2024-01-01 00:10:00", 5.0, True)]
    df = spark.createDataFrame(rows, "variable string, time string, value double, valid boolean").withColumn("time", F.to_timestamp("time").cast("timestamp_ntz"))
    row = px.training_moments(df, ["a"], "2024-01-01 00:00:00", "2024-01-01 00:30:00").first()
    assert (row.pixels, row["mean"], row["std"]) == (2, 2.0, 1.0)
    with pytest.raises(Exception, match="constant"):
        px.training_moments(df, ["a", "b"], "2024-01-01 00:00:00", "2024-01-01 00:30:00").collect()


def test_crops_guards_and_limits(spark):
    df = spark.range(64).select((F.col("id") % 8).cast("int").alias("x"), F.floor(F.col("id") / 8).cast("int").alias("y"))
    df = df.withColumns({"lon": F.col("x") + 350.5, "lat": F.col("y") * 1.0, "view_x": F.col("x") * 1.0, "view_y": F.col("y") * 1.0})
    box = px.crop_box(df, (-7.0, 2.0, -5.0, 4.0), halo=1)
    assert box.count() == 16 and px.centre_crop(df, 8, 8, 4).count() == 16
    assert px.crop_view(df, 1, 1, 2, 2).count() == 4
    with pytest.raises(Exception, match="outside"):
        px.crop_view(df, 50, 50, 60, 60).collect()
    limits = px.common_limits(spark.createDataFrame([(2.0,), (float("nan"),), (2.0,)], "value double")).first()
    assert (limits.low, limits.high) == (2.0, 3.0)
    named = spark.createDataFrame([("band01",)], "variable string")
    assert px.select_bands(named, ["band01", "band02"], allow_missing=True).count() == 1
    with pytest.raises(Exception, match="missing"):
        px.select_bands(named, ["band01", "band02"]).collect()


def test_weighted_moments_example(spark):
    payload = '{"pixels":%d,"strict_good":%d,"strict_stats":{"mean":%s,"std":%s,"minimum":0,"maximum":9}}'
    rows = [("p", None, "2024-01-02 00:00:00", "Whole ROI", payload % (2, 2, 1, 1)), ("p", None, "2024-01-05 00:00:00", "Whole ROI", payload % (6, 6, 5, 2))]
    df = spark.createDataFrame(rows, "product string, band int, time string, patch string, payload string").withColumn("time", F.to_timestamp("time").cast("timestamp_ntz"))
    row = rp.calendar_rollup(rp.flatten_payload(df), "month").first()
    assert row["mean"] == 4.0 and row["std"] == pytest.approx(6.25 ** 0.5) and row.strict_good_percent == 100.0


def test_longest_outage_and_even_sample(spark):
    rows = [("p", i, f"f{i}", v) for i, v in enumerate([0, 0, 5, 0, 0, 0, 1])]
    df = spark.createDataFrame(rows, "patch string, t long, key string, valid_pixels long")
    assert rp.longest_outage(df, ["patch"], ["t", "key"]).first().longest_invalid_frames == 3
    picked = [r.t for r in rp.even_sample(df, ["patch"], ["t", "key"], 4).orderBy("t").collect()]
    assert picked == [0, 2, 4, 6]
    assert rp.even_sample(df, ["patch"], ["t", "key"], 24).count() == 7
