from pyspark.sql import functions as F

from floodmark.functions import geodesy, hazard, text


def one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_text_columns(spark):
    assert one(spark, ["res1-1snb", "COM4", None], text.norm_occ) == ["RES1", "COM4", None]
    assert one(spark, [" slab ", "Pier/Pile", "b", "?", None, "w"], text.foundation_code) == [7, 2, 4, 7, 7, 5]
    assert one(spark, ["12-057", "", "abc", None, "1234567890123456"], text.norm_fips) == [
        "000000000012057", None, None, None, "123456789012345"]
    assert one(spark, [" x ", "NaN", "none", "", None], text.clean_cell) == ["x", None, None, None, None]
    assert one(spark, ["CoastalA", "VE", " lake ", None], text.norm_flood_class) == ["CAE", "V", "lake", ""]
    assert one(spark, ["coastal_v", "COASTAL - A", "Lake"], text.norm_flood_condition) == ["CoastalV", "CoastalA", "Lake"]
    assert one(spark, ["11 - 34", "0.11 - 0.34", "1", "n/a", None], text.parse_range_pct) == [0.11, 0.11, 1.0, None, None]
    assert one(spark, ["  A  b\tC "], text.clean_text) == ["a b c"]


def test_storm_ids(spark):
    got = one(spark, ["AL0224", "al02", " AL022024 ", "al9", "storm"], lambda c: text.norm_storm_id(c, 2024))
    assert got == ["AL022024", "AL022024", "AL022024", "AL092024", "STORM2024"]
    assert one(spark, ["AL022024"], lambda c: text.storm_id_variants(c, 2024)) == [["AL0224", "AL022024"]]
    assert one(spark, [7, 123], text.advisory_variants, "int") == [["7", "007"], ["123"]]
    parsed = one(spark, ["BERYL_2024_adv29_e10_ResultMaskRaster.tif", "other.tif"], text.parse_raster_name)
    assert (parsed[0]["event"], parsed[0]["adv"], parsed[0]["exceedance"]) == ("BERYL_2024", 29, 10)
    assert parsed[1]["adv"] is None


def test_specific_occupancy(spark):
    rows = [
        ("RES1", 1.0, 7, "R11N"), ("RES1", 4.5, 4, "R13B"), ("RES1", 1.5, 7, "R1SN"), ("RES1", 0.0, 7, "R10N"),
        ("RES2", 3.0, 2, "R21N"), ("RES3A", 2.0, 7, "R3A1N"), ("RES3F", 3.0, 4, "R3F3B"), ("RES3B", 5.0, 7, "R3B5N"),
        ("REL1", 1.0, 7, "RE1LN"), ("COM10", 4.0, 7, "C10MN"), ("COM1", 7.0, 4, "C1HB"), ("IND3", 3.0, 5, "I3LN"),
    ]
    df = spark.createDataFrame(rows, "o string, s double, f int, want string")
    for r in df.select("want", hazard.specific_occupancy("o", "s", "f").alias("got")).collect():
        assert r.got == r.want


def test_bands(spark):
    labels = ["a", "b", "c", "d"]
    assert one(spark, [9.0, 8.9, 6.0, 3.0, 1.0, 0.9], lambda c: hazard.depth_category(c, labels), "double") == [
        "A", "B", "B", "C", "D", "None"]
    assert one(spark, [0.0, 15.0, 39.9, 40.0, 60.0, 100.0, None], hazard.damage_state, "double") == [
        "Slight", "Moderate", "Moderate", "Extensive", "Complete", "Complete", None]
    assert one(spark, [0.0, 0.39, 0.4, 0.8, 1.0], hazard.svi_rate, "double") == [0.0, 0.0, 0.025, 0.05, 0.05]
    zones = spark.createDataFrame(
        [(12.0, 0.0, "MEDIUM"), (12.1, 0.0, "HIGH"), (4.0, 99.0, "LOW"), (3.9, 35.0, "MEDIUM"), (0.0, 35.1, "HIGH"),
         (0.0, 15.0, "LOW"), (0.0, 0.0, "NONE"), (1.0, None, "NONE")], "d double, p double, want string")
    assert all(r.want == r.got for r in zones.select("want", hazard.intensity("d", "p").alias("got")).collect())


def test_debris_and_restoration_keys(spark):
    rows = [("RES1", 4, 3.9, "RES1BSG0"), ("RES1", 4, 8.0, "RES1BSG8"), ("COM6", 4, 6.0, "COM6NBSG6"),
            ("RES1", 7, 1.0, "RES1NBSG1"), ("RES2", 5, 12.0, "RES2NBFT12"), ("IND1", 2, 0.5, "IND1NBFT0")]
    df = spark.createDataFrame(rows, "o string, f int, d double, want string")
    assert all(r.want == r.got for r in df.select("want", hazard.debris_key("o", "f", "d").alias("got")).collect())
    assert one(spark, [0.5, 1.0, 4.0, 8.0, 12.0], lambda c: hazard.restoration_key(F.lit("X"), c), "double") == [
        "X1", "X4", "X8", "X12", "X24"]


def test_utm_control_points(spark):
    # Central meridian on the equator, a point of known scale, and the wider zone of south-west Norway.
    df = spark.createDataFrame([(0.0, -81.0), (28.0, -82.5), (60.0, 4.0), (-10.0, -81.0)], "lat double, lon double")
    a, b, c, d = (r.u for r in df.select(geodesy.to_utm("lat", "lon").alias("u")).collect())
    assert (a.zone, round(a.easting, 3), round(a.northing, 3)) == (17, 500000.0, 0.0)
    assert b.zone == 17 and abs(b.easting - 352531) < 100 and abs(b.northing - 3098037) < 200
    assert c.zone == 32
    assert 8.8e6 < d.northing < 9e6
