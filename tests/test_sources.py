import json

import pytest
from pyspark.sql import functions as F

from floodmark.params import run_params
from floodmark.plans.ingest import features_to_inventory
from floodmark.sinks import exports
from floodmark.sources import features, predictions


def feature(bid, **props):
    return json.dumps({"type": "Feature", "properties": {"bid": bid, **props}, "geometry": {"type": "Point", "coordinates": [-82.5, 28.0]}})


def lines(spark, *texts):
    return spark.createDataFrame([("Florida", t) for t in texts], "state string, line string")


def test_feature_lines(spark):
    good = lines(spark, feature("a", sqft=1500), "  ", feature("b"), '{"type":"Other"}', "[1]", '{"type":"Feature","properties":{"bid":"c"},"geometry":{"type":"Polygon","coordinates":[]}}')
    rows = {r.bid: r for r in features.parse_features(good).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert (rows["a"].longitude, rows["a"].latitude, rows["a"].sqft, rows["c"].longitude) == (-82.5, 28.0, "1500", None)
    with pytest.raises(Exception, match="not a feature"):
        features.parse_features(good, on_nonfeature="fail").collect()
    bad = lines(spark, feature("a"), feature("b")[:40])
    with pytest.raises(Exception, match="malformed"):
        features.parse_features(bad).collect()
    assert sorted(str(r.bid) for r in features.parse_features(bad, on_bad="null").collect()) == ["None", "a"]
    with pytest.raises(ValueError, match="empty"):
        features.require_rows(features.parse_features(lines(spark, " ")))
    out = features_to_inventory(lines(spark, feature("a", sqft=1500, num_story=2))).first()
    assert (out.bid, out.sqft, out.num_story, out.x, out.state) == ("a", 1500.0, 2, -82.5, "Florida")


def test_prediction_files(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("007", "RES1", "12.5", "RES1NBSG1", "x")], "FltyId string, Occ string, BldgDmgPct string, DebrisID string, Extra string").write.option("header", True).csv(path)
    df = predictions.read_predictions(spark, path)
    assert df.columns == ["fltyid", "occ", "bldgdmgpct", "debrisid", "extra"]
    assert tuple(df.first()) == ("007", "RES1", 12.5, "RES1NBSG1", "x")
    (tmp_path / "e.csv").write_text("FltyId,Occ\n")
    with pytest.raises(RuntimeError, match="empty"):
        predictions.read_predictions(spark, str(tmp_path / "e.csv"))


def test_store_replaces_only_its_partitions(spark, tmp_path):
    root = str(tmp_path / "store")
    df = spark.createDataFrame([("a", 1.0)], "fltyid string, v double")
    exports.write_predictions(df, root, "E_2024", 9, "r", "1", "CoastalA")
    exports.write_predictions(df, root, "E_2024", 10, "r", "1", "CoastalA")
    exports.write_predictions(df.union(df), root, "E_2024", 10, "r", "2", "CoastalA")
    got = {(r.adv, r.run_id): r["count"] for r in predictions.read_prediction_store(spark, root).groupBy("adv", "run_id").count().collect()}
    assert got == {(9, "1"): 1, (10, "2"): 2}


def test_store_keeps_flood_classes_and_rasters_apart(spark, tmp_path):
    root = str(tmp_path / "store")
    df = spark.createDataFrame([("a", 1.0)], "fltyid string, v double")
    for flc, raster in (("CAE", "r1"), ("V", "r1"), ("CAE", "r2")):
        exports.write_predictions(df, root, "BERYL_2024", 29, raster, "1", flc)
    exports.write_predictions(df.union(df), root, "BERYL_2024", 29, "r1", "2", "V")
    stored = predictions.read_prediction_store(spark, root).groupBy("flc", "raster_name", "run_id").count().collect()
    assert {(r.flc, r.raster_name, r.run_id): r["count"] for r in stored} == {("CAE", "r1", "1"): 1, ("V", "r1", "2"): 2, ("CAE", "r2", "1"): 1}


def test_publish_and_json(spark, tmp_path):
    df = spark.createDataFrame([("12057", 1.23456789, None)], "FIPS string, v double, n string")
    path = exports.publish(df, run_params({"storm_id": "x", "storm_name": "y"}), str(tmp_path))
    assert path.endswith("shelter_demand_output_Y_X_0_county.csv") and spark.read.option("header", True).csv(path).count() == 1
    assert json.loads(exports.to_json_records(df).first().record) == {"FIPS": "12057", "v": 1.234568, "n": None}


def test_deepest_first_with_ids_in_order(spark):
    df = spark.range(500).select(F.format_string("%03d", F.pmod(F.xxhash64("id"), F.lit(1000))).alias("FltyId"), F.when(F.col("id") % 9 > 0, (F.col("id") % 4).cast("double")).alias("Depth_in_Struc")).repartition(7)
    rows = [(r.Depth_in_Struc, r.FltyId) for r in exports.sort_by_depth(df).collect()]
    assert rows == sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0.0), r[1]))
