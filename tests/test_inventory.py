import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from floodmark.operators import inventory as inv
from floodmark.params import run_params
from floodmark.schema import INVENTORY
from floodmark.sinks import exports
from floodmark.sources import inventory as src

COLS = "bid string, occtype string, val_struct double, sqft double, num_story double, found_type string, found_ht double, val_cont double, latitude double, longitude double, cbfips string"
ROWS = [
    ("a", "RES1-1", 10.0, 1.0, 1.0, "Slab", 1.0, None, 28.0, -82.0, "12001"),
    ("a", "RES1-1", 20.0, 1.0, 1.0, "Slab", 1.0, 5.0, 28.0, -82.0, "12001"),
    ("b", "COM1", 20.0, None, 1.0, "Pier", 1.0, 5.0, 28.0, -82.0, None),
    ("c", "COM1", 7.0, 2.0, 1.0, "Pier", 1.0, 5.0, 28.0, -82.0, ""),
    ("c", "COM2", 7.0, 2.0, 1.0, "Pier", 1.0, 5.0, 28.0, -82.0, ""),
    ("d", None, 7.0, 2.0, 1.0, "Pier", 1.0, 5.0, 28.0, -82.0, ""),
]


def test_engine_input_drop_and_fill(spark):
    df = spark.createDataFrame(ROWS, COLS)
    drop = {r.FltyId: r for r in inv.engine_input(df).collect()}
    assert set(drop) == {"a", "c"}
    assert drop["a"].Cost == 20.0 and drop["a"].Occ == "RES1" and drop["c"].Occ == "COM1" and drop["c"].cbfips is None
    fill = {r.FltyId: r for r in inv.engine_input(df, "fill").collect()}
    assert set(fill) == {"a", "b", "c"} and fill["b"].Area == 0.0
    assert fill["b"].FoundationType == 2


def test_plan_prunes_and_limits_per_key(spark, tmp_path):
    path = str(tmp_path / "inv")
    spark.createDataFrame(ROWS, COLS).withColumn("state", F.lit("Florida")).write.partitionBy("state").parquet(path)
    scan = src.scan_states(src.read_inventory(spark, path), ["FLORIDA"])
    plan = plan_of(inv.engine_input(inv.in_bbox(scan, -85, 25, -80, 30)))
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(latitude,25" in plan
    assert "PartitionFilters: [" in plan and "lower(state" in plan
    assert plan.count("WindowGroupLimit") == 2
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_state_scan_reports(spark, tmp_path):
    path = str(tmp_path / "inv")
    rows = spark.createDataFrame([("x", "New York"), ("y", "Ohio")], "bid string, state string")
    src.write_inventory(rows, path)
    with pytest.raises(Exception, match="already exists"):
        src.write_inventory(rows, path)
    df = src.read_inventory(spark, path)
    assert [r.bid for r in src.scan_states(df, ["new_york"]).collect()] == ["x"]
    for states in (["Utah"], ["Ohio", "Utah"]):
        with pytest.raises(FileNotFoundError, match="utah"):
            src.scan_states(df, states)
    with pytest.warns(UserWarning, match="utah"):
        assert [r.bid for r in src.scan_states(df, ["Ohio", "Utah"], on_missing="warn").collect()] == ["y"]
    with pytest.raises(FileNotFoundError):
        src.scan_states(df, ["Utah"], on_missing="warn")
    assert [r.state for r in src.unmatched_states(df, ["Utah", "Ohio"]).collect()] == ["utah"]


def test_conform_types_and_absent_columns(spark):
    raw = spark.createDataFrame([("1", "3.7", "x", "7", -82.0, 28.0)], "BID string, num_story string, sqft string, found_ht string, longitude double, latitude double")
    out = src.conform(raw)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in INVENTORY]
    r = out.first()
    assert (r.bid, r.num_story, r.sqft, r.found_ht, r.x, r.y, r.cbfips) == ("1", 3, None, 7.0, -82.0, 28.0, None)
    src.check_columns(out)
    with pytest.raises(ValueError, match="missing"):
        src.check_columns(out.drop("bid"))


def test_states_resolve_in_first_seen_order(spark):
    df = spark.createDataFrame([(0, "North_Carolina"), (1, "12"), (2, "fl"), (3, "north carolina"), (4, "Nowhere")], "pos int, s string")
    with pytest.raises(ValueError, match="Nowhere"):
        inv.resolve_states(df, "s", "pos")
    with pytest.warns(UserWarning, match="1 identifiers"):
        got = inv.resolve_states(df, "s", "pos", on_unknown="warn").collect()
    assert [(r.abbr, r.pos) for r in got] == [("NC", 0), ("FL", 1)]
    assert [r.s for r in inv.unresolved_states(df, "s").collect()] == ["Nowhere"]


def test_ordered_csv_round_trip(spark, tmp_path):
    df = spark.range(1000).select(F.format_string("B%04d", F.pmod(F.col("id") * 7, F.lit(1000))).alias("FltyId"), F.col("id").alias("v"))
    path = str(tmp_path / "out")
    exports.write_ordered_csv(df.repartition(5), path)
    parts = sorted(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part"))
    ids = [line.split(",")[0] for p in parts for line in p.read_text().splitlines()[1:]]
    assert ids == sorted(ids) and len(ids) == 1000


def test_summary_manifest_and_params(spark):
    df = spark.createDataFrame([("RES1", "a"), ("COM1", "a"), ("RES2", "b")], "Occ string, state string")
    assert tuple(inv.inventory_summary(df).first()) == (3, 2, 2)
    m = {r.state: r for r in inv.load_manifest(df, df.where("state = 'a'")).collect()}
    assert m["a"].complete and not m["b"].complete
    p = run_params({"storm_id": " al02 ", "storm_name": "beryl", "advisory": 9, "year": 2024, "flood_load_condition": "coastal_v",
                    "building_types": {"RES1": "y"}, "damage_categories": {">9": "a", ">6": "b", ">3": "c", ">1": "d"}})
    assert (p.storm_id, p.flood_load_condition, p.residential_types, p.labels) == ("AL02", "CoastalV", ["RES1"], ["A", "B", "C", "D"])
    assert p.output_name == "shelter_demand_output_BERYL_AL02_9_county.csv"
    with pytest.raises(ValueError, match="labels"):
        run_params().labels
    with pytest.raises(ValueError, match="unknown"):
        run_params({"nope": 1})


def test_merged_scan_matches_columns_by_name(spark, tmp_path):
    spark.createDataFrame([("a", 1.0)], "bid string, sqft double").write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([(2.0, "b", "z")], "sqft double, bid string, cbfips string").write.parquet(str(tmp_path / "y"))
    paths = [str(tmp_path / p) for p in ("x", "y", "x")]
    got = src.read_inventory(spark, paths).select("bid", "sqft", "cbfips").orderBy("bid").collect()
    assert [tuple(r) for r in got] == [("a", 1.0, None), ("b", 2.0, "z")]
    merged = src.read_inventory(spark, paths, merge=True)
    assert sorted(merged.columns) == ["bid", "cbfips", "sqft"] and merged.count() == 2
    with pytest.raises(ValueError, match="at least one"):
        src.read_inventory(spark, [])
