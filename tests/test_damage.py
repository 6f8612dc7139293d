from dataclasses import replace

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from catalog import fixtures
from floodmark import Lookup, Lookups, Raster, assess
from floodmark.operators import damage
from floodmark.operators.raster import cell_hits, cell_index, sample_depth, wet_tiles
from floodmark.plans.assess import DEFAULT_MAP
from floodmark.sources import lookups as src

BUILDINGS = "FltyId string, Occ string, Cost string, Area string, NumStories string, FoundationType string, FirstFloorHt string, ContentCost string, Latitude double, Longitude double"


def wide(spark, key, base):
    cols = ", ".join(f"least(100D, greatest(0D, {base} + {k} * 3D)) as {c}" for k, c in damage.DEPTH_COLUMNS.items())
    return spark.sql(f"select '{key}' as SpecificOccupId, '7' as DDF_ID, {cols}")


@pytest.fixture(scope="module")
def lookups(spark):
    curves = None
    for name, key, base in (("building_coastal_a", "R11N", 10), ("content_coastal_a", "R11N", 20), ("building_default", "C1LN", 5),
                            ("content_default", "C1LN", 6), ("inventory_default", "C1LN", 8)):
        long = damage.curves_long(src.conform_curves(wide(spark, key, base), name, "SpecificOccupId"), ["curve_set", "curve_key"], ["ddf_id"])
        curves = long if curves is None else curves.unionByName(long)
    return Lookups.of(
        curves,
        spark.createDataFrame([("RES1NBSG1", 4.0, 1.0, 2.0), ("COM1NBSG1", 2.0, 0.0, 0.0)], "DebrisID string, Finishes double, Structure double, Foundation double"),
        spark.createDataFrame([("RES14", 30, 60), ("COM14", 10, 20)], "RestFnID string, Min_Restor_Days int, Max_Restor_Days int"),
        spark.createDataFrame([("COM1", 53.0, 13.0)], "Occupancy string, AnnualSalesPerSqFt double, BusinessInvPctofSales double"),
        src.library_packed(wide(spark, "105", 50).withColumn("Occupancy", F.lit("RES1")), "building", "SpecificOccupId"),
    )


@pytest.fixture(scope="module")
def buildings(spark):
    return spark.createDataFrame([
        ("T1", "RES1", "150000", "1500", "1", "7", "1.0", "75000", 28.0, -82.5),
        ("T2", "COM1", "1000.9", "100", "1", "7", "1.0", "-1", 28.0, -82.5),
        ("T3", "RES1", "150000", "1500", "1", "7", "", "75000", 28.0, -82.5),
        ("T4", "RES1", "abc", "1500", "1", "7", "1.0", "75000", 28.0, -82.5),
        ("T5", "EDU1", "100", "1500", "1", "7", "1.0", "", 28.0, -82.5),
        ("T6", "RES1", "100", "1500", "1", "7", "1.0", "", 10.0, -82.5),
    ], BUILDINGS)


GRID = Raster("g.tif", -83.0, 29.0, 0.1, 0.1, 20, 20)


def cells(spark, value=3.5, name="g.tif"):
    return spark.range(400).select(F.lit(name).alias("raster_id"), (F.col("id") / 20).cast("int").alias("row"), (F.col("id") % 20).alias("col"), F.lit(value).alias("value"))


def test_assess_rows(spark, buildings, lookups):
    out = {r.FltyId: r for r in assess(buildings, cells(spark), [GRID], lookups).collect()}
    t1 = out["T1"]
    # depth 2.5 in the structure, between 16 % and 19 %
    assert (t1.Depth_Grid, t1.Depth_in_Struc, t1.flExp, t1.SOID, t1.BDDF_ID) == (3.5, 2.5, 1, "R11N", "7")
    assert t1.BldgDmgPct == pytest.approx(17.5) and t1.BldgLossUSD == pytest.approx(26250)
    assert t1.ContentCostUSD == 75000 and t1.ContentLossUSD == pytest.approx(75000 * 0.275)
    assert (t1.InventoryCostUSD, t1.IDDF_ID, t1.InventoryLossUSD, t1.DebrisID) == (0, "0", 0, "RES1NBSG1")
    assert (t1.Debris_Fin, t1.Debris_Tot, t1.Restor_Days_Min, t1.Restor_Days_Max) == (6.0, 10.5, 30, 60)
    t2 = out["T2"]
    assert t2.ContentCostUSD == 1000.0 and t2.InventoryCostUSD == pytest.approx(53 * 13 * 100 / 100)
    assert t2.InventoryLossUSD == pytest.approx(689 * 0.155) and t2.BldgLossUSD == pytest.approx(125)
    assert (out["T3"].status, out["T3"].Depth_in_Struc, out["T3"].SOID) == ("INCOMPLETE", -99999.0, None)
    assert out["T4"].status == "ROW_ERROR"
    t5 = out["T5"]
    assert (t5.status, t5.BDDF_ID, t5.BldgLossUSD, t5.flExp, t5.ContentCostUSD) == ("UNMATCHED", "Unmatched", None, 1, 0.0)
    t6 = out["T6"]
    assert (t6.flExp, t6.BldgLossUSD, t6.DebrisID, t6.Debris_Tot, t6.Restor_Days_Min, t6.BDDF_ID) == (0, 0, None, None, 0, "0")
    stats = damage.run_stats(assess(buildings, cells(spark), [GRID], lookups)).first()
    assert (stats.rows, stats.row_errors, stats.flooded, stats.unmatched) == (6, 1, 2, 1)


def test_unbounded_lookups_give_the_same_rows(spark, buildings, lookups):
    shuffled = Lookups(**{f: Lookup(getattr(lookups, f).df, False) for f in ("curves", "debris", "restoration", "econ", "library")})
    wet = Lookup(cells(spark).select("raster_id", F.col("row").cast("bigint").alias("row"), "col", "value"), False)
    a = assess(buildings, cells(spark), [GRID], lookups)
    b = assess(buildings, wet, [GRID], shuffled)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert "BroadcastHashJoin" in plan_of(a) and "Python" not in plan_of(a)


def test_csv_and_parquet_inputs_agree(spark, buildings, lookups, tmp_path):
    buildings.write.option("header", True).csv(str(tmp_path / "c"))
    buildings.selectExpr("FltyId", "Occ", "Cost", "cast(Area as double) Area", "cast(NumStories as int) NumStories", "cast(FoundationType as int) FoundationType",
                         "try_cast(FirstFloorHt as double) FirstFloorHt", "ContentCost", "Latitude", "Longitude").write.parquet(str(tmp_path / "p"))
    text = spark.read.option("header", True).csv(str(tmp_path / "c"))
    typed = spark.read.parquet(str(tmp_path / "p"))
    cols = ["FltyId", *damage.fv.PREDICTION_COLUMNS, "status"]
    a, b = (sorted(map(str, assess(d, cells(spark), [GRID], lookups).select(cols).collect())) for d in (text, typed))
    assert a == b


def test_depth_edges_and_user_curve(spark, lookups):
    df = spark.createDataFrame([(-4.0,), (24.0,), (-0.5,), (0.0,), (23.5,)], "d double").withColumn("u", F.lit("105"))
    k = F.floor("d").cast("int")
    rows = damage.match_curve(df, lookups.curves, "building", F.lit("coastal_a"), F.lit("R11N"), k)
    got = {r.d: r.p for r in rows.select("d", (damage.interp_damage("_building_lo", "_building_hi", "d") * 100).alias("p")).collect()}
    assert got == pytest.approx({-4.0: 0.0, 24.0: 82.0, -0.5: 8.5, 0.0: 10.0, 23.5: 80.5})
    user = damage.override_curve(rows, lookups.library, "building", "u", k)
    r = {x.d: x for x in user.collect()}
    assert r[0.0]._building_lo == 50.0 and r[0.0]._building_id == "105" and r[24.0]._building_hi == r[24.0]._building_lo == 100.0
    qc = spark.createDataFrame([("1", "RES1", "105"), ("2", "COM1", " 105 "), ("3", "RES1", "9"), ("4", "RES1", "")], "id string, occ string, c string")
    found = {x.id: x.issue for x in damage.curve_qc(qc, lookups.library, "building", "c", "occ", "id").collect()}
    assert found == {"2": "OCCUPANCY_MISMATCH", "3": "UNKNOWN_CURVE"}


def test_projected_grid(spark, buildings, lookups):
    # A 10 x 10 grid of 100 m cells in zone 17 around the point.
    grid = Raster("utm.tif", 352000.0, 3098600.0, 100.0, 100.0, 10, 10, is_projected_metre=True)
    tiny = cells(spark, name="utm.tif").where("row < 10 and col < 10")
    r = assess(buildings.where("FltyId = 'T1'"), tiny, [grid], lookups).first()
    assert r.Depth_Grid == 3.5 and r.BldgDmgPct > 0


def test_sampling_rules(spark):
    pts = spark.createDataFrame([("in", 28.95, -82.95), ("nodata", 28.85, -82.95), ("nan", 28.75, -82.95), ("west", 28.95, -83.05), ("far", 0.0, 0.0)], "id string, lat double, lon double")
    c = spark.createDataFrame([("g.tif", 0, 0, 2.0), ("g.tif", 1, 0, -9999.0), ("g.tif", 2, 0, float("nan"))], "raster_id string, row int, col int, value double")
    got = {r.id: r.Depth_Grid for r in sample_depth(pts, c, [GRID], "lat", "lon").collect()}
    assert got == {"in": 2.0, "nodata": 0.0, "nan": 0.0, "west": 0.0, "far": 0.0}
    cut = {r.id: r.Depth_Grid for r in sample_depth(pts, c, [GRID], "lat", "lon", truncate=True).collect()}
    assert cut["west"] == 2.0
    two = sample_depth(pts, c, [GRID, replace(GRID, raster_id="h.tif")], "lat", "lon")
    assert two.count() == 10 and two.where("GridName = 'h.tif' and Depth_Grid <> 0").count() == 0
    assert sorted(r.id for r in wet_tiles(pts, c, [GRID], 1, "lat", "lon").collect()) == ["in"]
    assert cell_index(pts, [GRID], "lat", "lon").where("inside").count() == 3


def test_curve_files(spark, tmp_path):
    header = "﻿SpecificOccupId," + ",".join(damage.DEPTH_COLUMNS.values()) + ",DDF_ID,SortOrder"
    first = "R11N ," + ",".join(str(i) for i in range(29)) + ",9,2"
    second = "R11N ," + ",".join("1" for _ in range(29)) + ",5,1"
    (tmp_path / "c.csv").write_text("\n".join([header, first, second]), encoding="utf-8")
    rows = src.load_curves(spark, str(tmp_path / "c.csv"), "building_default").collect()
    assert len(rows) == 29 and {(r.curve_key, r.ddf_id, r.lo, r.hi) for r in rows} == {("R11N", "5", 1.0, 1.0)}


def test_field_map_is_checked(spark, buildings):
    with pytest.raises(ValueError, match="exactly"):
        damage.apply_field_map(buildings, {"OCC": "Occ"})
    with pytest.raises(ValueError, match="required"):
        damage.flag_incomplete(buildings, damage.field_map(OCC="Occ"))


def test_repeated_lookup_keys_do_not_repeat_buildings(spark, buildings, lookups):
    twice = Lookups.of(*[
        getattr(lookups, f).df.unionByName(getattr(lookups, f).df) for f in ("curves", "debris", "restoration", "econ", "library")
    ])
    doubled = cells(spark).unionByName(cells(spark, 2.0))
    a = assess(buildings, cells(spark), [GRID], lookups)
    b = assess(buildings, doubled, [GRID], twice)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    other = lookups.debris.df.withColumn("Finishes", F.lit(9.0))
    first = Lookups.of(lookups.curves.df, other.unionByName(lookups.debris.df), lookups.restoration.df, lookups.econ.df)
    assert {r.DebrisID: r.Finishes for r in first.debris.df.collect()} == {"RES1NBSG1": 4.0, "COM1NBSG1": 2.0}


def test_hits_equal_the_pairs_inside(spark):
    grids = [Raster("a", -83.0, 29.0, 0.1, 0.1, 20, 20), Raster("b", -82.0, 28.5, 0.3, 0.2, 30, 40), Raster("far", 10.0, 50.0, 1.0, 1.0, 5, 5),
             Raster("m", 300_000.0, 3_200_000.0, 500.0, 500.0, 400, 400, is_projected_metre=True, zone=17), Raster("own", 250_000.0, 3_100_000.0, 900.0, 900.0, 300, 300, is_projected_metre=True)]
    points = spark.range(4000).select("id", (F.lit(20.0) + F.col("id") % 61 / 5).alias("Latitude"), (F.lit(-90.0) + F.col("id") % 97 / 8).alias("Longitude"))
    for truncate in (False, True):
        pairs = cell_index(points, grids, truncate=truncate).where("inside").select("id", "raster_id", "row", "col")
        hits = cell_hits(points, grids, truncate=truncate).select("id", "raster_id", "row", "col")
        assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, pairs.collect()))
        assert {r.raster_id for r in hits.collect()} == {"a", "b", "m", "own"}
    table = spark.createDataFrame([(g.raster_id, g.x0, g.y0, g.pw, g.ph, g.width, g.height) for g in grids[:3]], "raster_id string, x0 double, y0 double, pw double, ph double, width int, height int")
    assert cell_hits(points, table).count() == cell_hits(points, grids[:3]).count()
    assert "NestedLoop" not in plan_of(hits) and "Cartesian" not in plan_of(hits)


def test_one_hot_key_is_split(spark):
    """10^5 rows of one key meet an unbounded table: adaptive execution splits the key's partition."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 200_000, 1, 16).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
        out = Lookup(spark.range(1000).select(F.col("id").alias("k"), F.lit(2).alias("w")), False).join(rows, ["k"])
        assert out.groupBy("w").count().where("w = 2").first()["count"] == 100_500
        out.collect()
        assert "skew=true" in plan_of(out)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_a_library_beyond_the_bounds_is_not_broadcast(spark, lookups):
    b = spark.createDataFrame(
        [(f"A{i}", "RES1", "100", "10", "1", "7", "0", "50", 28.0, -82.5, user) for i, user in enumerate([" 105 ", "", None, "9"])],
        BUILDINGS + ", Curve string")
    mapping = {**DEFAULT_MAP, "BDDF_ID": "Curve"}
    large = replace(lookups, library=Lookup(lookups.library.df, False))
    far, near = (assess(b, cells(spark), [GRID], k, mapping=mapping) for k in (large, lookups))
    assert sorted(map(str, far.collect())) == sorted(map(str, near.collect()))
    assert {r.FltyId: r.BDDF_ID for r in far.collect()} == {"A0": "105", "A1": "7", "A2": "7", "A3": "7"}
    small = spark.createDataFrame([("a", [1.0])], "k string, v array<double>")
    rows = spark.createDataFrame([("a", 1)], "k string, n int")
    assert "Broadcast" not in plan_of(Lookup(small, False).join(rows, ["k"]))


def test_the_status_is_worked_out_once_and_one_lookup_alone(spark, buildings, lookups, monkeypatch):
    typed = damage.typed_fields(buildings, DEFAULT_MAP)
    assert {r.FltyId: r.status for r in typed.collect()} == {"T1": "OK", "T2": "OK", "T3": "INCOMPLETE", "T4": "ROW_ERROR", "T5": "OK", "T6": "OK"}
    held = [line for line in plan_of(typed.where("status = 'OK'")).splitlines() if "Filter" in line]
    assert len(held) == 1 and "CASE WHEN" not in held[0] and "trim" not in held[0]
    made = []
    monkeypatch.setattr(fixtures, "kept", lambda df: made.append(df) or Lookup(df, True))
    tables = fixtures.Tables(spark, "/no/such/folder")
    tables.econ = lookups.econ.df
    assert tables.lookup("econ").df.count() == 1 and len(made) == 1
