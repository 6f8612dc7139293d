from conftest import plan_of
from pyspark.sql import functions as F

from floodmark import Lookup, Raster
from floodmark.operators import raster
from floodmark.operators.joins import lookup

GRIDS = [
    Raster("a", -83.0, 29.0, 0.1, 0.1, 150, 70), Raster("b", -82.5, 28.95, 0.25, 0.2, 9, 130),
    Raster("m", 300_000.0, 3_200_000.0, 500.0, 400.0, 90, 200, is_projected_metre=True, zone=17),
    Raster("z", -120.0, 40.0, 1.0, 1.0, 3, 3), Raster("own", 400_000.0, 3_150_000.0, 900.0, 900.0, 50, 50, is_projected_metre=True),
]


def cells(spark):
    """Two thirds of the cells are wet, some negative, one repeated, and some lie outside of their grid."""
    rows = None
    for r in GRIDS:
        grid = spark.range((r.width + 3) * (r.height + 3)).select(
            F.lit(r.raster_id).alias("raster_id"), (F.col("id") / (r.width + 3)).cast("int").alias("row"), (F.col("id") % (r.width + 3)).alias("col"),
            F.when(F.col("id") % 3 == 0, F.lit(-9999.0)).otherwise(F.col("id") % 17 - 2).cast("double").alias("value"))
        rows = grid if rows is None else rows.unionByName(grid)
    return rows.unionByName(rows.where("row = 5 and col = 5").withColumn("value", F.lit(99.0)))


def points(spark):
    rows = spark.range(2000).select("id", (26.5 + F.col("id") % 83 / 25.0).alias("lat"), (-83.4 + F.col("id") % 97 / 41.0).alias("lon"))
    return rows.union(spark.sql("select 9001L, cast(null as double), -82D union all select 9003L, 39.5D, -119.5D"))


def values(df):
    return sorted((r.id, r.GridName, r.Depth_Grid) for r in df.collect())


def test_packed_cells_give_the_depths_of_the_cell_table(spark):
    c, p = cells(spark), points(spark)
    kept = lookup(raster.wet_cells(c, GRIDS).persist())
    packed = raster.pack_cells(c, GRIDS, 17)
    assert packed.lookup.bounded and packed.lookup.df.where(F.size("values") != 17 * 17).count() == 0
    want = values(raster.sample_depth(p, kept, GRIDS, "lat", "lon", wet_only=True))
    assert len(want) > 500
    for same in (packed, raster.PackedCells(Lookup(packed.lookup.df, False), 17)):
        assert values(raster.sample_depth(p, same, GRIDS, "lat", "lon", wet_only=True)) == want
    assert values(raster.sample_depth(p, packed, GRIDS, "lat", "lon")) == values(raster.sample_depth(p, kept, GRIDS, "lat", "lon"))
    counts = [sorted(map(tuple, raster.selectivity(p, x, GRIDS, "lat", "lon").collect())) for x in (kept, packed)]
    assert counts[0] == counts[1]
    wide = raster.pack_cells(c.where("raster_id = 'a'"), GRIDS)
    assert wide.lookup.df.count() * 1000 < c.where("raster_id = 'a'").count()


def test_inside_and_outside_are_all_pairs(spark):
    c, p = lookup(raster.wet_cells(cells(spark), GRIDS).persist()), points(spark)
    every = values(raster.sample_depth(p, c, GRIDS, "lat", "lon"))
    assert len(every) == p.count() * len(GRIDS)
    table = raster.headers(spark, GRIDS)
    for grids in (GRIDS * 2, table):
        inside = raster.sample_inside(p, c, grids, "lat", "lon")
        outside = raster.outside_grids(p, grids, "lat", "lon").select("id", "lat", "lon", F.explode("outside").alias("GridName"), F.lit(0.0).alias("Depth_Grid"))
        assert values(inside.unionByName(outside)) == every


def test_many_headers_stay_a_table(spark, monkeypatch):
    c, p = lookup(raster.wet_cells(cells(spark), GRIDS).persist()), points(spark)
    want = values(raster.sample_inside(p, c, GRIDS, "lat", "lon"))
    monkeypatch.setattr(raster, "KNOWN_HEADERS", 2)
    table = raster.headers(spark, GRIDS)
    assert raster.known_headers(spark, table) is None
    assert values(raster.sample_inside(p, c, table, "lat", "lon")) == want
    outside = raster.outside_grids(p, table, "lat", "lon").select(F.size("outside").alias("n")).agg(F.sum("n")).first()[0]
    assert outside + len(want) == p.count() * len(GRIDS)


def test_bitmaps_hold_exactly_the_wet_tiles(spark):
    c, p = cells(spark).where("col % 11 < 3 and row % 9 < 2"), points(spark)
    for tile in (1, 5):
        got = {(r.id, r.raster_id) for r in raster.wet_tiles(p, c, GRIDS, tile, "lat", "lon").collect()}
        wet = {(r.raster_id, r.row // tile, r.col // tile) for r in raster.wet_cells(c, GRIDS).where("value > 0").collect()}
        hits = raster.cell_hits(p, GRIDS, "lat", "lon").collect()
        assert got == {(r.id, r.raster_id) for r in hits if (r.raster_id, r.row // tile, r.col // tile) in wet}
    big = Raster("big", 0.0, 10.0, 0.001, 0.001, 9000, 9000)
    many = spark.range(1_000_000).select(F.lit("big").alias("raster_id"), (F.col("id") / 1000).cast("int").alias("row"), (F.col("id") % 1000 * 9).alias("col"), F.lit(1.0).alias("value"))
    maps = raster.wet_bitmaps(many, [big], 1)
    assert maps.agg(F.sum(F.bitmap_count("bits"))).first()[0] == 1_000_000
    assert maps.count() == -(-9000 * 1000 // 32768) and maps.agg(F.max(F.octet_length("bits"))).first()[0] == 4096


def test_headers_of_a_list_need_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    hits = raster.cell_hits(points(spark), GRIDS, "lat", "lon")
    assert not tracker.getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "BroadcastHashJoin" in plan_of(hits)
    first = raster.known_headers(spark, [Raster("x", 2.0, 1.0, 1, 1, 1, 1, zone=3), Raster("x", 1.0, 1.0, 1, 1, 1, 1), Raster("w", 1.0, 1.0, 1, 1, 1, 1)])
    assert [(r.raster_id, r.x0) for r in first] == [("w", 1.0), ("x", 1.0)]
    assert lookup(raster.headers(spark, GRIDS)).bounded


def test_grids_outside_in_both_forms(spark, monkeypatch):
    """Headers written into the plan and headers as an array name the same grids, missing and repeated positions too."""
    grids = [raster.Raster("a", -98.0, 31.0, 0.5, 0.5, 4, 4), raster.Raster("b", -97.0, 31.0, 0.5, 0.5, 4, 4),
             raster.Raster("m", 200_000.0, 3_450_000.0, 1000.0, 1000.0, 200, 200, is_projected_metre=True, zone=15)]
    points = spark.createDataFrame(
        [(1, 30.5, -97.6), (2, 30.2, -96.5), (3, None, -97.0), (4, 30.5, None), (5, 0.0, 0.0), (5, 0.0, 0.0), (6, 30.9, -94.5)],
        "id int, Latitude double, Longitude double")

    def named():
        return sorted((r.id, r.outside) for r in raster.outside_grids(points, grids).collect())

    written = named()
    monkeypatch.setattr(raster, "WRITTEN_OUT", 0)
    assert written == named()
    assert dict(written)[1] == ["b", "m"] and dict(written)[5] == ["a", "b", "m"] and dict(written)[3] == ["a", "b", "m"]
