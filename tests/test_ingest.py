import json
import os
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from floodmark.functions import geodesy
from floodmark.operators import geography as geo, inventory as inv
from floodmark.operators.counts import counted
from floodmark.plans.ingest import ingest_features
from floodmark.sources import features, inventory as src


def feature(bid, kind="Point", **props):
    return json.dumps({"type": "Feature", "properties": {"bid": bid, **props}, "geometry": {"type": kind, "coordinates": [-82.5, 28.0]}})


def landing(tmp_path):
    files = {
        "Delaware": [[feature("a", sqft=1500), "", feature("b")], [feature("c"), feature("d")[:50], '{"type":"Other"}']],
        "New_York": [[feature("e", "Polygon"), "[1]", "not json"]],
    }
    for state, parts in files.items():
        folder = tmp_path / "raw" / f"state={state}"
        folder.mkdir(parents=True)
        for i, lines in enumerate(parts):
            (folder / f"{i}.geojson").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "raw")


def test_every_line_is_kept_quarantined_or_counted(spark, tmp_path):
    raw = landing(tmp_path)
    lines = features.read_lines(spark, raw, place=True)
    done = ingest_features(lines, str(tmp_path / "inv"), str(tmp_path / "bad"))
    assert done.counts == {"lines": 9, "features": 4, "malformed": 2, "not_feature": 2, "blank": 1}
    stored = src.read_inventory(spark, str(tmp_path / "inv"))
    assert sorted((r.state, r.bid, r.sqft, r.longitude) for r in stored.collect()) == [
        ("Delaware", "a", 1500.0, -82.5), ("Delaware", "b", None, -82.5), ("Delaware", "c", None, -82.5), ("New_York", "e", None, None)]
    bad = sorted((r.state, r.problem, r.line, Path(r.file).name, r.block_start) for r in done.quarantined.collect())
    assert bad == [("Delaware", "malformed", feature("d")[:50], "1.geojson", 0), ("New_York", "malformed", "not json", "0.geojson", 0)]
    assert stored.count() + len(bad) + done.counts["blank"] + done.counts["not_feature"] == lines.count()
    both = ingest_features(lines, str(tmp_path / "inv2"), str(tmp_path / "bad2"), nonfeatures=True)
    assert sorted(r.problem for r in both.quarantined.collect()) == ["malformed", "malformed", "not_feature", "not_feature"]
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        ingest_features(lines, str(tmp_path / "inv"), str(tmp_path / "bad3"))
    with pytest.raises(ValueError, match="empty"):
        ingest_features(lines.where("line = ''"), str(tmp_path / "inv4"), str(tmp_path / "bad4"))
    assert not (tmp_path / "inv4").exists()
    # Lines that were not read from files have no place, and are kept apart all the same.
    made = spark.createDataFrame([("Ohio", feature("x")), ("Ohio", "{")], "state string, line string")
    assert ingest_features(made, str(tmp_path / "inv5"), str(tmp_path / "bad5")).quarantined.columns == ["state", "problem", "line"]


def test_manifest_of_files(spark, tmp_path):
    raw, root = landing(tmp_path), str(tmp_path / "inv")
    lines = features.read_lines(spark, raw, place=True)
    ingest_features(lines, root, str(tmp_path / "bad"))
    found = features.judged_features(lines, ("bid",), keep=("state", "_metadata")).where("problem is null")
    rows = {r.state: r for r in inv.file_manifest(found, src.read_inventory(spark, root)).collect()}
    for state, n, count in (("Delaware", 2, 3), ("New_York", 1, 1)):
        r, folder = rows[state], Path(raw) / f"state={state}"
        written = list((Path(root) / f"state={state}").glob("*.parquet"))
        assert (r.feature_count, r.processed_parquet_rows, r.complete, r.raw_lines_files) == (count, count, True, n)
        assert r.raw_lines_bytes == sum(os.path.getsize(f) for f in folder.iterdir())
        assert r.processed_parquet_bytes == sum(os.path.getsize(f) for f in written) and r.processed_parquet_files == len(written)
        assert r.raw_lines.removeprefix("file://").removeprefix("file:") == str(folder if n > 1 else folder / "0.geojson")
        assert r.raw_lines_modified.timestamp() == pytest.approx(max(os.path.getmtime(f) for f in folder.iterdir()), abs=1)
    assert (rows["Delaware"].name, rows["Delaware"].abbr, rows["Delaware"].fips, rows["New_York"].name) == ("Delaware", "DE", "10", "New York")
    # A state that lost a row, one without output, and a folder that names no state.
    part = src.read_inventory(spark, root).where("bid <> 'a' and state <> 'New_York'")
    rows = {r.state: r for r in inv.file_manifest(found, part).collect()}
    assert (rows["Delaware"].complete, rows["New_York"].complete, rows["New_York"].processed_parquet_rows) == (False, False, 0)
    (tmp_path / "raw" / "state=Nowhere").mkdir()
    (tmp_path / "raw" / "state=Nowhere" / "x").write_text(feature("z") + "\n")
    found = features.judged_features(features.read_lines(spark, raw), ("bid",), keep=("state", "_metadata")).where("problem is null")
    rows = {r.state: r for r in inv.file_manifest(found, part).collect()}
    assert (rows["Nowhere"].name, rows["Nowhere"].feature_count, rows["Nowhere"].complete) == (None, 1, False)


def test_file_counts_read_no_column(spark, tmp_path):
    root = str(tmp_path / "inv")
    src.write_inventory(src.conform(spark.range(10).select(F.lit("Ohio").alias("state"), F.col("id").cast("string").alias("bid"), F.lit(40.0).alias("latitude"), F.lit(-82.0).alias("longitude"))).withColumn("state", F.lit("Ohio")), root)
    files = inv.files_of(src.read_inventory(spark, root))
    assert "ReadSchema: struct<>" in files._jdf.queryExecution().toString().replace("\n", " ") or "ReadSchema: struct<>" in plan_of(files)
    assert files.agg(F.sum("rows")).first()[0] == 10


def test_morton_key(spark):
    def key(lat, lon):
        n = 1 << 26
        a, b = (min(n - 1, int((max(-h, min(h, c)) + h) * (n / (2 * h)) // 1)) for c, h in ((lat, 90.0), (lon, 180.0)))
        return sum(((a >> i & 1) << (2 * i + 1)) | ((b >> i & 1) << (2 * i)) for i in range(26))

    places = [(28.0, -82.5), (-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (95.0, 400.0), (-33.3333, 151.2)]
    df = spark.createDataFrame([*places, (None, 1.0), (float("nan"), 1.0)], "lat double, lon double").select("lat", geodesy.morton("lat", "lon").alias("k"))
    rows = [r.k for r in df.collect()]
    assert rows == [*[key(*p) for p in places], None, None]


def test_a_box_reads_fewer_row_groups_on_the_curve(spark, tmp_path):
    rows = spark.range(200_000).select(
        F.lit("Ohio").alias("state"), F.col("id").cast("string").alias("bid"),
        (38.0 + F.pmod(F.xxhash64("id"), F.lit(100_000)) / 20_000.0).alias("latitude"), (-85.0 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000)) / 20_000.0).alias("longitude"))
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(16 << 10))
    met, found = {}, {}
    box = (-83.2, 40.1, -83.0, 40.3)
    try:
        for order in ("curve", "latitude"):
            root = str(tmp_path / order)
            src.write_inventory(rows, root, order=order)
            met[order] = groups = 0
            for file in Path(root).rglob("*.parquet"):
                meta = pq.ParquetFile(file).metadata
                at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
                for g in range(meta.num_row_groups):
                    lat, lon = (meta.row_group(g).column(at[c]).statistics for c in ("latitude", "longitude"))
                    groups += 1
                    met[order] += lat.max >= box[1] and lat.min <= box[3] and lon.max >= box[0] and lon.min <= box[2]
            assert groups > 200
            found[order] = inv.in_bbox(spark.read.parquet(root), *box).count()
    finally:
        hadoop.unset("parquet.block.size")
    assert found["curve"] == found["latitude"] == inv.in_bbox(rows, *box).count() > 100
    assert met["curve"] * 2 <= met["latitude"]
    with pytest.raises(ValueError, match="order"):
        src.write_inventory(rows, str(tmp_path / "x"), order="depth")


def jobs(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_rates_come_from_the_job_that_writes(spark, tmp_path):
    pred = spark.range(1000).select(F.col("id").cast("string").alias("fltyid"))
    xwalk = pred.where("fltyid % 4 <> 0").withColumn("cbfips", F.lit("12057"))
    rows, counts = geo.attach_block_counted(pred, xwalk)
    plain = geo.attach_block(pred, xwalk)
    n = jobs(spark, "counted", lambda: rows.write.parquet(str(tmp_path / "a")))
    assert n == jobs(spark, "plain", lambda: plain.write.parquet(str(tmp_path / "b")))
    assert tuple(counts.row(rows).first()) == (750, 1000, 75.0) == tuple(geo.match_rate(plain, "cbfips").first())
    none, counts = geo.attach_svi_counted(spark.createDataFrame([], "FIPS string"), spark.createDataFrame([("1", 2.0)], "FIPS string, E_TOTPOP double"))
    none.write.parquet(str(tmp_path / "c"))
    assert counts.get() == {"matched": 0, "total": 0} and counts.match_pct() == 0


def test_strict_checks_after_the_write(spark, tmp_path):
    inventory = spark.createDataFrame([("Ohio", 1), ("New_York", 2), ("New_York", 3)], "state string, bid int")
    kept, counts = src.scan_states_counted(inventory, ["new york", "Ohio"])
    assert kept.count() == 3 and counts.require_all() == {"new_york": 2, "ohio": 1}
    kept, counts = src.scan_states_counted(inventory, ["Texas", "Ohio"])
    kept.write.parquet(str(tmp_path / "a"))
    with pytest.raises(LookupError, match="texas"):
        counts.require_all()
    tokens = spark.createDataFrame([("FL",), ("12",), ("Atlantis",)], "token string")
    rows, counts = inv.resolve_states_counted(tokens, "token")
    assert [r.abbr for r in rows.collect()] == ["FL", "FL"]
    with pytest.raises(LookupError, match="1 rows are unknown"):
        counts.require_none("unknown")
    seen, counts = counted(tokens, {"all": F.count(F.lit(1))})
    assert seen.count() == 3 and counts.require_none.__self__.get() == {"all": 3}


def test_levels_of_one_frequency_table(spark):
    df = spark.range(3000).select(
        F.concat(F.when(F.col("id") % 3 < 2, "12").otherwise("13"), F.lpad((F.col("id") % 5).cast("string"), 3, "0"), F.lpad((F.col("id") % 7).cast("string"), 6, "0"), F.lit("1001")).alias("cbfips"),
        F.when(F.col("id") % 50 > 0, F.col("id").cast("string")).alias("fltyid"), (F.col("id") % 11).cast("double").alias("depth_grid"),
        (F.col("id") % 101).cast("double").alias("bldgdmgpct"), (F.col("id") % 997 * 10).cast("double").alias("bldglossusd"))
    labels = ["D", "M", "N", "A"]
    rows = geo.geo_rollup_levels(df, labels)
    got = {(r.level, r.FIPS): r for r in rows.collect()}
    for level in ("tract", "county"):
        want = geo.geo_rollup(df, level, labels)
        for r in want.collect():
            assert {c: got[level, r.FIPS][c] for c in want.columns if c not in ("State_FIPS", "County_FIPS")} == {c: r[c] for c in want.columns if c not in ("State_FIPS", "County_FIPS")}
    nation = got["nation", ""]
    assert nation.Total_Num_Building == df.where("fltyid is not null").count() and nation.Building_Damage_Pct_50th == df.selectExpr("median(bldgdmgpct)").first()[0]
    assert {f for lvl, f in got if lvl == "state"} == {"12", "13"}
    assert {r.level for r in geo.geo_rollup_levels(df, labels, ["state", "nation"], quantiles=False).collect()} == {"state", "nation"}
    with pytest.raises(ValueError, match="levels"):
        geo.geo_rollup_levels(df, labels, ["planet"])
    # One exchange moves the buildings, whatever the number of levels, and it is keyed by value too.
    plan = plan_of(geo.level_counts(geo.value_counts(df, "tract"), ["tract", "county", "state", "nation"]))
    assert plan.count("Scan") + plan.count("Range (") == 1 and plan.count("Exchange hashpartitioning") == 2 and "value#" in plan.split("Exchange hashpartitioning")[1]


def test_rows_of_one_place_are_spread(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.lit("Ohio").alias("state"), F.col("id").cast("string").alias("bid"),
        F.when(F.col("id") % 3 > 0, 40.0).alias("latitude"), F.when(F.col("id") % 3 > 0, -82.0).alias("longitude"))
    root = str(tmp_path / "inv")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        src.write_inventory(rows, root)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in Path(root).rglob("*.parquet")]
    assert sum(sizes) == 40_000 and len(sizes) >= 6 and max(sizes) < 12_000
