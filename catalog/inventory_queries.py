"""Scans, filters, text columns, dedup, summaries and ingest."""

from pyspark.sql import functions as F, types as T

from floodmark import run_params
from floodmark.functions import fixed_values as fv, geodesy, text
from floodmark.operators import inventory as inv
from floodmark.operators.planning import latest_advisories
from floodmark.plans.ingest import features_to_inventory, ingest_features
from floodmark.sinks import exports
from floodmark.schema import INVENTORY
from floodmark.session import work_folder
from floodmark.sources import features, inventory as src, predictions

from .fixtures import STATE_NAMES, pick
from .registry import query

BOX = (-85.0, 25.0, -81.0, 30.0)
BOX_SQL = "latitude between 25 and 30 and longitude between -85 and -81"
ENGINE_SQL = """
    bid as FltyId, upper(split_part(occtype, '-', 1)) as Occ, val_struct as Cost, sqft as Area, num_story as NumStories,
    cast(case when upper(trim(found_type)) in ('S','SLAB','SLAB ON GRADE','7') then 7
      when upper(trim(found_type)) in ('C','CRAWL','CRAWLSPACE','CRAWL SPACE','5','F','I','W') then 5
      when upper(trim(found_type)) in ('B','BASEMENT','4') then 4
      when upper(trim(found_type)) in ('P','PIER','PILE','PILES','PIER/PILE','2') then 2 else 7 end as int) as FoundationType,
    found_ht as FirstFloorHt, coalesce(val_cont, 0.0::double) as ContentCost, latitude as Latitude, longitude as Longitude,
    case when regexp_replace(coalesce(cbfips, ''), '[^0-9]', '', 'g') = '' then null
      else lpad(regexp_replace(cbfips, '[^0-9]', '', 'g'), 15, '0') end as cbfips"""
NOT_NULL_SQL = " and ".join(f"{c} is not null" for c in inv.REQUIRED)
TIES = (
    "occtype, val_cont nulls last, sqft, num_story, found_type, found_ht, cbfips nulls last, latitude, longitude, state, "
    "ground_elv, pop2pmo65, pop2pmu65, pop2amo65, pop2amu65"
)
#: SQL text of the cleaned engine input, used as a WITH entry.
BUILDING_CTE = f"""building AS (select {ENGINE_SQL} from (
    select *, row_number() over (partition by bid order by val_struct desc nulls last, {TIES}) as rn
    from inventory where {BOX_SQL} and {NOT_NULL_SQL}) a where rn = 1)"""


def buildings(t):
    return inv.engine_input(inv.in_bbox(t.inventory, *BOX))


@query("q_bbox_filter", f"select bid, latitude, longitude from inventory where {BOX_SQL}", ("inventory",))
def _(t):
    return inv.in_bbox(t.inventory, *BOX).select("bid", "latitude", "longitude")


@query("q_require_not_null", f"select bid, occtype, val_struct, sqft from inventory where {NOT_NULL_SQL}", ("inventory",))
def _(t):
    return inv.require(t.inventory).select("bid", "occtype", "val_struct", "sqft")


@query("q_fill_defaults", """select bid, coalesce(val_struct, 0.0::double) as val_struct, coalesce(sqft, 0.0::double) as sqft,
    coalesce(num_story, 1.0::double) as num_story, coalesce(found_ht, 1.0::double) as found_ht, coalesce(val_cont, 0.0::double) as val_cont
    from inventory""", ("inventory",))
def _(t):
    return inv.fill_defaults(t.inventory).select("bid", "val_struct", "sqft", "num_story", "found_ht", "val_cont")


@query("q_norm_occ", "select occtype, upper(split_part(occtype, '-', 1)) as occ, count(*) as n from inventory group by all", ("inventory",))
def _(t):
    return t.inventory.groupBy("occtype", text.norm_occ("occtype").alias("occ")).agg(F.count("*").alias("n"))


@query("q_foundation_code", """select found_type, cast(case when upper(trim(found_type)) in ('S','SLAB','SLAB ON GRADE','7') then 7 when upper(trim(found_type)) in ('C','CRAWL','CRAWLSPACE','CRAWL SPACE','5','F','I','W') then 5 when upper(trim(found_type)) in ('B','BASEMENT','4') then 4 when upper(trim(found_type)) in ('P','PIER','PILE','PILES','PIER/PILE','2') then 2 else 7 end as int) as code, count(*) as n from inventory group by all""", ("inventory",))
def _(t):
    return t.inventory.groupBy("found_type", text.foundation_code("found_type").alias("code")).agg(F.count("*").alias("n"))


@query("q_norm_fips", """select cbfips, case when regexp_replace(cbfips, '[^0-9]', '', 'g') = '' then null
    else lpad(regexp_replace(cbfips, '[^0-9]', '', 'g'), 15, '0') end as fips, count(*) as n from inventory group by all""", ("inventory",))
def _(t):
    return t.inventory.groupBy("cbfips", text.norm_fips("cbfips").alias("fips")).agg(F.count("*").alias("n"))


@query("q_content_default", "select bid, val_struct, coalesce(val_cont, 0.0::double) as ContentCost from inventory", ("inventory",))
def _(t):
    return t.inventory.select("bid", "val_struct", F.coalesce("val_cont", F.lit(0.0)).alias("ContentCost"))


@query("q_flood_alias", """select raw, case lower(trim(coalesce(raw, ''))) when 'riverine' then 'HazardRiverine' when 'coastala' then 'CAE' when 'cae' then 'CAE'
      when 'coastalv' then 'V' when 'v' then 'V' when 've' then 'V' else trim(coalesce(raw, '')) end as code,
    case lower(regexp_replace(trim(coalesce(raw, 'CoastalA')), '[\\s_-]+', '', 'g')) when 'coastala' then 'CoastalA' when 'coastalv' then 'CoastalV'
      when 'riverine' then 'Riverine' else trim(coalesce(raw, 'CoastalA')) end as condition, count(*) as n
    from spelled group by all""", extra=f"""spelled AS (select nullif({pick(' CoastalA,cae,coastal_v,VE,v ,Riverine,coastal - a,Lake,', 'c_custkey % 9')}, '') as raw from customer)""")
def _(t):
    words = t.spark.sql(
        f"select nullif({pick(' CoastalA,cae,coastal_v,VE,v ,Riverine,coastal - a,Lake,', 'c_custkey % 9')}, '') as raw from {{c}}", c=t.customer)
    return words.groupBy(
        "raw", text.norm_flood_class("raw").alias("code"), text.norm_flood_condition("raw").alias("condition")
    ).agg(F.count("*").alias("n"))


_STATE_VALUES = ", ".join(f"('{n}', '{a}', '{f}')" for n, a, f in fv.STATES)
_STATE_KEY_SQL = """case when regexp_full_match(trim(token), '[0-9]{2}') then trim(token) when regexp_full_match(trim(token), '[A-Za-z]{2}') then upper(trim(token))
    else lower(regexp_replace(trim(replace(replace(token, '_', ' '), '-', ' ')), '\\s+', ' ', 'g')) end"""


@query("q_resolve_states", f"""select s.fips, s.abbr, s.name, replace(s.name, ' ', '_') as path_name, min(pos) as pos
    from keyed join states s on key in (s.fips, s.abbr, lower(s.name)) group by all""", ("state_token",),
    extra=f"states(name, abbr, fips) AS (values {_STATE_VALUES}), keyed AS (select pos, {_STATE_KEY_SQL} as key from state_token)")
def _(t):
    return inv.resolve_states(t.state_token, "token", "pos", on_unknown="warn")


@query("q_unresolved_states", """select distinct token from keyed where not exists (select 1 from states s where key in (s.fips, s.abbr, lower(s.name)))""",
    ("state_token",), extra=f"states(name, abbr, fips) AS (values {_STATE_VALUES}), keyed AS (select token, {_STATE_KEY_SQL} as key from state_token)")
def _(t):
    return inv.unresolved_states(t.state_token, "token")


@query("q_storm_id", """select o_orderkey, case when regexp_full_match(s, '[A-Z]{2}[0-9]{1,2}([0-9]{2,4})?') then
      substr(s, 1, 2) || lpad(regexp_extract(s, '^([A-Z]{2})([0-9]{1,2})([0-9]{2,4})?$', 2), 2, '0') ||
      case length(regexp_extract(s, '^([A-Z]{2})([0-9]{1,2})([0-9]{2,4})?$', 3)) when 0 then cast(year as varchar) when 4 then regexp_extract(s, '^([A-Z]{2})([0-9]{1,2})([0-9]{2,4})?$', 3)
        else '20' || regexp_extract(s, '^([A-Z]{2})([0-9]{1,2})([0-9]{2,4})?$', 3) end
    else s || cast(year as varchar) end as storm from (select *, upper(trim(storm_id)) as s from storm) a""", ("storm",))
def _(t):
    return t.storm.select("o_orderkey", text.norm_storm_id("storm_id", F.col("year")).alias("storm"))


@query("q_raster_name", """select name, year, adv, upper(trim(storm_name)) || '_' || year as event, count(*) as n
    from (select *, upper(trim(storm_name)) || '_' || year || '_adv' || adv || '_e10_ResultMaskRaster.tif' as name from storm) a group by all""", ("storm",))
def _(t):
    named = t.storm.select(text.raster_name("storm_name", "year", "adv").alias("name"))
    parsed = named.withColumn("p", text.parse_raster_name("name"))
    return parsed.groupBy("name", "p.year", "p.adv", "p.event").agg(F.count("*").alias("n"))


@query("q_name_variants", """select distinct adv_text, id_text from (
      select unnest(list_distinct([cast(adv as varchar), lpad(cast(adv as varchar), 3, '0')])) as adv_text, id_text from (
        select adv, unnest(list_distinct(['AL' || lpad(cast(adv as varchar), 2, '0') || substr(cast(year as varchar), 3), 'AL' || lpad(cast(adv as varchar), 2, '0') || year])) as id_text from storm) a) b""", ("storm",))
def _(t):
    full = F.concat(F.lit("AL"), F.lpad(F.col("adv").cast("string"), 2, "0"), F.col("year").cast("string"))
    ids = t.storm.select("adv", F.explode(text.storm_id_variants(full, F.col("year"))).alias("id_text"))
    return ids.select(F.explode(text.advisory_variants("adv")).alias("adv_text"), "id_text").distinct()


_RANGE = "case p_partkey % 5 when 0 then p_size || ' - ' || (p_size + 10) when 1 then '0.' || p_size when 2 then 'about ' || p_size || '%' when 3 then 'n/a' else null end"


@query("q_parse_range_pct", f"""select p_partkey, case when num > 1 then num / 100 else num end as pct
    from (select p_partkey, try_cast(nullif(regexp_extract({_RANGE}, '([\\d.]+)', 1), '') as double) as num from part) a""")
def _(t):
    parts = t.part.selectExpr("p_partkey", f"{_RANGE.replace('p_size ||', 'cast(p_size as string) ||')} as raw")
    return parts.select("p_partkey", text.parse_range_pct("raw").alias("pct"))


@query("q_clean_text", "select p_partkey, lower(regexp_replace(trim('  ' || p_name || '   ' || p_brand || ' '), '\\s+', ' ', 'g')) as label from part")
def _(t):
    raw = F.concat(F.lit("  "), "p_name", F.lit("   "), "p_brand", F.lit(" "))
    return t.part.select("p_partkey", text.clean_text(raw).alias("label"))


@query("q_building_key", """select bid, sha256(bid || '|' || cast(cast(round(latitude * 1000) as bigint) as varchar) || '|' || cast(cast(round(longitude * 1000) as bigint) as varchar)) as key, count(*) as n
    from inventory group by all""", ("inventory",))
def _(t):
    milli = [F.round(F.col(c) * 1000).cast("bigint") for c in ("latitude", "longitude")]
    return t.inventory.groupBy("bid", text.building_key("bid", *milli).alias("key")).agg(F.count("*").alias("n"))


@query("q_inventory_dedup", "select * from building", ("inventory",), extra=BUILDING_CTE)
def _(t):
    return buildings(t)


PREDICTION_COLUMNS = [
    "fltyid", "occ", "cost", "depth_grid", "depth_in_struc", "bldgdmgpct", "bldglossusd", "event", "adv", "flc", "state", "county_fips5",
    "cbfips", "pop2pmo65", "pop2pmu65", "pop2amo65", "pop2amu65", "o65disable", "u65disable",
]


def first_prediction_sql(keys: list[str], value: str) -> str:
    """Whole rows: the highest value per key, equal ones in order of all other columns."""
    rest = ", ".join(f"{c} nulls last" for c in PREDICTION_COLUMNS if c not in (*keys, value))
    return (f"select * exclude (rn) from (select *, row_number() over (partition by {', '.join(keys)} order by {value} desc nulls last, {rest}) as rn "
            "from prediction) a where rn = 1")


@query("q_prediction_dedup", first_prediction_sql(["fltyid"], "bldgdmgpct"), ("prediction",))
def _(t):
    return inv.dedup_predictions(t.prediction)


@query("q_keep_types", "select fltyid, occ, cost from prediction where occ in ('RES1', 'RES3A', 'RES4')", ("prediction",))
def _(t):
    flags = {"RES1": "Y", "RES2": "N", "RES3A": "y", "RES4": "Y"}
    return inv.keep_types(t.prediction, flags).select("fltyid", "occ", "cost")


@query("q_summary", """select count(*) as row_count, count(*) filter (where upper(split_part(occtype, '-', 1)) like 'RES%') as residential_count,
    count(distinct state) as source_state_count from inventory""", ("inventory",))
def _(t):
    return inv.inventory_summary(t.inventory.withColumn("Occ", text.norm_occ("occtype")))


@query("q_scan_merge", """select l_returnflag as flag, count(*) as n, count(extra) as n_extra, round(sum(l_quantity), 4) as qty
    from (select l_returnflag, l_quantity, null as extra from lineitem union all select o_orderstatus, null, o_orderkey from orders) a group by all""")
def _(t):
    both = src.read_inventory(t.spark, [f"{t.dir}/lineitem.parquet", f"{t.dir}/orders.parquet"], merge=True)
    return both.groupBy(F.coalesce("l_returnflag", "o_orderstatus").alias("flag")).agg(
        F.count("*").alias("n"), F.count("o_orderkey").alias("n_extra"), F.round(F.sum("l_quantity"), 4).alias("qty"))


@query("q_state_scan", "select state, count(*) as n from inventory where lower(state) in ('florida', 'north_carolina') group by state", ("inventory",))
def _(t):
    return src.scan_states(t.inventory, ["FLORIDA", "North Carolina", "Ohio"], on_missing="warn").groupBy("state").agg(F.count("*").alias("n"))


@query("q_unmatched_states", """select w.state from (values ('florida'), ('ohio'), ('new_york')) w(state)
    where w.state not in (select lower(state) from inventory)""", ("inventory",))
def _(t):
    return src.unmatched_states(t.inventory, ["Florida", "Ohio", "New York"])


@query("q_union_states", "select state, bid, occtype, case when state = 'Texas' then null else val_struct end as val_struct from inventory", ("inventory",))
def _(t):
    cols = ["state", "bid", "occtype", "val_struct"]
    per_state = [t.inventory.where(F.col("state") == s) for s in STATE_NAMES.split(",")]
    # The last one lacks a column and has the others in another order.
    frames = [f.select(cols) for f in per_state[:-1]] + [per_state[-1].select(*reversed(cols[:3]))]
    return inv.union_states(frames).select(cols)


@query("q_distinct_ordered", "select o_custkey, min(o_orderkey) as o_orderkey from orders group by o_custkey order by 2, 1")
def _(t):
    return inv.distinct_ordered(t.orders, "o_custkey", "o_orderkey")


@query("q_load_manifest", """select coalesce(a.state, b.state) as state, coalesce(feature_count, 0) as feature_count, coalesce(processed_parquet_rows, 0) as processed_parquet_rows,
    coalesce(feature_count, 0) = coalesce(processed_parquet_rows, 0) as complete
    from (select state, count(*) as feature_count from raw_feature group by state) a
    full join (select state, count(*) as processed_parquet_rows from inventory where sqft is not null or state = 'Texas' group by state) b on a.state = b.state""",
       ("raw_feature", "inventory"))
def _(t):
    done = t.inventory.where("sqft is not null or state = 'Texas'")
    return inv.load_manifest(t.raw_feature, done)


def landed(t):
    """Feature lines as text files in a folder per state, as they come from a download."""
    path = work_folder(t.spark)
    t.feature_line.select("state", "line").write.partitionBy("state").text(path)
    return features.read_lines(t.spark, path, place=True)


@query("q_feature_quarantine", """select state, problem, line, true as placed from (select *, case when ln % 7 = 3 and pk % 5 = 0 then 'malformed' end as problem, substr(body, 1, 40) as line
      from (select *, '{"type":"Feature","properties":{"bid":"' || bid || '","occtype":"' || occtype || '","sqft":' || sqft as body from raw_feature) a) b where problem is not null""", ("raw_feature",))
def _(t):
    """The quarantined lines of an ingest that writes both of its outputs."""
    done = ingest_features(landed(t), work_folder(t.spark), work_folder(t.spark))
    return done.quarantined.select("state", "problem", "line", (F.col("file").contains("state=") & F.col("block_start").isNotNull()).alias("placed"))


@query("q_ingest_counts", """select count(*) as lines, count(*) filter (where problem = 'blank') as blank, count(*) filter (where problem = 'malformed') as malformed,
    count(*) filter (where problem = 'not_feature') as not_feature, count(*) filter (where problem is null) as features, count(*) filter (where problem is null) as written
    from (select case when ln % 7 = 1 and pk % 5 = 0 then 'blank' when ln % 7 in (2, 4) and pk % 5 = 0 then 'not_feature' when ln % 7 = 3 and pk % 5 = 0 then 'malformed' end as problem from raw_feature) a""", ("raw_feature",))
def _(t):
    root = work_folder(t.spark)
    counts = ingest_features(landed(t), root, work_folder(t.spark)).counts
    written = src.read_inventory(t.spark, root).agg(F.count("*").alias("written"))
    return written.select(*[F.lit(n).cast("long").alias(k) for k, n in counts.items()], "written")


@query("q_file_manifest", """select s.state, n.name, n.abbr, n.fips, raw_lines_bytes, good as feature_count, good as processed_parquet_rows, true as complete, true as has_paths, true as has_bytes
    from (select state, cast(sum(strlen(line) + 1) as bigint) as raw_lines_bytes from feature_line group by state) s
    join (select state, count(*) filter (where not (ln % 7 in (1, 2, 3, 4) and pk % 5 = 0)) as good from raw_feature group by state) g using (state)
    join states n on replace(n.name, ' ', '_') = s.state""", ("feature_line", "raw_feature"), extra=f"states(name, abbr, fips) AS (values {_STATE_VALUES})")
def _(t):
    lines, root = landed(t), work_folder(t.spark)
    ingest_features(lines, root, work_folder(t.spark))
    found = features.judged_features(lines, ("bid",), keep=("state", "_metadata")).where("problem is null")
    table = inv.file_manifest(found, src.read_inventory(t.spark, root))
    return table.select(
        "state", "name", "abbr", "fips", "raw_lines_bytes", "feature_count", "processed_parquet_rows", "complete",
        (F.col("raw_lines").contains(F.concat(F.lit("/state="), "state")) & F.col("processed_parquet").contains(root)).alias("has_paths"),
        ((F.col("processed_parquet_bytes") > 0) & F.col("processed_parquet_modified").isNotNull()).alias("has_bytes"))


@query("q_morton", """select bid, latitude, longitude, list_sum(list_transform(range(26), lambda i: (((la >> i) & 1) << (2 * i + 1)) + (((lo >> i) & 1) << (2 * i))))::bigint as place
    from (select bid, latitude, longitude, floor((latitude + 90) * (67108864::double / 180))::bigint as la, floor((longitude + 180) * (67108864::double / 360))::bigint as lo from inventory) a""", ("inventory",))
def _(t):
    return t.inventory.select("bid", "latitude", "longitude", geodesy.morton("latitude", "longitude").alias("place"))


@query("q_inventory_store", f"""select state, count(*) as n, round(sum(val_struct), 4) as value, cast(sum(cast(trunc(num_story) as bigint)) as bigint) as stories, min(latitude) as south, max(longitude) as east, count(cbfips) as blocks
    from inventory where lower(state) in ('florida', 'north_carolina') and latitude between 26 and 28.5 and longitude between -84.5 and -82 group by state""", ("inventory",))
def _(t):
    """Written by state along the curve, then read by state and box with the fixed schema."""
    schema = T.StructType([*INVENTORY.fields, T.StructField("state", T.StringType())])
    root = work_folder(t.spark)
    src.write_inventory(src.conform(t.inventory, schema), root)
    stored = src.read_inventory(t.spark, root)
    src.check_columns(stored)
    kept, counts = src.scan_states_counted(stored, ["FLORIDA", "North Carolina"])
    out = inv.in_bbox(kept, -84.5, 26.0, -82.0, 28.5).groupBy("state").agg(
        F.count("*").alias("n"), F.round(F.sum("val_struct"), 4).alias("value"), F.sum("num_story").alias("stories"),
        F.min("latitude").alias("south"), F.max("longitude").alias("east"), F.count("cbfips").alias("blocks"))
    path = work_folder(t.spark)
    out.write.parquet(path)
    counts.require_all()
    return t.spark.read.schema(out.schema).parquet(path)


@query("q_engine_csv", "select * exclude (cbfips) from building", ("inventory",), extra=BUILDING_CTE)
def _(t):
    """The engine's input file, read back by its parts."""
    path, rows = work_folder(t.spark), exports.engine_export(buildings(t))
    exports.write_ordered_csv(rows, path)
    return t.spark.read.option("header", True).schema(rows.schema).csv(path)


@query("q_prediction_csv", "select fltyid, occ, cost, depth_grid, bldgdmgpct, bldglossusd from prediction", ("prediction",))
def _(t):
    path = work_folder(t.spark)
    t.prediction.selectExpr("fltyid as FltyId", "occ as Occ", "cost as Cost", "depth_grid as Depth_Grid", "bldgdmgpct as BldgDmgPct", "bldglossusd as BldgLossUSD").write.option("header", True).csv(path)
    return predictions.read_predictions(t.spark, path)


@query("q_prediction_store", """select event, cast(adv as int) as adv, case event when 'IDA_2021' then 'second' else 'first' end as run_id, count(*) as n, round(sum(bldgdmgpct), 6) as damage
    from prediction where event in ('BERYL_2024', 'IDA_2021') and adv in (9, 10) group by event, adv""", ("prediction",))
def _(t):
    """Runs of the store; one event is run again, and only its own advisories are replaced."""
    root = work_folder(t.spark)
    for run, events in (("first", ("BERYL_2024", "IDA_2021")), ("second", ("IDA_2021",))):
        for event in events:
            for adv in (9, 10):
                own = t.prediction.where((F.col("event") == event) & (F.col("adv") == adv)).drop("event", "adv", "flc")
                exports.write_predictions(own, root, event, adv, "grid", run, "CAE")
    stored = predictions.read_prediction_store(t.spark, root)
    return stored.groupBy("event", F.col("adv").cast("int").alias("adv"), "run_id").agg(
        F.count("*").alias("n"), F.round(F.sum("bldgdmgpct"), 6).alias("damage"))


@query("q_published_table", "select substr(cbfips, 1, 5) as FIPS, count(*) as buildings, max(bldgdmgpct) as worst from prediction where cbfips is not null group by 1", ("prediction",))
def _(t):
    table = t.prediction.where("cbfips is not null").groupBy(F.substring("cbfips", 1, 5).alias("FIPS")).agg(
        F.count("*").alias("buildings"), F.max("bldgdmgpct").alias("worst"))
    path = exports.publish(table, run_params({"storm_id": "al022024", "storm_name": "beryl"}), work_folder(t.spark))
    return t.spark.read.option("header", True).schema(table.schema).csv(path)


@query("q_resolve_in_flight", f"""select s.fips, s.abbr, s.name, replace(s.name, ' ', '_') as path_name, count(*) as n
    from keyed join states s on key in (s.fips, s.abbr, lower(s.name)) group by all""", ("state_token",),
    extra=f"states(name, abbr, fips) AS (values {_STATE_VALUES}), keyed AS (select {_STATE_KEY_SQL} as key from state_token)")
def _(t):
    """Every identifier is resolved and counted in one reading; the strict check would follow the write."""
    rows, counts = inv.resolve_states_counted(t.state_token, "token")
    path = work_folder(t.spark)
    rows.groupBy("fips", "abbr", "name", "path_name").agg(F.count("*").alias("n")).write.parquet(path)
    assert counts.get()["unknown"] > 0
    return t.spark.read.schema("fips string, abbr string, name string, path_name string, n long").parquet(path)


_FEATURE_SQL = """select case when bad then null else bid end as bid, case when bad then null else occtype end as occtype, case when bad then null else sqft end as sqft,
    case when bad or pk % 3 = 0 then null else cast(lon as double) end as longitude, case when bad or pk % 3 = 0 then null else cast(lat as double) end as latitude
    from (select *, ln % 7 = 3 and pk % 5 = 0 as bad from raw_feature where not (ln % 7 in (1, 2, 4) and pk % 5 = 0)) a"""


@query("q_feature_stream", _FEATURE_SQL, ("raw_feature",))
def _(t):
    return features.parse_features(t.feature_line, on_bad="null", properties=("bid", "occtype", "sqft"))


@query("q_conform", """select state, bid, occtype, cast(sqft as double) as sqft, cast(num_story as bigint) as num_story, cast(null as varchar) as found_type, 1.5::double as found_ht, cast(null as double) as val_struct,
    case when pk % 3 = 0 then null else cast(lon as double) end as x, case when pk % 3 = 0 then null else cast(lat as double) end as latitude, true as stamped
    from raw_feature where not (ln % 7 in (1, 2, 3, 4) and pk % 5 = 0)""", ("raw_feature",))
def _(t):
    rows = features_to_inventory(t.feature_line, on_bad="null", on_nonfeature="skip").where("bid is not null")
    return rows.select("state", "bid", "occtype", "sqft", "num_story", "found_type", "found_ht", "val_struct", "x", "latitude",
                       F.col("processed_at").isNotNull().alias("stamped"))


@query("q_ordered_export", "select FltyId as fltyid, cbfips from building order by 1", ("inventory",), extra=BUILDING_CTE)
def _(t):
    return exports.ordered(exports.crosswalk(buildings(t)), "fltyid")


@query("q_latest_advisories", "select storm, adv from (select *, row_number() over (partition by storm order by adv desc) as rn from (select distinct storm, adv from advisory_file) a) b where rn <= 3", ("advisory_file",))
def _(t):
    return latest_advisories(t.advisory_file, "storm", "adv")
