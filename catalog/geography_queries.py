"""Geography roll-ups, demographic joins and spatial joins."""

from pyspark.sql import functions as F

from floodmark import run_params
from floodmark.functions import fixed_values as fv
from floodmark.functions.hazard import depth_category
from floodmark.operators import geography as geo, spatial
from floodmark.plans.geography import geography_table, located_predictions
from floodmark.session import work_folder
from floodmark.sources import demographics, features

from .registry import query, rounded

LABELS = ["DESTROYED", "MAJOR", "MINOR", "AFFECTED"]
PARAMS = run_params({
    "storm_id": "al022024", "storm_name": "beryl", "advisory": 29, "year": 2024, "geography": "census tract",
    "building_types": dict.fromkeys(fv.RESIDENTIAL, "Y"),
    "damage_categories": dict(zip((">9", ">6", ">3", ">1"), LABELS)),
})
CATEGORY_SQL = "case when depth_grid >= 9 then 'DESTROYED' when depth_grid >= 6 then 'MAJOR' when depth_grid >= 3 then 'MINOR' when depth_grid >= 1 then 'AFFECTED' else 'None' end"
LOCATED_CTE = """located AS (select p.*, x.cbfips as blk from (
      select * exclude (cbfips) from (select *, row_number() over (partition by fltyid order by bldgdmgpct desc nulls last, occ, cost, depth_grid, depth_in_struc, bldglossusd nulls last, event, adv, flc, state, county_fips5, cbfips nulls last, pop2pmo65, pop2pmu65, pop2amo65, pop2amu65) as rn from prediction) a where rn = 1) p
    left join xwalk x using (fltyid) where occ like 'RES%')"""


def rollup_sql(width: int, source: str = "located", fips: str = "blk") -> str:
    cols = ["count(fltyid) as Total_Num_Building"]
    cols += [f"count(*) filter (where {CATEGORY_SQL} = '{c}') as Total_Num_Building_{c}" for c in LABELS]
    cols += [f"count(*) filter (where depth_grid = {h}) as Total_Num_Building_SurgeHeight_{h}" for h in (0, 1, 3, 6, 9)]
    cols += [f"count(*) filter (where bldgdmgpct > {10 * i} and bldgdmgpct <= {10 * i + 10}) as Total_Num_Building_Damage_{10 * i + 10}pct" for i in range(10)]
    for name, c in geo.METRICS.items():
        cols += [f"min({c}) as {name}_Min", f"max({c}) as {name}_Max", f"avg({c}) as {name}_Mean"]
        cols += [f"quantile_cont({c}, {p}) as {name}_{s}" for s, p in geo.QUARTILES.items()]
    return (f"select substr({fips}, 1, 2) as State_FIPS, substr({fips}, 1, 5) as County_FIPS, substr({fips}, 1, {width}) as FIPS, {', '.join(cols)} "
            f"from {source} where {fips} is not null group by all")


@query("q_geo_rollup", rollup_sql(11), ("prediction", "xwalk"), LOCATED_CTE)
def _(t):
    return geo.geo_rollup(located_predictions(t.prediction, t.xwalk, PARAMS), "census tract", LABELS)


@query("q_geo_rollup_county", rollup_sql(5, "prediction", "cbfips"), ("prediction",))
def _(t):
    return geo.geo_rollup(t.prediction, "county", LABELS)


def levels_sql() -> str:
    body = rollup_sql(11, "prediction", "cbfips").split(" as FIPS, ")[1].split(" from prediction")[0]
    return (f"select case grouping(t, c, s) when 0 then 'tract' when 4 then 'county' when 6 then 'state' else 'nation' end as level, coalesce(t, c, s, '') as FIPS, {body} "
            "from (select *, substr(cbfips, 1, 2) as s, substr(cbfips, 1, 5) as c, substr(cbfips, 1, 11) as t from prediction where cbfips is not null) a group by rollup(s, c, t)")


@query("q_geo_levels", levels_sql(), ("prediction",))
def _(t):
    return geo.geo_rollup_levels(t.prediction, LABELS)


@query("q_geography_table", f"""select coalesce(s.ST_ABBR, last_value(s.ST_ABBR ignore nulls) over b, first_value(s.ST_ABBR ignore nulls) over a) as ST_ABBR,
      coalesce(s.COUNTY, last_value(s.COUNTY ignore nulls) over b, first_value(s.COUNTY ignore nulls) over a) as COUNTY,
      r.*, coalesce(v.units, 0) as Num_Vacant_Units, {', '.join('s.' + c for c in fv.SVI_OUTPUT_COLUMNS)}
    from rolled r left join vacancy v on r.FIPS = v.st || v.co || v.tr left join svi s on r.FIPS = s.FIPS
    window b as (partition by r.State_FIPS, r.County_FIPS order by r.FIPS rows between unbounded preceding and current row),
      a as (partition by r.State_FIPS, r.County_FIPS order by r.FIPS rows between current row and unbounded following)""",
       ("prediction", "xwalk", "vacancy", "svi"), f"{LOCATED_CTE}, rolled AS ({rollup_sql(11)})")
def _(t):
    return geography_table(t.prediction, t.xwalk, demographics.parse_vacancy(t.vacancy_doc, "tract"), t.svi, PARAMS)


@query("q_geoids", "select fltyid, cbfips, substr(cbfips, 1, 11) as tract_geoid, substr(cbfips, 1, 5) as county_geoid, substr(cbfips, 1, 2) as state_geoid from prediction", ("prediction",))
def _(t):
    return geo.add_geoids(t.prediction.select("fltyid", "cbfips"))


@query("q_crosswalk", "select count(blk) as matched, count(*) as total, round(count(blk) * 100 / greatest(count(*), 1), 6) as match_pct from (select p.fltyid, x.cbfips as blk from prediction p left join xwalk x using (fltyid)) a", ("prediction", "xwalk"))
def _(t):
    return rounded(geo.match_rate(geo.attach_block(t.prediction.select("fltyid"), t.xwalk), "cbfips"))


@query("q_crosswalk_in_flight", "select count(blk) as matched, count(*) as total, round(count(blk) * 100 / greatest(count(*), 1), 6) as match_pct from (select p.fltyid, x.cbfips as blk from prediction p left join xwalk x using (fltyid)) a", ("prediction", "xwalk"))
def _(t):
    """The report comes from the job that writes the joined rows."""
    rows, counts = geo.attach_block_counted(t.prediction.select("fltyid", "bldgdmgpct"), t.xwalk)
    rows.write.parquet(work_folder(t.spark))
    return rounded(counts.row(rows))


@query("q_depth_category", f"select fltyid, depth_grid, {CATEGORY_SQL} as category from prediction", ("prediction",))
def _(t):
    return t.prediction.select("fltyid", "depth_grid", depth_category("depth_grid", LABELS).alias("category"))


@query("q_category_dist", f"""select c.category, count(p.cat) as buildings, round(count(p.cat) * 100 / (select count(*) from prediction), 6) as pct
    from (values ('DESTROYED'), ('MAJOR'), ('MINOR'), ('AFFECTED')) c(category) left join (select {CATEGORY_SQL} as cat from prediction) p on p.cat = c.category group by 1""", ("prediction",))
def _(t):
    return rounded(geo.category_distribution(t.prediction, LABELS))


@query("q_distinct_geos", "select count(distinct substr(cbfips, 1, 5)) as n_counties, count(distinct substr(cbfips, 1, 11)) as n_tracts from prediction", ("prediction",))
def _(t):
    return geo.distinct_geos(t.prediction)


@query("q_overview", f"""select count(*) as n_geographies, sum(E_TOTPOP) as total_population, {', '.join(f'cast(sum(Total_Num_Building_{c}) as bigint) as buildings_{c}, round(sum(Total_Num_Building_{c}) * 100 / greatest(sum(Total_Num_Building), 1), 6) as pct_{c}' for c in LABELS)}
    from (select r.*, s.E_TOTPOP from rolled r left join svi_county s using (FIPS)) a""", ("prediction", "svi_county"), f"rolled AS ({rollup_sql(5, 'prediction', 'cbfips')})")
def _(t):
    table = geo.attach_svi(geo.geo_rollup(t.prediction, "county", LABELS, quantiles=False), t.svi_county)
    return rounded(geo.overview(table, LABELS))


@query("q_vacancy_join", """select FIPS, buildings, coalesce(units, 0) as Num_Vacant_Units from (select substr(cbfips, 1, 11) as FIPS, count(*) as buildings from prediction where cbfips is not null group by 1) g
    left join vacancy on FIPS = st || co || tr""", ("prediction", "vacancy"))
def _(t):
    tracts = t.prediction.where("cbfips is not null").groupBy(F.substring("cbfips", 1, 11).alias("FIPS")).agg(F.count("*").alias("buildings"))
    return geo.attach_vacancy(tracts, demographics.parse_vacancy(t.vacancy_doc, "tract"))


@query("q_svi_join", """select count(E_TOTPOP) as matched, count(*) as total, round(count(E_TOTPOP) * 100 / greatest(count(*), 1), 6) as match_pct
    from (select distinct substr(cbfips, 1, 11) as FIPS from prediction where cbfips is not null) g left join svi using (FIPS)""", ("prediction", "svi"))
def _(t):
    tracts = t.prediction.where("cbfips is not null").select(F.substring("cbfips", 1, 11).alias("FIPS")).distinct()
    return rounded(geo.match_rate(geo.attach_svi(tracts, demographics.svi_projection(t.svi)), "E_TOTPOP"))


@query("q_name_fill", """select State_FIPS, County_FIPS, FIPS, coalesce(last_value(ST_ABBR ignore nulls) over b, first_value(ST_ABBR ignore nulls) over a) as ST_ABBR,
      coalesce(last_value(COUNTY ignore nulls) over b, first_value(COUNTY ignore nulls) over a) as COUNTY
    from (select substr(FIPS, 1, 2) as State_FIPS, substr(FIPS, 1, 5) as County_FIPS, * from svi) g
    window b as (partition by State_FIPS, County_FIPS order by FIPS rows between unbounded preceding and current row), a as (partition by State_FIPS, County_FIPS order by FIPS rows between current row and unbounded following)""", ("svi",))
def _(t):
    keyed = t.svi.select(F.substring("FIPS", 1, 2).alias("State_FIPS"), F.substring("FIPS", 1, 5).alias("County_FIPS"), "FIPS", "ST_ABBR", "COUNTY")
    return geo.fill_names(keyed)


@query("q_feature_pages", "select lpad(cast(s_suppkey as varchar), 11, '0') as FIPS, s_suppkey % 8 + 0.5::double as RPL_THEMES from supplier union all select lpad(cast(s_suppkey + 7 as varchar), 11, '0'), null from supplier")
def _(t):
    return features.parse_feature_pages(t.feature_page)


@query("q_boundary_join", f"select b.GEOID, b.NAME, r.Total_Num_Building, r.Total_Num_Building_DESTROYED + r.Total_Num_Building_MAJOR as worst_damage_assessment from boundary b join rolled r on b.GEOID = r.FIPS",
       ("boundary", "prediction"), f"rolled AS ({rollup_sql(5, 'prediction', 'cbfips')})")
def _(t):
    table = geo.geo_rollup(t.prediction, "county", LABELS, quantiles=False)
    return geo.attach_boundaries(t.boundary, table, LABELS).select("GEOID", "NAME", "Total_Num_Building", "worst_damage_assessment")


# Spatial joins ---------------------------------------------------------------------------------

BOX_CTE = "box AS (select poly_id, min(least(x1, x2)) as bx0, max(greatest(x1, x2)) as bx1, min(least(y1, y2)) as by0, max(greatest(y1, y2)) as by1 from edge group by 1)"
_MEETS = """(greatest(x1, x2) >= left_x and least(x1, x2) <= right_x and greatest(y1, y2) >= bottom and least(y1, y2) <= top
      and not (greatest((x2-x1)*(bottom-y1)-(y2-y1)*(left_x-x1), (x2-x1)*(top-y1)-(y2-y1)*(left_x-x1), (x2-x1)*(bottom-y1)-(y2-y1)*(right_x-x1), (x2-x1)*(top-y1)-(y2-y1)*(right_x-x1)) < 0
        or least((x2-x1)*(bottom-y1)-(y2-y1)*(left_x-x1), (x2-x1)*(top-y1)-(y2-y1)*(left_x-x1), (x2-x1)*(bottom-y1)-(y2-y1)*(right_x-x1), (x2-x1)*(top-y1)-(y2-y1)*(right_x-x1)) > 0))"""
TOUCH_CTE = f"""touch AS (select raster_id, poly_id from edge, extent group by raster_id, poly_id
    having bool_or({_MEETS}) or count(*) filter (where (y1 <= bottom) <> (y2 <= bottom) and left_x < x1 + (bottom - y1) * (x2 - x1) / (y2 - y1)) % 2 = 1)"""


@query("q_point_in_polygon", """select bid, val_struct, p.latitude, p.longitude, e.poly_id from (select distinct bid, val_struct, latitude, longitude from inventory) p join box on p.longitude between bx0 and bx1 and p.latitude between by0 and by1 join edge e on e.poly_id = box.poly_id
    where (y1 <= p.latitude) <> (y2 <= p.latitude) and p.longitude < x1 + (p.latitude - y1) * (x2 - x1) / (y2 - y1)
    group by all having count(*) % 2 = 1""", ("inventory", "edge"), BOX_CTE)
def _(t):
    points = t.inventory.select("bid", "val_struct", "latitude", "longitude")
    return spatial.points_in_polygons(points, t.edge, distinct=True)


@query("q_extent_states", "select raster_id, poly_id from touch", ("edge", "extent"), TOUCH_CTE)
def _(t):
    return spatial.polygons_in_extent(t.edge, t.extents)


@query("q_completeness_gate", "select poly_id, poly_id in (select poly_id from touch) as intersects from failed_unit", ("failed_unit", "edge", "extent"), TOUCH_CTE)
def _(t):
    return spatial.completeness_report(t.failed_unit, t.edge, t.extents)


@query("q_event_states", """select state, count(*) as n from (select *, 'P' || cast(case state when 'Florida' then 3 when 'Georgia' then 5 when 'Louisiana' then 8 when 'Texas' then 12 else 14 end as varchar) as unit from inventory) i
    where unit in (select poly_id from touch) group by state""", ("inventory", "edge", "extent"), TOUCH_CTE)
def _(t):
    codes = F.when(F.col("state") == "Florida", 3).when(F.col("state") == "Georgia", 5).when(F.col("state") == "Louisiana", 8).when(F.col("state") == "Texas", 12).otherwise(14)
    rows = t.inventory.withColumn("unit", F.concat(F.lit("P"), codes.cast("string")))
    return spatial.event_states(rows, t.edge, t.extents, "unit").groupBy("state").agg(F.count("*").alias("n"))
