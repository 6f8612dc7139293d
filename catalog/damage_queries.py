"""Grid sampling, curves, losses, debris, restoration and the assessment."""

from pyspark.sql import functions as F

from floodmark.functions import fixed_values as fv, geodesy, hazard, text
from floodmark.operators import damage, raster
from floodmark.operators.damage import DEPTH_COLUMNS
from floodmark.operators.inventory import union_states
from floodmark.plans.assess import assess
from floodmark.sinks import exports
from floodmark.sources import lookups as lookup_sources

from .fixtures import GRIDS, soid_sql
from .inventory_queries import BUILDING_CTE, buildings
from .registry import query, rounded

_K = " ".join(f"when '{c}' then {k}" for k, c in DEPTH_COLUMNS.items())
_COLS = ", ".join(DEPTH_COLUMNS.values())


def long_cte(name: str, wide: str, keys: str, extra: str) -> str:
    """WITH entry: long curve rows by unpivoting the wide table."""
    return f"""{name} AS (select {keys}, {extra}, k, lo, coalesce(lead(lo) over (partition by {keys} order by k), lo) as hi from (
      select {keys}, {extra}, cast(case c {_K} end as int) as k, lo from (unpivot {wide} on {_COLS} into name c value lo) u) v)"""


CURVE_CTE = long_cte("curve", "curve_wide", "curve_set, curve_key", "ddf_id")
LIBRARY_CTE = long_cte("library", "library_wide", "kind, fn_id", "occupancy")
GRID_CTE = "grid(GridName) AS (values ('G1'), ('G2'))"
WET_SQL = "case when value is null or isnan(value) or value = -9999 then 0.0::double else value end"


def sampled_cte(source: str, lat: str = "Latitude", lon: str = "Longitude") -> str:
    """WITH entry ``sampled``: every source row on every grid with its depth."""
    return f"""sampled AS (select p.*, c.raster_id is null and false as _x, g.GridName, {WET_SQL} as Depth_Grid
      from {source} p cross join grid g left join depth_cell c on c.raster_id = g.GridName
        and c.rr = floor((30.0::double - p.{lat}) / 0.05::double) and c.cc = floor((p.{lon} - (-85.0::double)) / 0.05::double)
        and floor((30.0::double - p.{lat}) / 0.05::double) between 0 and 99 and floor((p.{lon} + 85.0::double) / 0.05::double) between 0 and 79)"""


CONTENT_FACTOR = """case when {o} in ('RES1','RES2','RES3A','RES3B','RES3C','RES3D','RES3E','RES3F','RES4','RES5','RES6','COM10') then 0.5::double
    when {o} in ('COM1','COM2','COM3','COM4','COM5','COM8','COM9','IND6','AGR1','REL1','GOV1','EDU1') then 1.0::double
    when {o} in ('COM6','COM7','IND1','IND2','IND3','IND4','IND5','GOV2','EDU2') then 1.5::double else 0.0::double end"""
HOLDS = "in ('COM1','COM2','IND1','IND2','IND3','IND4','IND5','IND6','AGR1')"


def assess_sql(source: str, flood_class: str, user_curves: bool) -> str:
    """WITH entries ending in ``assessed``, from typed rows ``source`` with a status.

    ``source`` has key, o, cost, area, stories, found, ffh, content (NULL: no such column or a
    blank), inv, bid_b, bid_c, bid_i, GridName, Depth_Grid and status.
    """
    def pct(kind: str) -> str:
        default = f"(d{kind}.lo + (d - floor(d)) * (d{kind}.hi - d{kind}.lo)) / 100"
        if not user_curves:
            return default
        return f"case when u{kind}.lo is not null then (u{kind}.lo + (d - floor(d)) * (u{kind}.hi - u{kind}.lo)) / 100 else {default} end"

    def curve_id(kind: str) -> str:
        return f"coalesce(u{kind}.fn_id, d{kind}.ddf_id)" if user_curves else f"d{kind}.ddf_id"

    coastal = {"CAE": "coastal_a", "V": "coastal_v"}.get(flood_class)
    curve_set = f"case when substr(o, 1, 3) = 'RES' then '{coastal}' else 'default' end" if coastal else "'default'"
    users = "".join(
        f" left join library u{kind} on u{kind}.kind = '{name}' and u{kind}.fn_id = s.bid_{kind} and u{kind}.k = floor(d)"
        for kind, name in (("b", "building"), ("c", "content"), ("i", "inventory"))
    ) if user_curves else ""
    matched = "coalesce(ub.lo, db.lo) is not null" if user_curves else "db.lo is not null"
    no_inv = f"(not (o {HOLDS}){' and ui.lo is null' if user_curves else ''})"
    return f"""
    ready AS (select s.*, Depth_Grid - ffh as ds, {soid_sql('o', 'stories', 'found = 4')} as soid,
        case when status = 'OK' and Depth_Grid > 0 then greatest(-4.0::double, least(24.0::double, Depth_Grid - ffh)) end as d,
        case when cast(trunc(coalesce(content, 0)) as bigint) = -1 then trunc(cost) * ({CONTENT_FACTOR.format(o='o')}) else trunc(coalesce(content, 0)) end as content_usd,
        case when o {HOLDS} and inv = -1 then AnnualSalesPerSqFt * BusinessInvPctofSales * area / 100 when inv > -1 then inv else 0.0::double end as inv_usd
      from {source} s left join econ e on e.Occupancy = s.o),
    curved AS (select s.*, {pct('b')} as fb, {pct('c')} as fc, case when d is not null and {no_inv} then 0.0::double else {pct('i')} end as fi,
        {curve_id('b')} as ib, {curve_id('c')} as ic, case when {no_inv} then '0' else {curve_id('i')} end as ii,
        d is not null and {matched} as hit
      from ready s
        left join curve db on db.curve_set = 'building_' || {curve_set} and db.curve_key = s.soid and db.k = floor(d)
        left join curve dc on dc.curve_set = 'content_' || {curve_set} and dc.curve_key = s.soid and dc.k = floor(d)
        left join curve di on di.curve_set = 'inventory_default' and o {HOLDS} and di.curve_key = s.soid and di.k = floor(d){users}),
    keyed AS (select *, case when hit and d > 0 then o || case when o = 'RES1' and found = 4 then 'B' else 'NB' end || case when found in (4, 7) then 'SG' else 'FT' end
          || case when o in ('RES1', 'COM6') and found = 4 then case when d < 4 then '0' when d < 6 then '4' when d < 8 then '6' else '8' end
             else case when d < 1 then '0' when d < 4 then '1' when d < 8 then '4' when d < 12 then '8' else '12' end end end as did,
        case when hit and d > 0 then o || case when d < 1 then '1' when d < 4 then '4' when d < 8 then '8' when d < 12 then '12' else '24' end end as rid
      from curved),
    assessed AS (select k.*, status = 'OK' as ok, status = 'OK' and not (Depth_Grid > 0) as dry, area * Finishes / 1000 as dfin, area * Structure / 1000 as dstr, area * Foundation / 1000 as dfnd,
        cast(Min_Restor_Days as bigint) as rmin, cast(Max_Restor_Days as bigint) as rmax
      from keyed k left join debris_rate on DebrisID = did left join restor_days on RestFnID = rid)"""


ASSESSED_COLUMNS = """case when ok then Depth_Grid end as Depth_Grid, case when ok then ds when status = 'INCOMPLETE' then -99999.0::double end as Depth_in_Struc,
    cast(case when ok then not dry end as int) as flExp, case when ok then soid end as SOID,
    case when dry then '0' when hit then ib when ok then 'Unmatched' end as BDDF_ID,
    case when dry then 0.0::double when hit then fb * 100 end as BldgDmgPct, case when dry then 0.0::double when hit then fb * trunc(cost) end as BldgLossUSD,
    case when ok then content_usd end as ContentCostUSD, case when dry then '0' when hit then ic end as CDDF_ID,
    case when dry then 0.0::double when hit then fc * 100 end as ContDmgPct, case when dry then 0.0::double when hit then fc * content_usd end as ContentLossUSD,
    case when ok then inv_usd end as InventoryCostUSD, case when dry then '0' when hit then ii end as IDDF_ID,
    case when dry then 0.0::double when hit then fi * 100 end as InvDmgPct, case when dry then 0.0::double when hit then fi * inv_usd end as InventoryLossUSD,
    did as DebrisID, case when hit and d > 0 then dfin end as Debris_Fin, case when hit and d > 0 then dstr end as Debris_Struc, case when hit and d > 0 then dfnd end as Debris_Found,
    case when hit and d > 0 then dfin + dstr + dfnd end as Debris_Tot,
    case when dry or (hit and d <= 0) then cast(0 as bigint) when hit then rmin end as Restor_Days_Min, case when dry or (hit and d <= 0) then cast(0 as bigint) when hit then rmax end as Restor_Days_Max,
    GridName, case when ok and not dry and not hit then 'UNMATCHED' else status end as status,
    concat_ws(',', case when hit and fc is null then 'CONTENT' end, case when hit and fi is null then 'INVENTORY' end, case when hit and d > 0 and dfin is null then 'DEBRIS' end,
      case when hit and d > 0 and rmin is null then 'RESTORATION' end) as flags"""

_ASSESS_TABLES = ("inventory", "depth_cell", "curve_wide", "debris_rate", "restor_days", "econ")
TYPED_BUILDING = """typed AS (select FltyId, Occ as o, Cost as cost, Area as area, NumStories as stories, FoundationType as found, FirstFloorHt as ffh,
    ContentCost as content, -1.0::double as inv, null as bid_b, null as bid_c, null as bid_i, GridName, Depth_Grid, 'OK' as status, cbfips, Latitude, Longitude from sampled)"""
BUILDING_ASSESS = ",\n".join([BUILDING_CTE, GRID_CTE, sampled_cte("building"), CURVE_CTE, TYPED_BUILDING, assess_sql("typed", "CAE", False)])


def assessed(t, **options):
    return assess(buildings(t), t.wet, GRIDS, t.lookups, "CoastalA", **options)


@query("q_assess", f"select FltyId, cbfips, {ASSESSED_COLUMNS} from assessed", _ASSESS_TABLES, BUILDING_ASSESS)
def _(t):
    return assessed(t).select("FltyId", "cbfips", *fv.PREDICTION_COLUMNS, "status", "flags")


@query("q_assess_wet_only", f"select FltyId, {ASSESSED_COLUMNS} from assessed where Depth_Grid <> 0", _ASSESS_TABLES, BUILDING_ASSESS)
def _(t):
    return assessed(t, wet_only=True).select("FltyId", *fv.PREDICTION_COLUMNS, "status", "flags")


FACILITY_TYPED = """cleaned AS (select *, case when lower(trim(Cost)) in ('', 'nan', 'none', 'null') then null else trim(Cost) end as c_cost,
      nullif(trim(FirstFloorHt), '') as c_ffh, case when lower(trim(ContentCost)) in ('', 'nan', 'none', 'null') then null else trim(ContentCost) end as c_content,
      nullif(trim(InvCost), '') as c_inv, nullif(trim(BDDF_ID), '') as bid_b, nullif(trim(CDDF_ID), '') as bid_c, case when lower(trim(IDDF_ID)) = 'none' then null else trim(IDDF_ID) end as bid_i
    from facility),
  gated AS (select *, case when c_cost is null or c_ffh is null then 'INCOMPLETE' when try_cast(c_cost as double) is null then 'ROW_ERROR' else 'OK' end as status from cleaned)"""
USER_ASSESS = ",\n".join([
    FACILITY_TYPED, GRID_CTE, sampled_cte("gated"), CURVE_CTE, LIBRARY_CTE,
    """typed AS (select FltyId, Occ as o, try_cast(c_cost as double) as cost, cast(Area as double) as area, cast(NumStories as double) as stories, cast(FoundationType as double) as found,
      cast(c_ffh as double) as ffh, cast(c_content as double) as content, coalesce(cast(c_inv as double), 0) as inv, bid_b, bid_c, bid_i, GridName, Depth_Grid, status from sampled)""",
    assess_sql("typed", "V", True),
])
_USER_TABLES = ("facility", "depth_cell", "curve_wide", "library_wide", "debris_rate", "restor_days", "econ")
FULL_MAP = damage.field_map(
    UserDefinedFltyId="FltyId", OCC="Occ", Cost="Cost", Area="Area", NumStories="NumStories", FoundationType="FoundationType",
    FirstFloorHt="FirstFloorHt", ContentCost="ContentCost", BDDF_ID="BDDF_ID", CDDF_ID="CDDF_ID", IDDF_ID="IDDF_ID",
    InvCost="InvCost", Latitude="Latitude", Longitude="Longitude",
)


def facility_assessed(t):
    return assess(t.facility, t.wet, GRIDS, t.lookups, "CoastalV", FULL_MAP)


@query("q_assess_user_curves", f"select FltyId, {ASSESSED_COLUMNS} from assessed", _USER_TABLES, USER_ASSESS)
def _(t):
    return facility_assessed(t).select("FltyId", *fv.PREDICTION_COLUMNS, "status", "flags")


@query("q_run_stats", f"""select GridName, count(*) as rows, count(*) filter (where status = 'ROW_ERROR') as row_errors,
    count(*) filter (where status = 'OK' and flExp = 1) as flooded, count(*) filter (where status = 'UNMATCHED') as unmatched
    from (select {ASSESSED_COLUMNS} from assessed) a group by GridName""", _USER_TABLES, USER_ASSESS)
def _(t):
    return damage.run_stats(facility_assessed(t))


@query("q_sort_depth", f"select FltyId, GridName, Depth_in_Struc from (select FltyId, {ASSESSED_COLUMNS} from assessed) a order by 3 desc", _ASSESS_TABLES, BUILDING_ASSESS)
def _(t):
    return exports.sort_by_depth(assessed(t).select("FltyId", "GridName", "Depth_in_Struc"))


@query("q_incomplete_gate", "select FltyId, status from gated", ("facility",), FACILITY_TYPED)
def _(t):
    return t.facility.select("FltyId", damage.flag_incomplete(t.facility, FULL_MAP).alias("status"))


@query("q_field_map", """select FltyId as UserDefinedFltyId, Occ as OCC, case when lower(trim(Cost)) in ('', 'nan', 'none', 'null') then null else trim(Cost) end as Cost,
    case when lower(trim(ContentCost)) in ('', 'nan', 'none', 'null') then null else trim(ContentCost) end as ContentCost, cast(null as varchar) as SOID from facility""", ("facility",))
def _(t):
    mapped = damage.apply_field_map(t.facility, FULL_MAP)
    return mapped.select("UserDefinedFltyId", "OCC", text.clean_cell("Cost").alias("Cost"), text.clean_cell("ContentCost").alias("ContentCost"), "SOID")


@query("q_soid", f"""select o, num_story, f, {soid_sql('o', 'num_story', 'f = 4')} as soid, count(*) as n
    from (select upper(split_part(occtype, '-', 1)) as o, num_story, cast(case when upper(trim(found_type)) in ('S','SLAB','SLAB ON GRADE','7') then 7 when upper(trim(found_type)) in ('C','CRAWL','CRAWLSPACE','CRAWL SPACE','5','F','I','W') then 5 when upper(trim(found_type)) in ('B','BASEMENT','4') then 4 when upper(trim(found_type)) in ('P','PIER','PILE','PILES','PIER/PILE','2') then 2 else 7 end as int) as f from inventory) a
    group by all""", ("inventory",))
def _(t):
    rows = t.inventory.select(text.norm_occ("occtype").alias("o"), "num_story", text.foundation_code("found_type").alias("f"))
    return rows.groupBy("o", "num_story", "f", hazard.specific_occupancy("o", "num_story", "f").alias("soid")).agg(F.count("*").alias("n"))


@query("q_structure_depth", """select fltyid, depth_grid - cost / 10000 as depth, greatest(-4.0::double, least(24.0::double, depth_grid - cost / 10000)) as clamped, depth_grid > 0 as exposed from prediction""", ("prediction",))
def _(t):
    depth = hazard.structure_depth("depth_grid", F.col("cost") / 10000)
    return t.prediction.select("fltyid", depth.alias("depth"), hazard.clamp(depth).alias("clamped"), (F.col("depth_grid") > 0).alias("exposed"))


@query("q_content_cost", f"""select FltyId, case when trunc(coalesce(v, 0)) = -1 then trunc(c) * ({CONTENT_FACTOR.format(o='Occ')}) else trunc(coalesce(v, 0)) end as literal_rule,
    case when trunc(coalesce(v, -1)) = -1 then trunc(c) * ({CONTENT_FACTOR.format(o='Occ')}) else trunc(v) end as blank_default, trunc(c) * ({CONTENT_FACTOR.format(o='Occ')}) as no_column
    from (select FltyId, Occ, try_cast(c_cost as double) as c, cast(c_content as double) as v from gated where status = 'OK') a""", ("facility",), FACILITY_TYPED)
def _(t):
    rows = damage.typed_fields(t.facility, FULL_MAP).where("status = 'OK'")
    return rows.select(
        "FltyId", hazard.content_cost("_OCC", "_Cost", "_ContentCost").alias("literal_rule"),
        hazard.content_cost("_OCC", "_Cost", "_ContentCost", True).alias("blank_default"), hazard.content_cost("_OCC", "_Cost").alias("no_column"))


@query("q_inventory_cost", f"""select FltyId, case when Occ {HOLDS} and v = -1 then AnnualSalesPerSqFt * BusinessInvPctofSales * a / 100 when v > -1 then v else 0.0::double end as usd
    from (select FltyId, Occ, cast(Area as double) as a, coalesce(cast(c_inv as double), 0) as v from gated where status = 'OK') g left join econ on Occupancy = Occ""", ("facility", "econ"), FACILITY_TYPED)
def _(t):
    rows = damage.typed_fields(t.facility, FULL_MAP).where("status = 'OK'")
    return damage.inventory_value(rows, t.lookup("econ"), "_OCC", "_Area", "_InvCost").select("FltyId", F.col("InventoryCostUSD").alias("usd"))


@query("q_curve_load", f"""select curve_set, curve_key, ddf_id, {_COLS} from (select *, row_number() over (partition by curve_set, curve_key order by ddf_id, {_COLS}) as rn
    from curve_wide) a where rn = 1""", ("curve_wide",))
def _(t):
    """All seven sets, each with its keys padded as in a file."""
    sets = [f"{kind}_{name}" for kind in ("building", "content") for name in ("default", "coastal_a", "coastal_v")] + ["inventory_default"]
    padded = t.curve_wide.withColumn("curve_key", F.concat(F.lit(" "), "curve_key", F.lit(" ")))
    loaded = [lookup_sources.conform_curves(padded.where(F.col("curve_set") == s), s, "curve_key", "ddf_id") for s in sets]
    return union_states(loaded)


@query("q_curves_long", "select curve_set, curve_key, ddf_id, k, lo, hi from curve", ("curve_wide",), CURVE_CTE)
def _(t):
    return damage.curves_long(t.curve_wide, ["curve_set", "curve_key"], ["ddf_id"]).select("curve_set", "curve_key", "ddf_id", "k", "lo", "hi")


_DAMP = """prediction_d AS (select fltyid, cost, occ, greatest(-4.0::double, least(24.0::double, depth_in_struc)) + cast(cast(cost as bigint) % 8 as double) / 8 - 0.5::double as d0,
    cast(1 + cast(cost as bigint) % 7 as double) + case when cast(cost as bigint) % 5 = 0 then 0.5::double else 0.0::double end as stories, cast(cost as bigint) % 4 = 2 as basement from prediction)"""


def _interp_rows(t):
    whole = F.col("cost").cast("bigint")
    stories = (1 + whole % 7).cast("double") + F.when(whole % 5 == 0, 0.5).otherwise(0.0)
    rows = t.prediction.select(
        "fltyid", "cost", "occ", (hazard.clamp("depth_in_struc") + (whole % 8).cast("double") / 8 - F.lit(0.5)).alias("d0"),
        stories.alias("stories"), F.when(whole % 4 == 2, 4).otherwise(7).alias("found"))
    return rows.withColumns({"d": hazard.clamp("d0"), "soid": hazard.specific_occupancy("occ", "stories", "found")})


@query("q_interp_damage", f"""select fltyid, cost, d, soid, ddf_id, (lo + (d - floor(d)) * (hi - lo)) / 100 as frac from (
      select *, greatest(-4.0::double, least(24.0::double, d0)) as d, {soid_sql('occ', 'stories', 'basement')} as soid from prediction_d) p
    left join curve on curve_set = 'building_' || case when substr(occ, 1, 3) = 'RES' then 'coastal_a' else 'default' end and curve_key = soid and k = floor(d)""", ("prediction", "curve_wide"), ",".join([_DAMP, CURVE_CTE]))
def _(t):
    own_set = damage.building_curve_set("occ", F.lit("CAE"))
    rows = damage.match_curve(_interp_rows(t), t.lookup("curves"), "building", own_set, F.col("soid"), F.floor("d").cast("int"))
    return rows.select("fltyid", "cost", "d", "soid", F.col("_building_id").alias("ddf_id"), damage.interp_damage("_building_lo", "_building_hi", "d").alias("frac"))


@query("q_user_curve_override", f"""select FltyId, soid, coalesce(l.fn_id, c.ddf_id) as curve_id, coalesce(l.lo, c.lo) as lo, case when l.lo is not null then l.hi else c.hi end as hi
    from (select *, cast(floor(c_ffn) as int) as kk, {soid_sql('Occ', 'stories', 'found = 4')} as soid
      from (select *, cast(c_ffh as double) as c_ffn, cast(NumStories as double) as stories, cast(FoundationType as double) as found from gated where status = 'OK') a) g
    left join library l on l.kind = 'building' and l.fn_id = g.bid_b and l.k = kk
    left join curve c on c.curve_set = 'building_' || case when substr(Occ, 1, 3) = 'RES' then 'coastal_v' else 'default' end and c.curve_key = soid and c.k = kk""",
       ("facility", "curve_wide", "library_wide"), ",".join([FACILITY_TYPED, CURVE_CTE, LIBRARY_CTE]))
def _(t):
    rows = damage.typed_fields(t.facility, FULL_MAP).where("status = 'OK'")
    rows = rows.withColumn("soid", hazard.specific_occupancy("_OCC", "_NumStories", "_FoundationType"))
    k = F.floor("_FirstFloorHt").cast("int")
    rows = damage.match_curve(rows, t.lookup("curves"), "building", damage.building_curve_set("_OCC", F.lit("V")), F.col("soid"), k)
    rows = damage.override_curve(rows, t.lookup("library"), "building", "_BDDF_ID", k)
    return rows.select("FltyId", "soid", F.col("_building_id").alias("curve_id"), F.col("_building_lo").alias("lo"), F.col("_building_hi").alias("hi"))


@query("q_losses", f"""select FltyId, GridName, case when dry then 0.0::double when hit then fb * trunc(cost) end as BldgLossUSD, case when dry then 0.0::double when hit then fc * content_usd end as ContentLossUSD,
    case when dry then 0.0::double when hit then fi * inv_usd end as InventoryLossUSD from assessed""", _ASSESS_TABLES, BUILDING_ASSESS)
def _(t):
    return assessed(t).select("FltyId", "GridName", "BldgLossUSD", "ContentLossUSD", "InventoryLossUSD")


_DEBRIS = """wet AS (select *, cast(case cast(cost as bigint) % 4 when 0 then 7 when 1 then 5 when 2 then 4 else 2 end as double) as found, cost / 10 as area, depth_in_struc as d from prediction where depth_in_struc > 0),
  deb AS (select *, occ || case when occ = 'RES1' and found = 4 then 'B' else 'NB' end || case when found in (4, 7) then 'SG' else 'FT' end ||
    case when occ in ('RES1', 'COM6') and found = 4 then (case when d < 4 then '0' when d < 6 then '4' when d < 8 then '6' else '8' end)
      when d < 1 then '0' when d < 4 then '1' when d < 8 then '4' when d < 12 then '8' else '12' end as key,
    occ || case when d < 1 then '1' when d < 4 then '4' when d < 8 then '8' when d < 12 then '12' else '24' end as rkey from wet)"""


def _wet_rows(t):
    pick = F.col("cost").cast("bigint") % 4
    found = F.when(pick == 0, 7.0).when(pick == 1, 5.0).when(pick == 2, 4.0).otherwise(2.0)
    return t.prediction.where("depth_in_struc > 0").withColumns({"found": found, "area": F.col("cost") / 10})


@query("q_debris", """select fltyid, cost, key as DebrisID, area * Finishes / 1000 as Debris_Fin, area * Structure / 1000 as Debris_Struc, area * Foundation / 1000 as Debris_Found,
    area * Finishes / 1000 + area * Structure / 1000 + area * Foundation / 1000 as Debris_Tot from deb left join debris_rate on DebrisID = key""", ("prediction", "debris_rate"), _DEBRIS)
def _(t):
    rows = damage.debris(_wet_rows(t), t.lookup("debris"), "occ", "found", "area", F.col("depth_in_struc"))
    return rows.select("fltyid", "cost", "DebrisID", "Debris_Fin", "Debris_Struc", "Debris_Found", "Debris_Tot")


@query("q_restoration", """select fltyid, cost, cast(Min_Restor_Days as bigint) as Restor_Days_Min, cast(Max_Restor_Days as bigint) as Restor_Days_Max from deb left join restor_days on RestFnID = rkey""", ("prediction", "restor_days"), _DEBRIS)
def _(t):
    rows = damage.restoration(_wet_rows(t), t.lookup("restoration"), "occ", F.col("depth_in_struc"))
    return rows.select("fltyid", "cost", "Restor_Days_Min", "Restor_Days_Max")


@query("q_curve_qc", """select FltyId, Occ as occ, bid_b as curve_id, l.occupancy as curve_occ, case when l.fn_id is null then 'UNKNOWN_CURVE' else 'OCCUPANCY_MISMATCH' end as issue
    from gated left join library_wide l on l.kind = 'building' and l.fn_id = bid_b where bid_b is not null and (l.fn_id is null or l.occupancy <> Occ)""", ("facility", "library_wide"), FACILITY_TYPED)
def _(t):
    rotated = t.facility
    return damage.curve_qc(rotated, t.lookup("library"), "building", "BDDF_ID", "Occ", "FltyId")


@query("q_sample_depth", "select bid, GridName, Depth_Grid from sampled", ("inventory", "depth_cell"), ",".join([GRID_CTE, sampled_cte("inventory", "latitude", "longitude")]))
def _(t):
    points = t.inventory.select("bid", "latitude", "longitude")
    return raster.sample_depth(points, t.wet, GRIDS, "latitude", "longitude").select("bid", "GridName", "Depth_Grid")


@query("q_multi_raster", "select GridName, Depth_Grid, count(*) as n from sampled group by all", ("inventory", "depth_cell"), ",".join([GRID_CTE, sampled_cte("inventory", "latitude", "longitude")]))
def _(t):
    points = t.inventory.select("latitude", "longitude")
    return raster.sample_depth(points, t.wet, t.raster_meta, "latitude", "longitude").groupBy("GridName", "Depth_Grid").agg(F.count("*").alias("n"))


@query("q_cell_index", """select bid, raster_id, cast(floor((30.0::double - latitude) / 0.05::double) as bigint) as row, cast(floor((longitude + 85.0::double) / 0.05::double) as bigint) as col,
    floor((30.0::double - latitude) / 0.05::double) between 0 and 99 and floor((longitude + 85.0::double) / 0.05::double) between 0 and 79 as inside, cast(trunc((30.0::double - latitude) / 0.05::double) as bigint) as row_truncated
    from inventory, (values ('G1'), ('G2')) g(raster_id)""", ("inventory",))
def _(t):
    points = t.inventory.select("bid", "latitude", "longitude")
    cut = geodesy.cell_number("latitude", 30.0, 0.05, flip=True, truncate=True)
    return raster.cell_index(points, GRIDS, "latitude", "longitude").select("bid", "raster_id", "row", "col", "inside", cut.alias("row_truncated"))


@query("q_cell_hits", """select bid, raster_id, cast(floor((30.0::double - latitude) / 0.05::double) as bigint) as row, cast(floor((longitude + 85.0::double) / 0.05::double) as bigint) as col
    from inventory, (values ('G1'), ('G2')) g(raster_id) where floor((30.0::double - latitude) / 0.05::double) between 0 and 99 and floor((longitude + 85.0::double) / 0.05::double) between 0 and 79""", ("inventory",))
def _(t):
    return raster.cell_hits(t.inventory.select("bid", "latitude", "longitude"), t.raster_meta, "latitude", "longitude").select("bid", "raster_id", "row", "col")


@query("q_remap_codes", """select raster_id, rr as row, cc as col, case value when 1 then 1.0::double when 2 then 1.0::double when 3 then 3.0::double when 4 then 6.0::double when 5 then 9.0::double else -9999.0::double end as feet
    from cell""", ("cell",))
def _(t):
    return raster.remap_codes(t.cells("cell")).select("raster_id", "row", "col", F.col("value").alias("feet"))


@query("q_raster_bounds", "select raster_id, -85.0::double as \"left\", 30 - ph * height as bottom, -85 + pw * width as \"right\", 30.0::double as top from raster_meta", ("raster_meta",))
def _(t):
    return raster.raster_bounds(t.raster_meta)


@query("q_wet_tiles", """select bid, cost, raster_id from (select distinct bid, val_struct as cost, floor(floor((30.0::double - latitude) / 0.05::double) / 4) as tr, floor(floor((longitude + 85.0::double) / 0.05::double) / 4) as tc, latitude, longitude from inventory
      where floor((30.0::double - latitude) / 0.05::double) between 0 and 99 and floor((longitude + 85.0::double) / 0.05::double) between 0 and 79) p
    join (select distinct raster_id, floor(rr / 4) as tr, floor(cc / 4) as tc from depth_cell where value > 0 and not isnan(value) and value <> -9999) w using (tr, tc)""", ("inventory", "depth_cell"))
def _(t):
    points = t.inventory.select("bid", F.col("val_struct").alias("cost"), "latitude", "longitude").distinct()
    return raster.wet_tiles(points, t.cells(), GRIDS, tile=4).select("bid", "cost", "raster_id")


@query("q_selectivity", """select GridName as raster_id, count(*) as buildings, count(*) filter (where latitude between 25 and 30 and longitude < -81) as in_extent, count(*) filter (where Depth_Grid > 0) as on_wet_cell,
    round(count(*) filter (where latitude between 25 and 30 and longitude < -81) * 100 / count(*), 6) as in_extent_pct, round(count(*) filter (where Depth_Grid > 0) * 100 / count(*), 6) as on_wet_pct
    from sampled group by 1""", ("inventory", "depth_cell"), ",".join([GRID_CTE, sampled_cte("inventory", "latitude", "longitude")]))
def _(t):
    return rounded(raster.selectivity(t.inventory, t.wet, GRIDS))


_E2 = 1 / 298.257223563 * (2 - 1 / 298.257223563)


@query("q_utm", f"""select bid, latitude, longitude, zone, cast(round(e * 100) as bigint) as easting_cm, cast(round(n * 100) as bigint) as northing_cm from (
    select *, 0.9996::double * nu * (a + (1 - tt + cc) * a ** 3 / 6 + (5 - 18 * tt + tt ** 2 + 72 * cc - 58 * ep2) * a ** 5 / 120) + 500000 as e,
      0.9996::double * (m + nu * tan(phi) * (a ** 2 / 2 + (5 - tt + 9 * cc + 4 * cc ** 2) * a ** 4 / 24 + (61 - 58 * tt + tt ** 2 + 600 * cc - 330 * ep2) * a ** 6 / 720)) as n
    from (select *, 6378137.0::double / sqrt(1 - e2 * sin(phi) ** 2) as nu, tan(phi) ** 2 as tt, ep2 * cos(phi) ** 2 as cc, cos(phi) * (radians(longitude) - radians((zone * 6 - 183)::double)) as a,
        6378137.0::double * ((1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256) * phi - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024) * sin(2 * phi)
          + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024) * sin(4 * phi) - (35 * e2 ** 3 / 3072) * sin(6 * phi)) as m
      from (select bid, latitude, longitude, radians(latitude) as phi, cast(floor((longitude + 180) / 6) as int) % 60 + 1 as zone, {_E2!r}::double as e2, {_E2!r}::double / (1 - {_E2!r}::double) as ep2 from inventory) x) y) z""", ("inventory",))
def _(t):
    u = t.inventory.select("bid", "latitude", "longitude", geodesy.to_utm("latitude", "longitude").alias("u"))
    return u.select("bid", "latitude", "longitude", "u.zone", F.round(F.col("u.easting") * 100).cast("bigint").alias("easting_cm"),
                    F.round(F.col("u.northing") * 100).cast("bigint").alias("northing_cm"))


@query("q_json_records", """select FltyId, round(case when dry then 0.0::double when hit then fb * 100 end, 6) as BldgDmgPct, round(case when dry then 0.0::double when hit then fb * trunc(cost) end, 6) as BldgLossUSD, cbfips
    from assessed""", _ASSESS_TABLES, BUILDING_ASSESS)
def _(t):
    """The JSON texts are read back, so that their fields can be compared."""
    records = exports.to_json_records(assessed(t).select("FltyId", "BldgDmgPct", "BldgLossUSD", "cbfips"))
    parsed = F.from_json("record", "FltyId string, BldgDmgPct double, BldgLossUSD double, cbfips string")
    return records.select(parsed.alias("r")).select("r.*")
