"""Input tables of the registered queries, derived from the driver tables.

Each table is one SQL text that both engines run; ``{name}`` refers to a driver table or to
another entry.  Only inputs are shared this way: every operator has its own SQL check.
"""

from __future__ import annotations

from string import Formatter
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from floodmark.functions import fixed_values as fv
from floodmark.operators.damage import DEPTH_COLUMNS, Lookups, curves_long, curves_packed
from floodmark.operators.joins import Lookup, lookup
from floodmark.operators.raster import PackedCells, Raster, packed_cells

BASE = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
OCC = ",".join(fv.OCCUPANCIES)
FOUND_TYPES = "Slab,crawl, B ,Pier,I,??,S,slab on grade,7,C,Crawlspace,crawl space,5,F,w,Basement,4,P,pile,PILES,pier/pile,2, ,b"
STATE_CODES = "12,13,22,37,48"
STATE_NAMES = "Florida,Georgia,Louisiana,North_Carolina,Texas"
STATE_ABBRS = "FL,GA,LA,NC,TX"
EVENTS = "BERYL_2024,IDA_2021,HELENE_2024"


def pick(words: str, index: str) -> str:
    """SQL: the word at a zero-based index of a comma-separated list."""
    return f"split_part('{words}', ',', cast({index} as int) + 1)"


def pad(value: str, width: int) -> str:
    return f"lpad(cast({value} as string), {width}, '0')"


def soid_sql(occ: str, stories: str, basement: str) -> str:
    """SQL: specific occupancy of an occupancy, story count and basement test."""
    return f"""(
      case when {occ} = 'REL1' then 'RE1' else substr({occ}, 1, 1) || substr({occ}, 4) end
      || case
        when substr({occ}, 1, 4) = 'RES3' then case when {stories} > 4 then '5' when {stories} > 2 then '3' else '1' end
        when substr({occ}, 1, 4) = 'RES1' then
          case when {stories} > 3 then '3' when {stories} = floor({stories})
            then cast(cast(floor({stories}) as bigint) as string) else 'S' end
        when substr({occ}, 1, 4) = 'RES2' then '1'
        when {stories} > 6 then 'H' when {stories} > 3 then 'M' else 'L' end
      || case when {basement} then 'B' else 'N' end)"""


def _points(factor: str, offset: str) -> str:
    """SQL: the 29 depth columns of a curve."""
    return ", ".join(
        f"cast(least(100, {k + 4} * {factor} + {offset}) as double) as {c}" for k, c in DEPTH_COLUMNS.items()
    )


def _curve(set_name: str, factor: str, offset: int, where: str = "1 = 1") -> str:
    return f"select '{set_name}' as curve_set, soid, n, {factor} as f, {offset} as o from {{curve_key}} where {where}"


def _library(kind: str, steps: int) -> str:
    return f"select '{kind}' as kind, p_partkey, 1 + p_size % {steps} as f from {{part}}"


_CBFIPS = (
    f"{pick(STATE_CODES, 'l_suppkey % 5')} || {{dash}} || {pad('l_suppkey % 7 + 1', 3)} || "
    f"{pad('l_partkey % 40 + 1', 6)} || {pad('l_linenumber', 4)}"
)
_CONCAVE = [((0, 0), (4, 0)), ((4, 0), (4, 2)), ((4, 2), (2, 2)), ((2, 2), (2, 4)), ((2, 4), (0, 4)), ((0, 4), (0, 0))]
_SLANTED = [((0, 0), (4, 1)), ((4, 1), (1, 4)), ((1, 4), (0, 0))]


def _edges(shape, test: str) -> list[str]:
    return [
        f"select 'P' || cast(s_suppkey as string) as poly_id, x0 + cast({a} as double) / 20 as x1, y0 + cast({b} as double) / 20 as y1, "
        f"x0 + cast({c} as double) / 20 as x2, y0 + cast({d} as double) / 20 as y2 from {{poly_origin}} where {test}"
        for (a, b), (c, d) in shape
    ]


_SVI_MEASURES = ", ".join(
    f"cast(min(c_custkey) % {17 + i} as double) / 2 as {c}" for i, c in enumerate(fv.SVI_COLUMNS[4:])
)

SQL = {
    "inventory": f"""
        select 'B' || cast(l_orderkey as string) as bid,
          {pick(OCC, 'l_partkey % 33')} || case when l_partkey % 2 = 0 then '-1SNB' else '' end as occtype,
          case when l_orderkey % 101 = 0 then null else l_extendedprice * 10 end as val_struct,
          case when l_returnflag = 'N' then null else l_extendedprice * 5 end as val_cont,
          case when l_partkey % 53 = 0 then null else l_quantity * 50 + 500 end as sqft,
          cast(1 + l_suppkey % 9 as double) + cast(case when l_partkey % 7 = 0 then 1 else 0 end as double) / 2 as num_story,
          case when l_partkey % 59 = 0 then null else {pick(FOUND_TYPES, '(l_suppkey + l_partkey) % 24')} end as found_type,
          cast(l_linenumber % 8 as double) / 2 as found_ht,
          case when l_partkey % 97 = 0 then null else {_CBFIPS.format(dash="'-'")} end as cbfips,
          cast(25 as double) + cast(2 * (l_partkey % 600) + 1 as double) / 200 as latitude,
          cast(-85 as double) + cast(2 * (l_orderkey % 500) + 1 as double) / 200 as longitude,
          {pick(STATE_NAMES, 'l_suppkey % 5')} as state,
          cast(l_quantity as double) / 10 as ground_elv,
          cast(l_linenumber % 4 as bigint) as pop2pmo65, cast(l_linenumber % 6 + 1 as bigint) as pop2pmu65,
          l_orderkey % 3 as pop2amo65, l_orderkey % 5 as pop2amu65
        from {{lineitem}}""",
    "facility": f"""
        select 'F' || cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string)
            || '-' || cast(l_linenumber as string) as FltyId,
          {pick(OCC, 'l_partkey % 33')} as Occ,
          case when l_partkey % 41 = 0 then '' when l_partkey % 43 = 0 then ' NaN ' when l_partkey % 47 = 0 then 'abc'
            else ' ' || cast(cast(floor(l_extendedprice * 10) as bigint) as string) || '.75 ' end as Cost,
          cast(cast(floor(l_quantity) as bigint) * 50 + 500 as string) as Area,
          cast(1 + l_suppkey % 9 as string) || case when l_partkey % 7 = 0 then '.5' else '' end as NumStories,
          {pick('7,5,4,2', 'l_suppkey % 4')} as FoundationType,
          case when l_suppkey % 37 = 0 then null else cast(l_linenumber % 8 as string) end as FirstFloorHt,
          case l_linenumber % 4 when 0 then '' when 1 then '-1' when 2 then cast(l_partkey as string) || '.9' else 'null' end as ContentCost,
          case when l_linenumber = 3 then ' ' || cast(l_partkey as string) when l_linenumber = 5 then '9' || {pad('l_partkey', 9)} else '' end as BDDF_ID,
          case when l_linenumber = 2 then cast(l_partkey as string) else null end as CDDF_ID,
          case when l_linenumber = 4 then cast(l_partkey as string) else 'none' end as IDDF_ID,
          case l_linenumber % 3 when 0 then '-1' when 1 then '' else cast(l_suppkey * 1000 as string) end as InvCost,
          cast(25 as double) + cast(2 * (l_partkey % 600) + 1 as double) / 200 as Latitude,
          cast(-85 as double) + cast(2 * (l_orderkey % 500) + 1 as double) / 200 as Longitude
        from {{lineitem}}""",
    "cell": """
        select 'G1' as raster_id, o_orderkey % 100 as rr, o_custkey % 80 as cc,
          cast(cast(sum(o_orderkey) % 7 as bigint) as double) as value
        from {orders} group by o_orderkey % 100, o_custkey % 80
        union all
        select 'G2' as raster_id, o_orderkey % 100 as rr, o_custkey % 80 as cc,
          case when cast(sum(o_orderkey) % 11 as bigint) = 0 then cast(-9999 as double)
            when cast(sum(o_custkey) % 29 as bigint) = 0 then cast('NaN' as double)
            else cast(cast(sum(o_orderkey * 13 + o_custkey * 5) % 60 as bigint) as double) / 2 end as value
        from {orders} group by o_orderkey % 100, o_custkey % 80""",
    "depth_cell": """
        select raster_id, rr, cc, case when raster_id = 'G2' then value
            when value in (1, 2) then cast(1 as double) when value = 3 then cast(3 as double)
            when value = 4 then cast(6 as double) when value = 5 then cast(9 as double) else cast(-9999 as double) end as value
        from {cell}""",
    "raster_meta": """
        select raster_id, cast(-85 as double) as x0, cast(30 as double) as y0, cast(0.05 as double) as pw,
          cast(0.05 as double) as ph, max(cc) + 1 as width, max(rr) + 1 as height, cast(-9999 as double) as nodata
        from {cell} group by raster_id""",
    "curve_key": f"""
        select soid, occ, cast(min(p_partkey) % 5 as bigint) as n from (
          select {soid_sql('occ', 'stories', 'p_partkey % 2 = 0')} as soid, occ, p_partkey from (
            select p_partkey, {pick(OCC, 'p_partkey % 33')} as occ,
              cast(1 + p_size % 9 as double) + cast(case when p_partkey % 7 = 0 then 1 else 0 end as double) / 2 as stories
            from {{part}}) a) b
        group by soid, occ""",
    "curve_wide": f"select curve_set, soid as curve_key, cast(n + o as string) as ddf_id, {_points('f', 'o')} from ("
    + " union all ".join([
        # Some occupancies have no curve, so that every status and flag occurs.
        _curve("building_default", "1 + n", 0, "occ <> 'GOV2'"),
        _curve("building_coastal_a", "1 + n", 3, "substr(occ, 1, 3) = 'RES'"),
        _curve("building_coastal_v", "1 + n", 6, "substr(occ, 1, 3) = 'RES'"),
        _curve("content_default", "1 + (n + 1) % 5", 1, "occ <> 'GOV1'"),
        _curve("content_coastal_a", "1 + (n + 1) % 5", 4, "substr(occ, 1, 3) = 'RES'"),
        _curve("content_coastal_v", "1 + (n + 1) % 5", 7, "substr(occ, 1, 3) = 'RES'"),
        _curve("inventory_default", "1 + (n + 2) % 5", 2,
               "occ in (" + ",".join(f"'{o}'" for o in fv.INVENTORY_OCCUPANCIES if o != "IND6") + ")"),
    ]) + ") a",
    "library_wide": f"select kind, cast(p_partkey as string) as fn_id, {pick(OCC, 'p_partkey % 33')} as occupancy, {_points('f', '0')} from ("
    + " union all ".join([_library("building", 6), _library("content", 4), _library("inventory", 3)]) + ") a",
    "debris_rate": f"""
        select occ || part_key as DebrisID, cast(max(p_size) as double) / 4 as Finishes,
          cast(min(p_size) as double) / 2 as Structure, cast(max(p_partkey) % 20 as double) as Foundation
        from (
          select p_partkey, p_size, occ, case when occ = 'RES1' and c > 9 then 'B' else 'NB' end
              || {pick('FT0,FT1,FT4,FT8,FT12,SG0,SG1,SG4,SG8,SG12,SG0,SG4,SG6,SG8', 'c')} as part_key
          from (select p_partkey, p_size, {pick(OCC, 'p_partkey % 33')} as occ,
              cast(floor(cast(p_partkey as double) / 33) as bigint) % 14 as c from {{part}}) a) b
        where occ <> 'COM4' group by occ || part_key""",
    "restor_days": f"""
        select occ || band as RestFnID, max(p_size) as Min_Restor_Days, max(p_size) + 30 as Max_Restor_Days
        from (select p_size, {pick(OCC, 'p_partkey % 33')} as occ,
            {pick('1,4,8,12,24', 'cast(floor(cast(p_partkey as double) / 33) as bigint) % 5')} as band from {{part}}) a
        where occ <> 'COM5' group by occ || band""",
    "econ": f"""
        select occ as Occupancy, cast(max(p_size) * 10 as double) as AnnualSalesPerSqFt,
          cast(1 + min(p_size) % 13 as double) as BusinessInvPctofSales
        from (select p_size, {pick(OCC, 'p_partkey % 33')} as occ from {{part}}) a
        where occ in ({",".join(f"'{o}'" for o in fv.INVENTORY_OCCUPANCIES)}) group by occ""",
    "prediction": f"""
        select fltyid, occ, cost, depth_grid, depth_grid - found_ht as depth_in_struc, bldgdmgpct,
          cast(floor(bldgdmgpct * cost / 100) as double) as bldglossusd, event, adv, flc, state, county_fips5, cbfips,
          pop2pmo65, pop2pmu65, pop2amo65, pop2amu65, o65disable, u65disable
        from (
          select 'B' || cast(l_orderkey as string) as fltyid, {pick(OCC, 'l_partkey % 33')} as occ,
            floor(l_extendedprice) * cast(1 as double) as cost,
            cast({pick('0,1,3,6,9,4,13', 'l_linenumber % 7')} as double) as depth_grid,
            cast(l_linenumber % 8 as double) / 2 as found_ht,
            case when l_linenumber % 7 = 0 then cast(0 as double) when l_partkey % 89 = 0 then null
              else cast((l_partkey * 7 + l_suppkey * 3) % 201 as double) / 2 end as bldgdmgpct,
            {pick(EVENTS, 'l_suppkey % 3')} as event, cast(8 + l_linenumber % 5 as int) as adv,
            {pick('CAE,V', 'l_orderkey % 2')} as flc, {pick(STATE_ABBRS, 'l_suppkey % 5')} as state,
            {pick(STATE_CODES, 'l_suppkey % 5')} || {pad('l_suppkey % 7 + 1', 3)} as county_fips5,
            case when l_partkey % 97 = 0 then null else {_CBFIPS.format(dash="''")} end as cbfips,
            cast(l_linenumber % 4 as bigint) as pop2pmo65, cast(l_linenumber % 6 + 1 as bigint) as pop2pmu65,
            l_orderkey % 3 as pop2amo65, l_orderkey % 5 as pop2amu65,
            cast(l_partkey % 40 as double) / 64 as o65disable, cast(l_suppkey % 10 as double) / 64 as u65disable
          from {{lineitem}}) a""",
    "xwalk": f"""
        select 'B' || cast(o_orderkey as string) as fltyid,
          {pick(STATE_CODES, 'o_custkey % 5')} || {pad('o_custkey % 7 + 1', 3)} || {pad('o_orderkey % 40 + 1', 6)} || '1001' as cbfips
        from {{orders}} where o_orderkey % 13 <> 0""",
    "svi": f"""
        select case when min(c_custkey) % 3 = 0 then null else st_abbr end as ST_ABBR,
          case when min(c_custkey) % 3 = 0 then null else 'County ' || substr(fips, 1, 5) end as COUNTY,
          fips as FIPS, cast(count(*) * 1000 as double) as E_TOTPOP, {_SVI_MEASURES}
        from (select c_custkey, {pick(STATE_ABBRS, 'c_custkey % 5')} as st_abbr,
            {pick(STATE_CODES, 'c_custkey % 5')} || {pad('c_custkey % 7 + 1', 3)} || {pad('c_custkey % 40 + 1', 6)} as fips
          from {{customer}}) a
        where substr(fips, 3, 3) <> '004' group by st_abbr, fips""",
    "svi_county": f"""
        select case when min(c_custkey) % 3 = 0 then null else st_abbr end as ST_ABBR,
          case when min(c_custkey) % 3 = 0 then null else 'County ' || fips end as COUNTY,
          fips as FIPS, cast(count(*) * 1000 as double) as E_TOTPOP, {_SVI_MEASURES}
        from (select c_custkey, {pick(STATE_ABBRS, 'c_custkey % 5')} as st_abbr,
            {pick(STATE_CODES, 'c_custkey % 5')} || {pad('c_custkey % 7 + 1', 3)} as fips from {{customer}}) a
        where substr(fips, 3, 3) <> '004' group by st_abbr, fips""",
    "vacancy": f"""
        select st, co, tr, case when min(c_custkey) % 9 = 0 then null else cast(count(*) as bigint) end as units
        from (select {pick(STATE_CODES, 'c_custkey % 5')} as st, {pad('c_custkey % 7 + 1', 3)} as co,
            {pad('c_custkey % 40 + 1', 6)} as tr, c_custkey from {{customer}}) a
        where co <> '005' group by st, co, tr""",
    "vacancy_doc": """
        select '[["UNITS","state","county","tract"],[' || coalesce('"' || cast(units as string) || '.0"', 'null')
          || ',"' || st || '","' || co || '","' || tr || '"]]' as doc
        from {vacancy}""",
    "feature_page": f"""
        select '{{{{"features":[' || '{{{{"attributes":{{{{"FIPS":"' || {pad('s_suppkey', 11)} || '","RPL_THEMES":' || cast(s_suppkey % 8 as string)
          || '.5}}}}}}}},{{{{"attributes":{{{{"FIPS":"' || {pad('s_suppkey + 7', 11)} || '","RPL_THEMES":null}}}}}}}}],"exceededTransferLimit":true}}}}' as doc
        from {{supplier}}""",
    "feature_line": """
        select state, case
            when ln % 7 = 1 and pk % 5 = 0 then '   '
            when ln % 7 = 2 and pk % 5 = 0 then '{{"type":"Metadata","properties":{{"bid":"M"}}}}'
            when ln % 7 = 3 and pk % 5 = 0 then substr(body, 1, 40)
            when ln % 7 = 4 and pk % 5 = 0 then '[1, 2]'
            else body end as line
        from (select state, ln, pk, '{{"type":"Feature","properties":{{"bid":"' || bid || '","occtype":"' || occtype
            || '","sqft":' || sqft || ',"num_story":' || num_story || ',"FOUND_TYPE":"x","found_ht":1.5,"cbfips":null}},"geometry":{{"type":"'
            || case when pk % 3 = 0 then 'Polygon' else 'Point' end || '","coordinates":[' || lon || ',' || lat || ']}}}}' as body
          from {raw_feature}) a""",
    "raw_feature": f"""
        select l_linenumber as ln, l_partkey as pk, 'B' || cast(l_orderkey as string) as bid,
          {pick(OCC, 'l_partkey % 33')} as occtype, cast(l_suppkey * 10 + 500 as string) as sqft,
          cast(1 + l_suppkey % 9 as string) as num_story, {pick(STATE_NAMES, 'l_suppkey % 5')} as state,
          '-' || cast(80 + l_orderkey % 10 as string) || '.25' as lon, cast(25 + l_partkey % 6 as string) || '.5' as lat
        from {{lineitem}}""",
    "state_token": f"""
        select c_custkey as pos, case c_custkey % 5
            when 0 then {pick('FL,al,ny,Dc,LA,NC,TX,GA', 'c_custkey % 8')}
            when 1 then {pick('12,01,36,11,22,37,48,13', 'c_custkey % 8')}
            when 2 then {pick(' Florida ,ALABAMA,New_York,District-of  Columbia,louisiana,North Carolina,texas,Georgia', 'c_custkey % 8')}
            when 3 then {pick('Atlantis,99,ZZ,Nowhere', 'c_custkey % 4')}
            else {pick('north_carolina,New York,Texas,01', 'c_custkey % 4')} end as token
        from {{customer}}""",
    "storm": f"""
        select o_orderkey, cast(2020 + o_custkey % 6 as int) as year,
          case o_orderkey % 6 when 0 then 'AL' || {pad('o_custkey % 30', 2)} || '24' when 1 then 'al' || cast(o_custkey % 30 as string)
            when 2 then ' EP' || {pad('o_custkey % 30', 2)} || '2023 ' when 3 then 'X' || cast(o_custkey % 10 as string)
            when 4 then 'al' || {pad('o_custkey % 30', 2)} || '019' else 'Storm Nine' end as storm_id,
          {pick(' beryl ,Ida,HELENE,debby', 'o_custkey % 4')} as storm_name, cast(o_orderkey % 60 as int) as adv
        from {{orders}}""",
    "advisory_file": f"""
        select {pick('AL02,AL09,AL14', 'o_custkey % 3')} || '24' as storm, cast(o_orderkey % 35 as int) as adv
        from {{orders}} where o_orderkey % 35 > 2""",
    "truth": f"""
        select event, state, county_fips5, case when cast(substr(county_fips5, 3, 3) as int) % 2 = 0 then null else cast(sum(c_custkey) % 900 as double) end as actual_shelter,
          case when county_fips5 = '12003' then null else cast(count(*) * 3 as double) end as planned_shelter
        from (select c_custkey, {pick(EVENTS, 'c_custkey % 3')} as event, {pick(STATE_ABBRS, 'c_custkey % 5')} as state,
            {pick(STATE_CODES, 'c_custkey % 5')} || {pad('c_custkey % 9 + 1', 3)} as county_fips5 from {{customer}}) a
        group by event, state, county_fips5""",
    "census": f"""
        select county_fips5, cast(count(*) * 1000 as bigint) as population
        from (select {pick(STATE_CODES, 'c_custkey % 5')} || {pad('c_custkey % 7 + 1', 3)} as county_fips5 from {{customer}}) a
        group by county_fips5""",
    "poly_origin": """
        select s_suppkey, cast(-85 as double) + cast(s_suppkey % 20 as double) / 4 as x0,
          cast(25 as double) + cast(cast(floor(cast(s_suppkey as double) / 20) as bigint) % 20 as double) / 4 as y0 from {supplier}""",
    "edge": " union all ".join(_edges(_CONCAVE, "s_suppkey % 3 <> 0") + _edges(_SLANTED, "s_suppkey % 3 = 0")),
    # Around the first polygons: some boxes lie inside, some cross a border, some miss, every seventh is far away.
    "extent": """
        select 'E' || cast(n_nationkey as string) as raster_id, left_x, bottom, left_x + 0.05e0 + cast(n_nationkey % 4 as double) / 10 as right_x,
          bottom + 0.05e0 + cast(n_nationkey % 3 as double) / 10 as top
        from (select n_nationkey, case when n_nationkey % 7 = 0 then cast(-60 as double) else cast(-85 as double) end + cast(n_nationkey % 20 as double) / 4
            + cast(n_nationkey % 5 - 2 as double) * 0.06e0 as left_x, cast(25 as double) + cast(n_nationkey % 3 - 1 as double) / 10 as bottom
          from {nation}) a""",
    "failed_unit": """
        select 'P' || cast(s_suppkey as string) as poly_id from {supplier} where s_suppkey % 3 = 1""",
    "boundary": f"""
        select st || co as GEOID, 'Boundary ' || co as NAME from (
          select {pick(STATE_CODES, 's_suppkey % 5')} as st, {pad('s_suppkey % 9 + 1', 3)} as co from {{supplier}}) a
        group by st, co""",
}

GRIDS = [Raster(name, -85.0, 30.0, 0.05, 0.05, 80, 100) for name in ("G1", "G2")]


def _names(text: str) -> list[str]:
    return list(dict.fromkeys(name for _, name, _, _ in Formatter().parse(text) if name))


def with_tables(*names: str, extra: str = "") -> str:
    """WITH clause that defines the named inputs and whatever they use."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in BASE or name in order:
            return
        for used in _names(SQL[name]):
            visit(used)
        order.append(name)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({SQL[n].format(**{u: u for u in _names(SQL[n])})})" for n in order]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


_LOOKUPS: WeakKeyDictionary = WeakKeyDictionary()


def kept(df: DataFrame) -> Lookup:
    """A checked lookup; within the bound it is cached, as the queries share it."""
    table = lookup(df)
    return Lookup(df.persist(), True) if table.bounded else table


class Tables:
    """Input frames of one scale-factor folder; lookups are size-checked once per session."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        if name not in SQL:
            raise AttributeError(name)
        text = SQL[name]
        return self.spark.sql(text, **{u: getattr(self, u) for u in _names(text)})

    def cells(self, name: str = "depth_cell") -> DataFrame:
        return getattr(self, name).withColumnsRenamed({"rr": "row", "cc": "col"})

    def _once(self, key: str, make):
        store = _LOOKUPS.setdefault(self.spark, {})
        if (self.dir, key) not in store:
            store[(self.dir, key)] = make()
        return store[(self.dir, key)]

    @property
    def wet(self):
        return self._once("wet", lambda: PackedCells(kept(packed_cells(self.cells(), GRIDS))))

    def lookup(self, name: str) -> Lookup:
        """One table of the lookups; the others are not computed for it."""
        return self._once(name, lambda: kept({
            "curves": lambda: curves_long(self.curve_wide, ["curve_set", "curve_key"], ["ddf_id"]),
            "debris": lambda: self.debris_rate, "restoration": lambda: self.restor_days, "econ": lambda: self.econ,
            "library": lambda: self.library,
        }[name]()))

    @property
    def lookups(self) -> Lookups:
        return Lookups(**{name: self.lookup(name) for name in ("curves", "debris", "restoration", "econ", "library")})

    @property
    def library(self) -> DataFrame:
        return curves_packed(self.library_wide, ["kind", "fn_id"], ["occupancy"])

    @property
    def extents(self) -> DataFrame:
        return self.extent.withColumnsRenamed({"left_x": "left", "right_x": "right"})
