import duckdb
import pytest

import __spark_entry__ as entry
import check
from catalog.fixtures import BASE

SF = "/root/testdata/sf0.001"
NAMES = ["q_inventory_dedup", "q_assess", "q_county_loss", "q_geo_rollup", "q_mass_care", "q_point_in_polygon", "q_extent_states", "q_completeness_gate", "q_event_states", "q_json_records", "q_cell_hits"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert check.rows(df.collect(), df.columns, sorted(names)) == check.rows(cur.fetchall(), names, sorted(names))


def test_entry_and_registry(spark):
    assert entry.entry(spark).columns == ["FIPS", "GridName", "buildings", "exposed", "building_loss"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    own = {name for name in entry.queries() if name.startswith("q_")}
    assert own <= set(entry.oracle_sql())
