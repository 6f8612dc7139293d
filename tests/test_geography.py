import numpy as np
import pandas as pd
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from floodmark.operators import geography as geo
from floodmark.operators.quantiles import quantiles_of_counts
from floodmark.sources import demographics

LABELS = ["a", "b", "c", "d"]


def test_exact_quantiles_with_a_hot_group(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({
        "k": ["hot"] * 6000 + ["one"] + ["two"] * 2 + ["neg"] * 500,
        "v": np.concatenate([rng.lognormal(8, 2, 6000), [5.0], [1.0, 2.0], rng.normal(-3, 40, 500).round(1)]),
    })
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([("one", None), ("nul", None)], "k string, v double"))
    counts = df.groupBy("k", F.col("v").alias("value")).agg(F.count("*").alias("n"))
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = quantiles_of_counts(counts, ["k"], probs).toPandas().set_index("k")
    want = pdf.groupby("k")["v"].quantile(list(probs.values())).unstack()
    want.columns = list(probs)
    pd.testing.assert_frame_equal(got.sort_index(), want.sort_index(), check_names=False)


def test_rollup_against_pandas(spark):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({
        "fltyid": [str(i) for i in range(n)], "depth_grid": rng.choice([0.0, 1, 3, 6, 9, 2], n),
        "bldgdmgpct": rng.integers(0, 201, n) / 2, "bldglossusd": rng.integers(0, 9000, n).astype(float),
        "cbfips": rng.choice(["120570001001001", "120570002001001", "130010001001001"], n, p=[0.8, 0.1, 0.1]),
    })
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([("x", 9.0, 1.0, 1.0, None)], "fltyid string, depth_grid double, bldgdmgpct double, bldglossusd double, cbfips string"))
    got = geo.geo_rollup(df, "Census Tract", LABELS).toPandas().set_index("FIPS").sort_index()
    g = pdf.groupby(pdf.cbfips.str[:11])
    assert (got.Total_Num_Building == g.size()).all()
    assert (got.Total_Num_Building_A == g.depth_grid.apply(lambda s: (s >= 9).sum())).all()
    assert (got.Total_Num_Building_SurgeHeight_1 == g.depth_grid.apply(lambda s: (s == 1).sum())).all()
    assert (got.Total_Num_Building_Damage_10pct == g.bldgdmgpct.apply(lambda s: ((s > 0) & (s <= 10)).sum())).all()
    assert np.allclose(got.Building_Damage_Pct_Mean, g.bldgdmgpct.mean())
    assert np.allclose(got.Building_Loss_USD_75th, g.bldglossusd.quantile(0.75))
    county = geo.geo_rollup(df, "county", LABELS, quantiles=False)
    assert {r.FIPS for r in county.collect()} == {"12057", "13001"} and "Python" not in plan_of(county)
    with pytest.raises(ValueError, match="geography"):
        geo.geo_rollup(df, "state", LABELS)


def test_names_fill_inside_the_county_only(spark):
    rows = [("12", "12001", "12001000100", None, None), ("12", "12001", "12001000200", "FL", "A"), ("12", "12001", "12001000300", None, None),
            ("12", "12003", "12003000100", None, None)]
    df = spark.createDataFrame(rows, "State_FIPS string, County_FIPS string, FIPS string, ST_ABBR string, COUNTY string")
    assert [r.ST_ABBR for r in geo.fill_names(df).orderBy("FIPS").collect()] == ["FL", "FL", "FL", None]


def test_vacancy_and_match_rate(spark):
    docs = spark.createDataFrame([('[["V","state","county"],["12.0","12","057"],[null,"12","001"],["","13","001"]]',)], "doc string")
    got = {r.FIPS: r.Num_Vacant_Units for r in demographics.parse_vacancy(docs).collect()}
    assert got == {"12057": 12, "12001": 0, "13001": 0}
    geos = spark.createDataFrame([("12057",), ("99999",)], "FIPS string")
    joined = geo.attach_vacancy(geos, demographics.parse_vacancy(docs))
    assert {r.FIPS: r.Num_Vacant_Units for r in joined.collect()} == {"12057": 12, "99999": 0}
    none = spark.createDataFrame([], "x string")
    assert geo.match_rate(none, "x").first().match_pct == 0
