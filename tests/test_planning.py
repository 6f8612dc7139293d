import pytest
from pyspark.sql import functions as F

from floodmark.operators import planning, validation


def test_mass_care_rounds_half_to_even(spark):
    cols = ", ".join(f"pop_{k}_{z} double" for k in ("affected", "impacted") for z in ("low", "medium", "high"))
    df = spark.createDataFrame([(100.0, 100.0, 100.0, 50.0, 50.0, 50.0), (0.0, 0.0, 0.0, 0.0, 0.0, 2.53 * 100)], cols)
    a, b = planning.mass_care(df).collect()
    assert (a.hh_shelter_low, a.hh_shelter_medium, a.hh_shelter_high) == (0, 2, 2)
    assert (a.hh_feeding_low, a.hh_feeding_high, a.total_shelter_est) == (2, 6, 4)
    assert b.hh_shelter_high == 13
    checks = {r.check: r.violations for r in planning.sanity_checks(df, None).collect()}
    assert checks["impacted_le_affected_high"] == 1 and checks["zero_affected_zero_impacted"] == 1
    assert planning.pct_impact(df).first().pct_impacted_high == 60.0


def test_zone_pivot_fills_absent_zones(spark):
    rows = [("E", "1", "RES1", 13.0, 50.0), ("E", "1", "RES1", 5.0, 0.0), ("E", "1", "COM1", 13.0, 50.0), ("E", "2", "RES2", 0.0, 0.0), ("E", "3", "RES2", 0.0, 20.0)]
    df = spark.createDataFrame(rows, "event string, county_fips5 string, occ string, depth_grid double, bldgdmgpct double")
    wide = {r.county_fips5: r for r in planning.zones_wide(planning.affected_impacted(df)).collect()}
    assert set(wide) == {"1", "3"}
    assert (wide["1"].pop_affected_high, wide["1"].pop_impacted_low, wide["1"].pop_affected_medium) == (2.53, 0.0, 0.0)
    assert (wide["3"].pop_affected_medium, wide["3"].pop_impacted_medium) == (0.0, 2.53)
    variants = planning.threshold_sensitivity(df).where("zone = 'HIGH'").select("variant", "bldg_affected")
    assert {r.variant: r.bldg_affected for r in variants.collect()} == {"default": 1, "tight": 1, "very_low": 1}


def test_error_metrics_and_top(spark):
    est = spark.createDataFrame([("E", "1", 10), ("E", "2", 30), ("F", "3", 5), ("F", "4", 9)], "event string, county_fips5 string, total_shelter_est long")
    truth = spark.createDataFrame([("E", "1", 12.0, None), ("E", "2", None, 20.0), ("F", "3", 5.0, 1.0), ("F", "4", None, None)],
                                  "event string, county_fips5 string, actual_shelter double, planned_shelter double")
    joined = validation.join_truth(est, truth)
    m = validation.error_metrics(joined).first()
    assert m.n == 3 and m.rmse == pytest.approx((104 / 3) ** 0.5) and m.mae == pytest.approx(4)
    mean = (12 + 20 + 5) / 3
    assert m.r2 == pytest.approx(1 - 104 / sum((y - mean) ** 2 for y in (12, 20, 5)))
    assert validation.error_metrics(joined, ["event"]).where("event = 'F'").first().r2 is None
    top = validation.top_discrepancies(joined, 2).collect()
    assert [(r.county_fips5, r.direction) for r in top] == [("2", "OVER"), ("1", "UNDER")]


def test_latest_advisories_by_number(spark):
    df = spark.createDataFrame([("A", 9), ("A", 10), ("A", 11), ("A", 8), ("B", 1), ("A", 11)], "s string, adv int")
    got = {(r.s, r.adv) for r in planning.latest_advisories(df, "s", "adv").collect()}
    assert got == {("A", 9), ("A", 10), ("A", 11), ("B", 1)}


def test_evolution_and_habitability(spark):
    df = spark.createDataFrame([("E", "1", 9, 5.0), ("E", "1", 10, 7.0), ("E", "1", 10, 1.0)], "event string, county_fips5 string, adv int, bldglossusd double")
    rows = {r.adv: r for r in planning.advisory_evolution(df).collect()}
    assert rows[9].loss_delta is None and (rows[10].buildings_delta, rows[10].loss_delta) == (1, 3.0)
    frac = spark.createDataFrame([("1", 0.5, 0.5)], "FIPS string, frac_slight double, frac_complete double")
    usable = {"slight": {"FU": 0.5, "PU": 0.5, "NU": 0.0}, "complete": {"FU": 0.0, "PU": 0.0, "NU": 1.0}}
    got = {r.risk: r.bhi for r in planning.habitability(frac, usable, {"low": {"FU": 0.0, "PU": 0.2}, "high": {"FU": 0.1, "PU": 0.4}}).collect()}
    assert got == pytest.approx({"low": 0.55, "high": 0.625})
    cov = validation.coverage(df.select("event", F.lit("FL").alias("state"), "county_fips5"),
                              spark.createDataFrame([("E", "FL", "1"), ("E", "FL", "2")], "event string, state string, county_fips5 string"))
    assert validation.coverage_rate(cov).first().coverage_rate == 0.5


def test_each_building_counts_once_per_run(spark):
    cols = "event string, adv int, flc string, fltyid string, state string, county_fips5 string, occ string, depth_grid double, bldgdmgpct double"
    rows = [("E", 8, "CAE", "a", "FL", "1", "RES1", 5.0, 20.0), ("E", 8, "CAE", "a", "FL", "1", "RES1", 5.0, 30.0), ("E", 8, "V", "a", "FL", "1", "RES1", 5.0, 40.0), ("E", 9, "CAE", "a", "FL", "1", "RES1", 5.0, 5.0)]
    runs = planning.per_run(spark.createDataFrame(rows, cols))
    assert sorted((r.adv, r.flc, r.bldgdmgpct) for r in runs.collect()) == [(8, "CAE", 30.0), (8, "V", 40.0), (9, "CAE", 5.0)]
    by = [*planning.RUN, "county_fips5"]
    got = {(r.adv, r.flc): (r.bldg_affected, r.bldg_impacted) for r in planning.affected_impacted(runs, by, min_damage=10.0).collect()}
    assert got == {(8, "CAE"): (1, 1), (8, "V"): (1, 1), (9, "CAE"): (1, 0)}
