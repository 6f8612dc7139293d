"""Zones, mass care, validation, demand and evolution."""

from pyspark.sql import functions as F

from floodmark.functions import fixed_values as fv, hazard
from floodmark.operators import geography as geo, planning, validation
from floodmark.plans.assess import assess
from floodmark.plans.planning import planning_table, validated

from .damage_queries import _ASSESS_TABLES, BUILDING_ASSESS
from .fixtures import GRIDS
from .inventory_queries import buildings, first_prediction_sql
from .registry import query, rounded

ZONE = """case when depth_grid > {h} then 'HIGH' when depth_grid >= {m} then 'MEDIUM' when depth_grid >= {l} then 'LOW'
    when bldgdmgpct > 35 then 'HIGH' when bldgdmgpct > 15 then 'MEDIUM' when bldgdmgpct > 0 then 'LOW' else 'NONE' end"""
ZONE_SQL = ZONE.format(h=12, m=9, l=4)
LONG_CTE = f"""zoned AS (select *, {ZONE_SQL} as zone from prediction where occ like 'RES%'),
  long AS (select event, county_fips5, zone, count(*) filter (where depth_grid > 0) as bldg_affected, count(*) filter (where bldgdmgpct > 0) as bldg_impacted,
    2.53::double * count(*) filter (where depth_grid > 0) as pop_affected, 2.53::double * count(*) filter (where bldgdmgpct > 0) as pop_impacted from zoned where zone <> 'NONE' group by 1, 2, 3)"""
WIDE_CTE = LONG_CTE + ", wide AS (select event, county_fips5, " + ", ".join(
    f"coalesce(sum({v}) filter (where zone = '{z}'), 0) as {v}_{z.lower()}" for v in ("pop_affected", "pop_impacted") for z in ("LOW", "MEDIUM", "HIGH")
) + " from long group by 1, 2)"
CARE_CTE = WIDE_CTE + ", care AS (select *, hh_shelter_low + hh_shelter_medium + hh_shelter_high as total_shelter_est from (select *, " + ", ".join(
    f"cast(round_even(pop_impacted_{z.lower()} * {r[z]}::double, 0) as bigint) as {n}_{z.lower()}"
    for n, r in (("hh_shelter", {"LOW": 0.01, "MEDIUM": 0.03, "HIGH": 0.05}), ("hh_feeding", {"LOW": 0.03, "MEDIUM": 0.07, "HIGH": 0.12})) for z in ("LOW", "MEDIUM", "HIGH")
) + " from wide) w)"
TRUTH_CTE = CARE_CTE + """, joined AS (select c.*, state, actual_shelter, planned_shelter, coalesce(actual_shelter, planned_shelter) as shelter_pop,
    total_shelter_est - coalesce(actual_shelter, planned_shelter) as error from care c join truth t using (event, county_fips5) where coalesce(actual_shelter, planned_shelter) is not null)"""


def wide(t):
    return planning.zones_wide(planning.affected_impacted(t.prediction))


@query("q_damage_state", "select fltyid, bldgdmgpct, case when bldgdmgpct < 0 then null when bldgdmgpct < 15 then 'Slight' when bldgdmgpct < 40 then 'Moderate' when bldgdmgpct < 60 then 'Extensive' when bldgdmgpct <= 100 then 'Complete' end as state from prediction", ("prediction",))
def _(t):
    return t.prediction.select("fltyid", "bldgdmgpct", hazard.damage_state("bldgdmgpct").alias("state"))


@query("q_intensity", f"select fltyid, depth_grid, bldgdmgpct, {ZONE_SQL} as zone from prediction", ("prediction",))
def _(t):
    return t.prediction.select("fltyid", "depth_grid", "bldgdmgpct", hazard.intensity("depth_grid", "bldgdmgpct").alias("zone"))


@query("q_bands", "select event_id, value, case when value > 25 then 'HIGH' when value > 15 then 'MEDIUM' when value > 10 then 'LOW' else 'NONE' end as rain, case when value >= 51 then 'HIGH' when value >= 21 then 'MEDIUM' else 'LOW' end as outage from events")
def _(t):
    rain = [("HIGH", 25.0, False), ("MEDIUM", 15.0, False), ("LOW", 10.0, False)]
    outage = [("HIGH", 51.0, True), ("MEDIUM", 21.0, True)]
    return t.events.select("event_id", "value", hazard.classify_bands("value", rain, "NONE").alias("rain"),
                           hazard.classify_bands("value", outage, "LOW").alias("outage"))


@query("q_severity", """select o_orderkey, case when d >= 0.35::double or m >= 0.35::double then 'HIGH' when d >= 0.11::double or m >= 0.16::double then 'MEDIUM' else 'LOW' end as both_criteria,
    case when d >= 0.35::double then 'HIGH' when d >= 0.11::double then 'MEDIUM' else 'LOW' end as destroyed_only from (select o_orderkey, (o_orderkey % 101) / 100 as d, (o_custkey % 101) / 100 as m from orders) a""")
def _(t):
    d, m = F.col("o_orderkey") % 101 / 100, F.col("o_custkey") % 101 / 100
    return t.orders.select("o_orderkey", hazard.severity(d, m).alias("both_criteria"), hazard.severity(d).alias("destroyed_only"))


# Usability and seeking weights are run parameters; these are example values.
USABILITY = {
    "slight": {"FU": 1.0, "PU": 0.0, "NU": 0.0}, "moderate": {"FU": 0.75, "PU": 0.25, "NU": 0.0},
    "extensive": {"FU": 0.0, "PU": 0.5, "NU": 0.5}, "complete": {"FU": 0.0, "PU": 0.0, "NU": 1.0},
}
SEEKING = {"low": {"FU": 0.0, "PU": 0.125}, "high": {"FU": 0.0625, "PU": 0.5}}
FRACTION_CTE = f"""frac AS (select substr(cbfips, 1, 5) as FIPS, count(*) as buildings, {', '.join(
    f"count(*) filter (where bldgdmgpct >= {lo} and bldgdmgpct {'<=' if s == 'Complete' else '<'} {hi}) / count(*) as frac_{s.lower()}" for s, lo, hi in (("Slight", 0.0, 15.0), ("Moderate", 15.0, 40.0), ("Extensive", 40.0, 60.0), ("Complete", 60.0, 100.0)))},
    cast(max(case {ZONE_SQL} when 'HIGH' then 3 when 'MEDIUM' then 2 when 'LOW' then 1 else 0 end) as int) as max_intensity from prediction where cbfips is not null group by 1)"""


@query("q_state_fractions", """select FIPS, buildings, round(frac_slight, 6) as frac_slight, round(frac_moderate, 6) as frac_moderate, round(frac_extensive, 6) as frac_extensive, round(frac_complete, 6) as frac_complete, max_intensity,
    round(frac_complete, 6) as pct_destroyed, round(frac_extensive, 6) as pct_major, case when frac_complete >= 0.35 or frac_extensive >= 0.35 then 'HIGH' when frac_complete >= 0.11 or frac_extensive >= 0.16 then 'MEDIUM' else 'LOW' end as severity from frac""", ("prediction",), FRACTION_CTE)
def _(t):
    return rounded(planning.state_fractions(t.prediction, "county"))


@query("q_habitability", """select FIPS, risk, round(frac_slight * fu + frac_moderate * (0.75 * fu + 0.25 * pu) + frac_extensive * (0.5 * pu + 0.5) + frac_complete, 6) as bhi
    from frac, (values ('low', 0.0::double, 0.125::double), ('high', 0.0625::double, 0.5::double)) r(risk, fu, pu)""", ("prediction",), FRACTION_CTE)
def _(t):
    return rounded(planning.habitability(planning.state_fractions(t.prediction, "county"), USABILITY, SEEKING))


@query("q_svi_rate", """select c_custkey, svi, case when svi < 0.4 then 0.0::double when svi < 0.8 then 0.025::double when svi <= 1 then 0.05::double end as rate, c_custkey * 0.25::double * (case when svi < 0.4 then 0.0::double when svi < 0.8 then 0.025::double when svi <= 1 then 0.05::double end) as seekers
    from (select c_custkey, (c_custkey % 17)::double / 16 as svi from customer) a""")
def _(t):
    rows = t.customer.select("c_custkey", ((F.col("c_custkey") % 17).cast("double") / 16).alias("svi"))
    return rows.select("c_custkey", "svi", hazard.svi_rate("svi").alias("rate"), hazard.shelter_seekers("c_custkey", F.lit(0.25), "svi").alias("seekers"))


@query("q_inundation", "select bid, ground_elv + found_ht as ffe, 3.0 > ground_elv as yard_wet, 3.0 > ground_elv + found_ht as structure_wet from inventory", ("inventory",))
def _(t):
    return t.inventory.select("bid", hazard.inundation_flags("ground_elv", "found_ht", F.lit(3.0)).alias("f")).select("bid", "f.*")


@query("q_affected_impacted", "select event, county_fips5, zone, bldg_affected, bldg_impacted, round(pop_affected, 6) as pop_affected, round(pop_impacted, 6) as pop_impacted from long", ("prediction",), LONG_CTE)
def _(t):
    return rounded(planning.affected_impacted(t.prediction))


@query("q_zone_pivot", "select event, county_fips5, " + ", ".join(f"round({v}_{z.lower()}, 6) as {v}_{z.lower()}" for v in ("pop_affected", "pop_impacted") for z in ("LOW", "MEDIUM", "HIGH")) + " from wide", ("prediction",), WIDE_CTE)
def _(t):
    return rounded(wide(t))


@query("q_mass_care", "select event, county_fips5, " + ", ".join(f"{n}_{z.lower()}" for n in ("hh_shelter", "hh_feeding") for z in ("LOW", "MEDIUM", "HIGH")) + ", total_shelter_est from care", ("prediction",), CARE_CTE)
def _(t):
    table = planning_table(t.prediction)
    return table.select("event", "county_fips5", *[c for c in table.columns if c.startswith("hh_")], "total_shelter_est")


@query("q_pct_impact", "select event, county_fips5, round(pop_affected_low * 0.1::double, 6) as pct_impacted_low, round(pop_affected_medium * 0.3::double, 6) as pct_impacted_medium, round(pop_affected_high * 0.6::double, 6) as pct_impacted_high from wide", ("prediction",), WIDE_CTE)
def _(t):
    return rounded(planning.pct_impact(wide(t)).select("event", "county_fips5", *[f"pct_impacted_{z.lower()}" for z in ("LOW", "MEDIUM", "HIGH")]))


@query("q_coverage", """select event, state, count(*) filter (where hit) as matched, count(*) as gt_total, round(count(*) filter (where hit) / count(*), 6) as coverage_rate
    from (select distinct event, state, county_fips5, (event, state, county_fips5) in (select (event, state, county_fips5) from prediction) as hit from truth) a group by 1, 2""", ("prediction", "truth"))
def _(t):
    return rounded(validation.coverage_rate(validation.coverage(t.prediction, t.truth)))


@query("q_unmatched_truth", "select distinct event, state, county_fips5 from truth where not exists (select 1 from prediction p where p.event = truth.event and p.state = truth.state and p.county_fips5 = truth.county_fips5)", ("prediction", "truth"))
def _(t):
    return validation.coverage(t.prediction, t.truth).where("not matched").drop("matched")


@query("q_validation_join", "select event, county_fips5, state, total_shelter_est, actual_shelter, planned_shelter, shelter_pop, error from joined", ("prediction", "truth"), TRUTH_CTE)
def _(t):
    return validated(t.prediction, t.truth).select("event", "county_fips5", "state", "total_shelter_est", "actual_shelter", "planned_shelter", "shelter_pop", "error")


_METRICS = """count(*) as n, round(sqrt(avg(error * error)), 6) as rmse, round(avg(abs(error)), 6) as mae, round(1 - sum(error * error) / nullif(sum((shelter_pop - m) * (shelter_pop - m)), 0), 6) as r2, round(avg(shelter_pop), 6) as mean_truth, round(avg(total_shelter_est), 6) as mean_est"""


@query("q_validation_metrics", f"select event, {_METRICS} from (select *, avg(shelter_pop) over (partition by event) as m from joined) a group by 1 union all select 'ALL', {_METRICS} from (select *, avg(shelter_pop) over () as m from joined) a", ("prediction", "truth"), TRUTH_CTE)
def _(t):
    rows = validated(t.prediction, t.truth)
    overall = validation.error_metrics(rows).select(F.lit("ALL").alias("event"), "*")
    return rounded(validation.error_metrics(rows, ["event"]).unionByName(overall))


@query("q_top_discrepancies", "select event, county_fips5, state, shelter_pop, total_shelter_est, abs(error) as abs_error, case when error > 0 then 'OVER' when error < 0 then 'UNDER' else 'EXACT' end as direction from joined order by abs(error) desc, county_fips5, event limit 10", ("prediction", "truth"), TRUTH_CTE)
def _(t):
    return validation.top_discrepancies(validated(t.prediction, t.truth)).select("event", "county_fips5", "state", "shelter_pop", "total_shelter_est", "abs_error", "direction")


_VARIANT_SQL = " union all ".join(
    f"select '{v}' as variant, *, {ZONE.format(l=lo, m=md, h=hi)} as zone from prediction where occ like 'RES%'" for v, (lo, md, hi) in (("default", (4.0, 9.0, 12.0)), ("tight", (3.0, 8.0, 11.0)), ("loose", (5.0, 10.0, 13.0)), ("very_low", (2.0, 6.0, 10.0))))


@query("q_threshold_sensitivity", f"select variant, event, zone, count(*) filter (where depth_grid > 0) as bldg_affected, count(*) filter (where bldgdmgpct > 0) as bldg_impacted, round(2.53::double * count(*) filter (where depth_grid > 0), 6) as pop_affected, round(2.53::double * count(*) filter (where bldgdmgpct > 0), 6) as pop_impacted from ({_VARIANT_SQL}) a where zone <> 'NONE' group by 1, 2, 3", ("prediction",))
def _(t):
    return rounded(planning.threshold_sensitivity(t.prediction))


_DAMAGE_SQL = " union all ".join(
    f"select '{v}' as variant, *, case when depth_grid > 12 then 'HIGH' when depth_grid >= 9 then 'MEDIUM' when depth_grid >= 4 then 'LOW' when bldgdmgpct > {hi} then 'HIGH' when bldgdmgpct > {md} then 'MEDIUM' when bldgdmgpct > {lo} then 'LOW' else 'NONE' end as zone from prediction where occ like 'RES%'"
    for v, lo, md, hi in (("default", 0, 15, 35), ("minus_5_pct", 0, 10, 30), ("plus_5_pct", 5, 20, 40))
)


@query("q_damage_sensitivity", f"select variant, event, zone, count(*) filter (where depth_grid > 0) as bldg_affected, count(*) filter (where bldgdmgpct > 0) as bldg_impacted from ({_DAMAGE_SQL}) a where zone <> 'NONE' group by 1, 2, 3", ("prediction",))
def _(t):
    return planning.threshold_sensitivity(t.prediction, variants=fv.DAMAGE_VARIANTS).select("variant", "event", "zone", "bldg_affected", "bldg_impacted")


_RUN_SQL = """select event, adv, flc, county_fips5, zone, count(*) filter (where depth_grid > 0) as bldg_affected, count(*) filter (where bldgdmgpct > 10) as bldg_impacted from (
    select *, case when depth_grid > 12 then 'HIGH' when depth_grid >= 9 then 'MEDIUM' when depth_grid >= 4 then 'LOW' when bldgdmgpct > 35 then 'HIGH' when bldgdmgpct > 15 then 'MEDIUM' when bldgdmgpct > 0 then 'LOW' else 'NONE' end as zone,
      row_number() over (partition by event, adv, flc, fltyid, state order by bldgdmgpct desc nulls last, depth_grid desc nulls last, county_fips5 nulls last, occ nulls last) as rn
    from prediction) a where rn = 1 and zone <> 'NONE' and occ like 'RES%' group by 1, 2, 3, 4, 5"""


@query("q_run_affected", _RUN_SQL, ("prediction",))
def _(t):
    """Each building once per event, advisory and flood class; impacted from 10 % damage."""
    columns = [*planning.RUN, "fltyid", "state", "county_fips5", "occ", "depth_grid", "bldgdmgpct"]
    runs = planning.per_run(t.prediction.select(*columns))
    by = [*planning.RUN, "county_fips5"]
    return planning.affected_impacted(runs, by, min_damage=10.0).select(*by, "zone", "bldg_affected", "bldg_impacted")


@query("q_sanity", """select 'impacted_le_affected_low' as "check", count(*) filter (where pop_impacted_low > pop_affected_low) as violations from checked
    union all select 'impacted_le_affected_medium', count(*) filter (where pop_impacted_medium > pop_affected_medium) from checked
    union all select 'impacted_le_affected_high', count(*) filter (where pop_impacted_high > pop_affected_high) from checked
    union all select 'zero_affected_zero_impacted', count(*) filter (where pop_affected_low + pop_affected_medium + pop_affected_high = 0 and pop_impacted_low + pop_impacted_medium + pop_impacted_high > 0) from checked
    union all select 'affected_le_population', count(*) filter (where pop_affected_low + pop_affected_medium + pop_affected_high > population / 400) from checked""", ("prediction", "census"),
    WIDE_CTE + ", checked AS (select w.*, c.population from wide w left join census c using (county_fips5))")
def _(t):
    census = t.census.select("county_fips5", (F.col("population") / 400).alias("census_pop"))
    return planning.sanity_checks(wide(t).join(census, "county_fips5", "left"))


@query("q_pop_share", """select county_fips5, population, round(bldg_affected * 100 / greatest(buildings, 1), 6) as pct_affected, round(population * (bldg_affected / greatest(buildings, 1)), 6) as pop_affected
    from (select county_fips5, count(*) as buildings, count(*) filter (where depth_grid > 0) as bldg_affected from prediction group by 1) g join census using (county_fips5)""", ("prediction", "census"))
def _(t):
    per = t.prediction.groupBy("county_fips5").agg(F.count("*").alias("buildings"), F.count_if(F.col("depth_grid") > 0).alias("bldg_affected"))
    return rounded(planning.affected_share(per, t.census).select("county_fips5", "population", "pct_affected", "pop_affected"))


_P = "bldgdmgpct / 100"


@query("q_displaced", f"""select event, county_fips5, round(sum(pop2pmu65 * ({_P})), 4) as displaced_night_u65, round(sum(pop2pmo65 * ({_P})), 4) as displaced_night_o65, round(sum(pop2amu65 * ({_P})), 4) as displaced_day_u65,
    round(sum(pop2amo65 * ({_P})), 4) as displaced_day_o65 from prediction group by 1, 2""", ("prediction",))
def _(t):
    return rounded(planning.displaced(t.prediction, ["event", "county_fips5"]), 4)


@query("q_high_need", f"""select event, round(sum(pop2pmu65 * ({_P}) * u65disable), 5) as high_need_u65, round(sum(pop2pmo65 * ({_P}) * o65disable), 5) as high_need_o65,
    round(sum(pop2pmu65 * ({_P}) * u65disable + pop2pmo65 * ({_P}) * o65disable), 5) as high_need from prediction group by 1""", ("prediction",))
def _(t):
    return rounded(planning.high_need(t.prediction, ["event"]), 5)


@query("q_weighted_need", f"""select g.FIPS, round(displaced, 4) as displaced, EP_DISABL, round(displaced * EP_DISABL / 100, 4) as high_need from (select county_fips5 as FIPS, sum(pop2pmu65 * ({_P})) as displaced from prediction group by 1) g
    left join svi_county s using (FIPS)""", ("prediction", "svi_county"))
def _(t):
    people = planning.displaced(t.prediction, ["county_fips5"]).select(F.col("county_fips5").alias("FIPS"), F.col("displaced_night_u65").alias("displaced"))
    return rounded(planning.weighted_need(people, t.svi_county), 4)


@query("q_flat_rate", f"select event, round(sum(pop2pmu65 * ({_P})) * 0.0073::double, 4) as shelter_flat from prediction group by 1", ("prediction",))
def _(t):
    people = planning.displaced(t.prediction, ["event"])
    return rounded(planning.flat_rate(people, "displaced_night_u65").select("event", "shelter_flat"), 4)


@query("q_worst_case", first_prediction_sql(["fltyid", "state", "flc"], "bldglossusd"), ("prediction",))
def _(t):
    return planning.worst_case(t.prediction)


@query("q_advisory_delta", """select event, county_fips5, adv, buildings, round(loss, 3) as loss, buildings - lag(buildings) over w as buildings_delta, round(loss - lag(loss) over w, 3) as loss_delta
    from (select event, county_fips5, adv, count(*) as buildings, sum(bldglossusd) as loss from prediction group by 1, 2, 3) g window w as (partition by event, county_fips5 order by adv)""", ("prediction",))
def _(t):
    return rounded(planning.advisory_evolution(t.prediction), 3)


@query("q_county_loss", """select substr(cbfips, 1, 5) as FIPS, GridName, count(*) as buildings, count(*) filter (where ok and not dry) as exposed, round(sum(case when dry then 0.0::double when hit then fb * trunc(cost) end), 3) as building_loss
    from assessed where cbfips is not null group by 1, 2""", _ASSESS_TABLES, BUILDING_ASSESS)
def county_loss(t):
    """Flagship: clean inventory, sample every grid, apply curves, sum building loss per county."""
    pred = assess(buildings(t), t.wet, GRIDS, t.lookups, "CoastalA")
    return geo.add_geoids(pred.where("cbfips is not null")).groupBy(F.col("county_geoid").alias("FIPS"), "GridName").agg(
        F.count("*").alias("buildings"), F.count_if(F.col("flExp") == 1).alias("exposed"), F.round(F.sum("BldgLossUSD"), 3).alias("building_loss"))
