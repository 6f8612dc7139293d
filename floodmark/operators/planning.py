"""Planning operators: zones, affected and impacted population, mass care, demand and evolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as fv, geodesy, hazard
from .inventory import first_per_key


RUN = ("event", "adv", "flc")


def per_run(pred: DataFrame, key: Sequence[str] = ("fltyid", "state"), run: Sequence[str] = RUN) -> DataFrame:
    """One row per building and run, the worst of its grids: planning counts each building once per run."""
    order = [F.col(c).desc_nulls_last() for c in ("bldgdmgpct", "depth_grid")]
    rest = [F.col(c).asc_nulls_last() for c in pred.columns if c not in (*key, *run, "bldgdmgpct", "depth_grid")]
    return first_per_key(pred, [*run, *key], [*order, *rest])


def affected_impacted(df: DataFrame, by: Sequence[str] = ("event", "county_fips5"),
                      zone: Column | None = None, min_damage: float = 0.0) -> DataFrame:
    """Long table per zone: residential buildings and people affected (depth > 0) and impacted (damage > min_damage).

    ``df`` holds a building once for each group of ``by``; a store of several advisories or flood classes goes
    through :func:`per_run` first, with the run's columns in ``by``.
    """
    zone = zone if zone is not None else hazard.intensity("depth_grid", "bldgdmgpct")
    affected = F.count_if(F.col("depth_grid") > 0)
    impacted = F.count_if(F.col("bldgdmgpct") > min_damage)
    return (
        df.where(F.col("occ").startswith("RES")).withColumn("zone", zone).where(F.col("zone") != "NONE")
        .groupBy(*by, "zone").agg(affected.alias("bldg_affected"), impacted.alias("bldg_impacted"))
        .withColumn("pop_affected", hazard.occupants("bldg_affected"))
        .withColumn("pop_impacted", hazard.occupants("bldg_impacted"))
    )


def zones_wide(long: DataFrame, by: Sequence[str] = ("event", "county_fips5"),
               values: Sequence[str] = ("pop_affected", "pop_impacted")) -> DataFrame:
    """One row per group with a column per value and zone, absent zones 0."""
    wide = long.groupBy(*by).pivot("zone", fv.ZONES).agg(*[F.sum(v).alias(v) for v in values])
    renamed = wide.select(*by, *[
        F.coalesce(F.col(f"{z}_{v}"), F.lit(0)).alias(f"{v}_{z.lower()}") for v in values for z in fv.ZONES
    ])
    return renamed


def mass_care(wide: DataFrame, shelter: dict[str, float] | None = None,
              feeding: dict[str, float] | None = None) -> DataFrame:
    """Shelter and feeding need per zone, rounded half to even, and the shelter total."""
    out = wide
    for name, rates in (("hh_shelter", shelter or fv.SHELTER_RATE), ("hh_feeding", feeding or fv.FEEDING_RATE)):
        out = out.withColumns({
            f"{name}_{z.lower()}": F.bround(F.col(f"pop_impacted_{z.lower()}") * rates[z], 0).cast("bigint")
            for z in fv.ZONES
        })
    return out.withColumn(
        "total_shelter_est", F.col("hh_shelter_low") + F.col("hh_shelter_medium") + F.col("hh_shelter_high")
    )


def pct_impact(wide: DataFrame, rates: dict[str, float] | None = None) -> DataFrame:
    """Impacted population as a share of the affected population per zone."""
    rates = rates or fv.IMPACT_RATE
    return wide.withColumns({
        f"pct_impacted_{z.lower()}": F.col(f"pop_affected_{z.lower()}") * rates[z] for z in fv.ZONES
    })


def state_fractions(df: DataFrame, level: str, fips: str = "cbfips") -> DataFrame:
    """Per geography: share of buildings per damage state, destroyed and major shares, top zone, severity.

    Complete damage counts as destroyed and Extensive as major damage.
    """
    state = hazard.damage_state("bldgdmgpct")
    rank = hazard.intensity("depth_grid", "bldgdmgpct")
    order = F.when(rank == "HIGH", 3).when(rank == "MEDIUM", 2).when(rank == "LOW", 1).otherwise(0)
    out = (
        df.where(F.col(fips).isNotNull())
        .select(geodesy.geoid(fips, level).alias("FIPS"), state.alias("_s"), order.alias("_r"))
        .groupBy("FIPS").agg(
            F.count("*").alias("buildings"),
            *[(F.count_if(F.col("_s") == s) / F.count("*")).alias(f"frac_{s.lower()}") for s, _, _ in fv.DAMAGE_STATES],
            F.max("_r").alias("max_intensity"),
        )
        .withColumns({"pct_destroyed": F.col("frac_complete"), "pct_major": F.col("frac_extensive")})
    )
    return out.withColumn("severity", hazard.severity("pct_destroyed", "pct_major"))


def habitability(fractions: DataFrame, usability: dict[str, dict[str, float]],
                 seeking: dict[str, dict[str, float]], by: Sequence[str] = ("FIPS",)) -> DataFrame:
    """Habitability index per group and risk level.

    ``usability[state]`` gives the FU, PU and NU shares of a damage state and ``seeking[risk]``
    the weights of FU and PU; both are run parameters.
    """
    def factor(risk: str) -> Column:
        terms = [
            F.col(f"frac_{state.lower()}") * F.lit(u["FU"] * seeking[risk]["FU"] + u["PU"] * seeking[risk]["PU"] + u["NU"])
            for state, u in usability.items()
        ]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        return total

    rows = F.explode(F.array(*[F.struct(F.lit(r).alias("risk"), factor(r).alias("bhi")) for r in seeking]))
    return fractions.select(*by, rows.alias("_r")).select(*by, "_r.risk", "_r.bhi")


def threshold_sensitivity(df: DataFrame, by: Sequence[str] = ("event",),
                          variants: dict[str, tuple[float, ...]] | None = None) -> DataFrame:
    """Buildings and people per zone under every threshold set.

    A set has the surge depths of the low, medium and high zone, and after them, if they vary too, the damage
    percentages.
    """
    variants = variants or fv.THRESHOLD_VARIANTS
    names = ("low", "medium", "high", "damage_low", "damage_medium", "damage_high")
    sets = F.array(*[
        F.struct(F.lit(v).alias("variant"), *[
            F.lit(float(x)).alias(n) for n, x in zip(names, (*given, *fv.DAMAGE_THRESHOLDS[len(given) - 3:]))
        ])
        for v, given in variants.items()
    ])
    rows = df.withColumn("_v", F.explode(sets)).withColumn("variant", F.col("_v.variant"))
    zone = hazard.intensity("depth_grid", "bldgdmgpct", *[F.col(f"_v.{n}") for n in names])
    return affected_impacted(rows, ["variant", *by], zone)


def sanity_checks(wide: DataFrame, population: str | None = "census_pop") -> DataFrame:
    """Violations per rule: impacted within affected, nothing impacted without affected, affected within population."""
    a = {z: F.col(f"pop_affected_{z.lower()}") for z in fv.ZONES}
    i = {z: F.col(f"pop_impacted_{z.lower()}") for z in fv.ZONES}
    rules = {f"impacted_le_affected_{z.lower()}": i[z] > a[z] for z in fv.ZONES}
    affected = a["LOW"] + a["MEDIUM"] + a["HIGH"]
    rules["zero_affected_zero_impacted"] = (affected == 0) & (i["LOW"] + i["MEDIUM"] + i["HIGH"] > 0)
    if population:
        rules["affected_le_population"] = affected > F.col(population)
    one = wide.agg(*[F.count_if(t).alias(r) for r, t in rules.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(r).alias("check"), F.col(r).alias("violations")) for r in rules]))
    return one.select(rows.alias("_r")).select("_r.check", "_r.violations")


def affected_share(geo: DataFrame, census: DataFrame, key: str = "county_fips5") -> DataFrame:
    """Population affected as census population times the share of buildings affected."""
    joined = geo.join(census.select(key, "population"), key, "inner")
    share = F.col("bldg_affected") / F.greatest("buildings", F.lit(1))
    return joined.withColumn("pct_affected", share * 100).withColumn("pop_affected", F.col("population") * share)


POPULATION_GROUPS = {
    "night_u65": "pop2pmu65", "night_o65": "pop2pmo65", "day_u65": "pop2amu65", "day_o65": "pop2amo65",
}


def displaced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Displaced people per group: population times damage probability, by time of day and age."""
    p = F.col("bldgdmgpct") / 100
    return df.groupBy(*by).agg(*[F.sum(F.col(c) * p).alias(f"displaced_{g}") for g, c in POPULATION_GROUPS.items()])


def high_need(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """High-need displaced people per group: displaced people weighted by their disability rate."""
    p = F.col("bldgdmgpct") / 100
    under = F.col("pop2pmu65") * p * F.col("u65disable")
    over = F.col("pop2pmo65") * p * F.col("o65disable")
    return df.groupBy(*by).agg(
        F.sum(under).alias("high_need_u65"), F.sum(over).alias("high_need_o65"), F.sum(under + over).alias("high_need"),
    )


def weighted_need(people: DataFrame, svi: DataFrame, key: str = "FIPS", value: str = "displaced",
                  weight: str = "EP_DISABL") -> DataFrame:
    """Displaced people of a geography times its vulnerability percentage; no match gives NULL."""
    joined = people.join(svi.select(key, weight), key, "left")
    return joined.withColumn("high_need", F.col(value) * F.col(weight) / 100)


def flat_rate(df: DataFrame, displaced_col: str, rate: float = fv.FLAT_SHELTER_RATE) -> DataFrame:
    """Baseline shelter estimate as a flat share of displaced people."""
    return df.withColumn("shelter_flat", F.col(displaced_col) * rate)


def worst_case(df: DataFrame, by: Sequence[str] = ("fltyid", "state", "flc"), value: str = "bldglossusd") -> DataFrame:
    """The row of highest loss per building, state and flood class."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in (*by, value)]
    return first_per_key(df, by, [F.col(value).desc_nulls_last(), *rest])


def advisory_evolution(df: DataFrame, key: Sequence[str] = ("event", "county_fips5"), adv: str = "adv") -> DataFrame:
    """Buildings and loss per advisory and their change from the previous advisory of the event."""
    per = df.groupBy(*key, adv).agg(F.count("*").alias("buildings"), F.sum("bldglossusd").alias("loss"))
    w = Window.partitionBy(*key).orderBy(F.col(adv).cast("int"))
    return per.withColumns({
        "buildings_delta": F.col("buildings") - F.lag("buildings").over(w),
        "loss_delta": F.col("loss") - F.lag("loss").over(w),
    })


def latest_advisories(df: DataFrame, storm: str, adv: str, n: int = 3) -> DataFrame:
    """The last ``n`` advisories of every storm, by advisory number."""
    distinct = df.select(storm, adv).distinct()
    w = Window.partitionBy(storm).orderBy(F.col(adv).cast("int").desc())
    return distinct.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
