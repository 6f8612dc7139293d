"""Geography operators: key attachment, roll-ups, distributions and demographic joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed_values as fv, geodesy, hazard
from ..session import cut_lineage
from .counts import Counts, match_counted
from .quantiles import quantiles_of_counts

QUARTILES = {"25th": 0.25, "50th": 0.50, "75th": 0.75}
METRICS = {"Building_Damage_Pct": "bldgdmgpct", "Building_Loss_USD": "bldglossusd"}


def attach_block(pred: DataFrame, xwalk: DataFrame, key: str = "fltyid") -> DataFrame:
    """Predictions with the block code of their building; no match leaves NULL.

    The crosswalk's columns replace columns of the same name.
    """
    return pred.drop(*[c for c in xwalk.columns if c != key]).join(xwalk, key, "left")


def match_rate(df: DataFrame, col: str) -> DataFrame:
    """One row: rows with ``col``, all rows, and the percentage."""
    matched, total = F.count(col), F.count("*")
    return df.agg(
        matched.alias("matched"), total.alias("total"),
        (matched * 100 / F.greatest(total, F.lit(1))).alias("match_pct"),
    )


def attach_block_counted(pred: DataFrame, xwalk: DataFrame, key: str = "fltyid", block: str = "cbfips") -> tuple[DataFrame, Counts]:
    """:func:`attach_block` with its match rate, gathered by the job that uses the rows."""
    return match_counted(attach_block(pred, xwalk, key), block)


def add_geoids(df: DataFrame, fips: str = "cbfips") -> DataFrame:
    """Add tract, county and state codes of a block code."""
    return df.withColumns({
        "tract_geoid": geodesy.geoid(fips, "tract"),
        "county_geoid": geodesy.geoid(fips, "county"),
        "state_geoid": geodesy.geoid(fips, "state"),
    })


def _level(geography: str) -> str:
    try:
        return {"census tract": "tract", "tract": "tract", "county": "county"}[geography.strip().lower()]
    except KeyError:
        raise ValueError(f"geography must be 'census tract' or 'county', got {geography!r}") from None


def value_counts(df: DataFrame, geography: str, fips: str = "cbfips") -> DataFrame:
    """Frequency table (FIPS, metric, value) -> rows and identified rows.

    It is the only step of the roll-up that moves building rows, combined before the shuffle
    and keyed so that one large geography spreads over all partitions.
    """
    metrics = {"depth": "depth_grid", **METRICS}
    pairs = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in metrics.items()
    ])
    return (
        df.where(F.col(fips).isNotNull())
        .select(geodesy.geoid(fips, _level(geography)).alias("FIPS"), "fltyid", F.explode(pairs).alias("_p"))
        .groupBy("FIPS", F.col("_p.metric").alias("metric"), F.col("_p.value").alias("value"))
        .agg(F.count("*").alias("n"), F.count("fltyid").alias("n_id"))
    )


def geo_rollup(df: DataFrame, geography: str, labels: Sequence[str], quantiles: bool = True) -> DataFrame:
    """One row per geography: building counts by category, height and damage bin, and statistics.

    Every column comes from the frequency table of :func:`value_counts`.  The exact quartiles
    read it twice more, so with ``quantiles`` it is written to the checkpoint folder first and
    the buildings are evaluated only once.
    """
    labels = hazard.check_labels(labels)
    counts = value_counts(df, geography)
    if quantiles:
        counts = cut_lineage(counts)
    rolled = _rolled(counts, ["FIPS"], labels, quantiles)
    return rolled.select(
        F.substring("FIPS", 1, 2).alias("State_FIPS"), F.substring("FIPS", 1, 5).alias("County_FIPS"), *rolled.columns
    )


LEVELS = {"tract": 11, "county": 5, "state": 2, "nation": 0}


def level_counts(counts: DataFrame, levels: Sequence[str]) -> DataFrame:
    """The frequency table of tracts as one of several levels: (level, FIPS, metric, value) -> rows and identified rows.

    Grouping sets over the tract table, so the buildings move once for all levels.  Like the tract table it is combined before
    the shuffle and keyed by value, so a state with a third of all rows, and the nation itself, spread over all partitions.
    """
    unknown = [x for x in levels if x not in LEVELS]
    if unknown or not levels:
        raise ValueError(f"levels are of {list(LEVELS)}, got {list(levels)}")
    ids = {name: F.substring("FIPS", 1, n) for name, n in LEVELS.items() if n}
    keyed = counts.select(*[c.alias(n) for n, c in ids.items()], "metric", "value", "n", "n_id")
    sets = [[F.col(c) for c in ([x] if x in ids else []) + ["metric", "value"]] for x in levels]
    columns = [F.col(c) for c in (*ids, "metric", "value")]
    grouped = keyed.groupingSets(sets, *columns).agg(
        F.sum("n").alias("n"), F.sum("n_id").alias("n_id"), *[F.grouping(c).alias(f"_{c}") for c in ids])
    level, fips = F.lit("nation"), F.lit("")
    for c in reversed(ids):
        level = F.when(F.col(f"_{c}") == 0, c).otherwise(level)
        fips = F.when(F.col(f"_{c}") == 0, F.col(c)).otherwise(fips)
    return grouped.select(level.alias("level"), fips.alias("FIPS"), "metric", "value", "n", "n_id")


def geo_rollup_levels(df: DataFrame, labels: Sequence[str], levels: Sequence[str] = tuple(LEVELS),
                      quantiles: bool = True) -> DataFrame:
    """The roll-up of :func:`geo_rollup` for several geography levels in one run, with the ``level`` of each row.

    ``levels`` are of tract, county, state and nation (one row, FIPS empty).  Every level has all columns, exact quartiles included.
    """
    labels = hazard.check_labels(labels)
    counts = level_counts(value_counts(df, "tract"), levels)
    if quantiles:
        counts = cut_lineage(counts)
    return _rolled(counts, ["level", "FIPS"], labels, quantiles)


def _rolled(counts: DataFrame, keys: Sequence[str], labels: Sequence[str], quantiles: bool) -> DataFrame:
    """Counts and statistics per key of a frequency table."""
    metric, value, n = F.col("metric"), F.col("value"), F.col("n")

    def total(test: Column, of: Column = n) -> Column:
        return F.coalesce(F.sum(F.when(test, of)), F.lit(0))

    is_depth, is_damage = metric == "depth", metric == "Building_Damage_Pct"
    category = hazard.depth_category(value, labels)
    aggs = [total(is_depth, F.col("n_id")).alias("Total_Num_Building")]
    aggs += [total(is_depth & (category == c)).alias(f"Total_Num_Building_{c}") for c in labels]
    aggs += [total(is_depth & (value == h)).alias(f"Total_Num_Building_SurgeHeight_{h}") for h in fv.SURGE_HEIGHTS]
    aggs += [
        total(is_damage & (value > 10 * i) & (value <= 10 * (i + 1))).alias(f"Total_Num_Building_Damage_{10 * (i + 1)}pct")
        for i in range(10)
    ]
    for name in METRICS:
        own = F.when((metric == name) & ~F.isnan(value), value)
        aggs += [
            F.min(own).alias(f"{name}_Min"), F.max(own).alias(f"{name}_Max"),
            (F.sum(own * n) / F.sum(F.when(own.isNotNull(), n))).alias(f"{name}_Mean"),
        ]
    rolled = counts.groupBy(*keys).agg(*aggs)
    if quantiles:
        ranked = quantiles_of_counts(
            counts.where(metric.isin(list(METRICS))).select(*keys, "metric", "value", "n"), [*keys, "metric"], QUARTILES
        )
        wide = ranked.groupBy(*keys).agg(*[
            F.max(F.when(metric == m, F.col(q))).alias(f"{m}_{q}") for m in METRICS for q in QUARTILES
        ])
        rolled = rolled.join(wide, list(keys), "left")
    return rolled


def category_distribution(df: DataFrame, labels: Sequence[str], depth: str = "depth_grid") -> DataFrame:
    """Buildings and percentage per category over the whole run; every label gets a row."""
    labels = hazard.check_labels(labels)
    cat = hazard.depth_category(depth, labels)
    one = df.agg(F.count("*").alias("total"), *[F.count_if(cat == c).alias(c) for c in labels])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("buildings")) for c in labels]))
    return one.select("total", rows.alias("r")).select(
        "r.category", "r.buildings",
        (F.col("r.buildings") * 100 / F.greatest("total", F.lit(1))).alias("pct"),
    )


def distinct_geos(df: DataFrame, fips: str = "cbfips") -> DataFrame:
    """Number of distinct counties and tracts."""
    return df.agg(
        F.countDistinct(geodesy.geoid(fips, "county")).alias("n_counties"),
        F.countDistinct(geodesy.geoid(fips, "tract")).alias("n_tracts"),
    )


def attach_vacancy(geo: DataFrame, vacancy: DataFrame) -> DataFrame:
    """Geographies with their vacant units; no match counts as zero."""
    return geo.join(vacancy.select("FIPS", "Num_Vacant_Units"), "FIPS", "left").withColumn(
        "Num_Vacant_Units", F.coalesce("Num_Vacant_Units", F.lit(0)).cast("bigint")
    )


def attach_svi(geo: DataFrame, svi: DataFrame) -> DataFrame:
    """Geographies with their vulnerability columns; no match leaves NULL."""
    return geo.join(svi, "FIPS", "left")


def attach_svi_counted(geo: DataFrame, svi: DataFrame) -> tuple[DataFrame, Counts]:
    """:func:`attach_svi` with its match rate, gathered by the job that uses the rows."""
    return match_counted(attach_svi(geo, svi), "E_TOTPOP")


def fill_names(geo: DataFrame, cols: Sequence[str] = ("ST_ABBR", "COUNTY"), order: str = "FIPS") -> DataFrame:
    """Fill missing names inside each county from the previous, then the next geography.

    A county holds at most a few thousand tracts, so each window stays small.
    """
    w = Window.partitionBy("State_FIPS", "County_FIPS").orderBy(order)
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    ahead = w.rowsBetween(0, Window.unboundedFollowing)
    return geo.withColumns({
        c: F.coalesce(F.last(c, ignorenulls=True).over(back), F.first(c, ignorenulls=True).over(ahead)) for c in cols
    })


def final_columns(geo: DataFrame) -> DataFrame:
    """Published column order: identity, vacancy, counts, damage, loss, vulnerability."""
    names = geo.columns
    lead = ["ST_ABBR", "COUNTY", "State_FIPS", "County_FIPS", "FIPS", "Num_Vacant_Units"]
    groups = [[c for c in names if c.startswith(p)]
              for p in ("Total_Num_Building", "Building_Damage", "Building_Loss")]
    tail = [c for c in fv.SVI_OUTPUT_COLUMNS if c in names]
    return geo.select(*lead, *reduce(list.__add__, groups), *tail)


def overview(geo: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row: geographies, population, and buildings and percentage per category."""
    labels = hazard.check_labels(labels)
    everything = F.greatest(F.sum("Total_Num_Building"), F.lit(1))
    aggs = [F.count("*").alias("n_geographies"), F.sum("E_TOTPOP").alias("total_population")]
    for c in labels:
        buildings = F.sum(f"Total_Num_Building_{c}")
        aggs += [buildings.alias(f"buildings_{c}"), (buildings * 100 / everything).alias(f"pct_{c}")]
    return geo.agg(*aggs)


def attach_boundaries(boundaries: DataFrame, geo: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Boundary rows with their geography's results and the worst-damage count."""
    labels = hazard.check_labels(labels)
    worst = F.col(f"Total_Num_Building_{labels[0]}") + F.col(f"Total_Num_Building_{labels[1]}")
    joined = boundaries.join(geo, boundaries["GEOID"] == geo["FIPS"], "inner")
    return joined.withColumn("worst_damage_assessment", worst)
