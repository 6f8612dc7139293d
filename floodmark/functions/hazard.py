"""Hazard and planning columns: depth, value, damage and impact rules.  Column -> Column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from . import fixed_values as fv


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp(col, lo: float = fv.CURVE_MIN_FT, hi: float = fv.CURVE_MAX_FT) -> Column:
    """Limit a value to ``[lo, hi]``; NULL stays NULL."""
    c = _col(col)
    return F.when(c > hi, F.lit(float(hi))).when(c < lo, F.lit(float(lo))).otherwise(c)


def structure_depth(depth_grid, first_floor) -> Column:
    """Water depth above the first floor."""
    return _col(depth_grid) - _col(first_floor)


def specific_occupancy(occ, stories, foundation) -> Column:
    """Curve key of a building: occupancy prefix, story class, basement flag."""
    occ, stories, foundation = _col(occ), _col(stories), _col(foundation)
    size = F.length(occ)
    tail = (
        F.when(size > 3, F.substr(occ, F.lit(4)))
        .when(size == 3, occ)
        .when(size == 2, F.substring(occ, 2, 1))
        .otherwise(F.lit(""))
    )
    prefix = F.when(occ == "REL1", F.lit("RE1")).otherwise(F.concat(F.substring(occ, 1, 1), tail))
    capped = F.when(stories > 3, F.lit(3.0)).otherwise(stories)
    floors = (
        F.when(occ.startswith("RES3"), F.when(stories > 4, "5").when(stories > 2, "3").otherwise("1"))
        .when(
            occ.startswith("RES1"),
            F.when(capped == F.floor(capped), F.floor(capped).cast("string")).otherwise("S"),
        )
        .when(occ.startswith("RES2"), F.lit("1"))
        .otherwise(F.when(stories > 6, "H").when(stories > 3, "M").otherwise("L"))
    )
    basement = F.when(foundation == fv.FOUNDATION_BASEMENT, "B").otherwise("N")
    return F.concat(prefix, floors, basement)


def content_multiplier(occ) -> Column:
    occ = _col(occ)
    return (
        F.when(occ.isin(fv.CONTENT_HALF), 0.5)
        .when(occ.isin(fv.CONTENT_EQUAL), 1.0)
        .when(occ.isin(fv.CONTENT_ONE_AND_HALF), 1.5)
        .otherwise(0.0)
    )


def content_cost(occ, cost, supplied=None, blank_means_default: bool = False) -> Column:
    """Content value: the supplied value cut to whole dollars unless it is -1, else a share of cost.

    ``supplied=None`` says the input has no content column.  A blank cell of an existing
    column counts as zero; with ``blank_means_default`` it takes the share of cost instead.
    """
    default = _col(cost).cast("bigint") * content_multiplier(occ)
    if supplied is None:
        return default
    given = _col(supplied).cast("double")
    given = F.coalesce(given, F.lit(-1.0 if blank_means_default else 0.0))
    whole = given.cast("bigint")
    return F.when(whole == -1, default).otherwise(whole.cast("double"))


def inventory_cost(occ, area, sales, pct, supplied=None, blank_means_default: bool = False) -> Column:
    """Business inventory value from sales per square foot, or the supplied value when above -1."""
    occ = _col(occ)
    if supplied is None:
        given = F.lit(-1.0)
    else:
        given = F.coalesce(_col(supplied).cast("double"), F.lit(-1.0 if blank_means_default else 0.0))
    formula = _col(sales) * _col(pct) * _col(area) / 100
    return (
        F.when(occ.isin(fv.INVENTORY_OCCUPANCIES) & (given == -1), formula)
        .when(given > -1, given)
        .otherwise(0.0)
    )


def depth_category(depth, labels: Sequence[str]) -> Column:
    """Category label by surge depth, deepest first; below one foot gives ``None`` as text."""
    labels = check_labels(labels)
    depth = _col(depth)
    chain = F.when(depth >= 9, labels[0])
    for bound, label in zip((6, 3, 1), labels[1:]):
        chain = chain.when(depth >= bound, label)
    return chain.otherwise("None")


def check_labels(labels: Sequence[str]) -> list[str]:
    """Four distinct, non-blank category labels in upper case."""
    clean = [str(x).strip().upper() for x in labels]
    if len(clean) != 4 or len(set(clean)) != 4 or "" in clean:
        raise ValueError(f"four distinct non-blank category labels are needed, got {list(labels)}")
    return clean


def classify_bands(col, bands: Sequence[tuple[str, float, bool]], default: str | None = None) -> Column:
    """Label of the first band reached, from ``(label, bound, inclusive)`` ordered high to low."""
    c, chain = _col(col), None
    for label, bound, inclusive in bands:
        test = (c >= bound) if inclusive else (c > bound)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(F.lit(default))


def damage_state(damage_pct) -> Column:
    """Damage state of a damage percentage; each band includes its lower bound."""
    c = _col(damage_pct)
    chain, last = None, fv.DAMAGE_STATES[-1][0]
    for name, lo, hi in fv.DAMAGE_STATES:
        test = (c >= lo) & ((c <= hi) if name == last else (c < hi))
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain


def intensity(depth, damage_pct, low: float | Column = 4.0, medium: float | Column = 9.0,
              high: float | Column = 12.0, damage_low: float | Column = 0.0, damage_medium: float | Column = 15.0,
              damage_high: float | Column = 35.0) -> Column:
    """Intensity zone of a building: by surge depth first, else by damage percentage."""
    depth, damage = _col(depth), _col(damage_pct)
    return (
        F.when(depth > high, "HIGH")
        .when(depth >= medium, "MEDIUM")
        .when(depth >= low, "LOW")
        .when(damage > damage_high, "HIGH")
        .when(damage > damage_medium, "MEDIUM")
        .when(damage > damage_low, "LOW")
        .otherwise("NONE")
    )


def severity(pct_destroyed, pct_major=None) -> Column:
    """Severity of a geography from its share of destroyed (and optionally major-damage) buildings."""
    d, high, medium = _col(pct_destroyed), None, None
    high = d >= fv.SEVERITY_DESTROYED["HIGH"]
    medium = d >= fv.SEVERITY_DESTROYED["MEDIUM"]
    if pct_major is not None:
        m = _col(pct_major)
        high = high | (m >= fv.SEVERITY_MAJOR["HIGH"])
        medium = medium | (m >= fv.SEVERITY_MAJOR["MEDIUM"])
    return F.when(high, "HIGH").when(medium, "MEDIUM").otherwise("LOW")


def svi_rate(svi) -> Column:
    """Shelter-seeking rate of a vulnerability score in [0, 1]."""
    s = _col(svi)
    return F.when(s < 0.4, 0.0).when(s < 0.8, 0.025).when(s <= 1.0, 0.05)


def shelter_seekers(population, habitability, svi) -> Column:
    return _col(population) * _col(habitability) * svi_rate(svi)


def inundation_flags(ground, foundation_height, surge) -> Column:
    """Struct of first-floor elevation and the yard-wet and structure-wet flags."""
    floor = _col(ground) + _col(foundation_height)
    return F.struct(
        floor.alias("ffe"),
        (_col(surge) > _col(ground)).alias("yard_wet"),
        (_col(surge) > floor).alias("structure_wet"),
    )


def occupants(households) -> Column:
    return F.lit(fv.PERSONS_PER_HOUSEHOLD) * _col(households)


def debris_key(occ, foundation, depth) -> Column:
    """Key of the debris rate: occupancy, basement flag, foundation kind, depth band."""
    occ, foundation, depth = _col(occ), _col(foundation), _col(depth)
    on_basement = foundation == fv.FOUNDATION_BASEMENT
    special = occ.isin("RES1", "COM6") & on_basement
    basement = F.when((occ == "RES1") & on_basement, "B").otherwise("NB")
    kind = F.when(foundation.isin(fv.FOUNDATION_BASEMENT, fv.FOUNDATION_SLAB), "SG").otherwise("FT")
    deep = F.when(depth < 4, "0").when(depth < 6, "4").when(depth < 8, "6").otherwise("8")
    usual = F.when(depth < 1, "0").when(depth < 4, "1").when(depth < 8, "4").when(depth < 12, "8").otherwise("12")
    return F.concat(occ, basement, kind, F.when(special, deep).otherwise(usual))


def restoration_key(occ, depth) -> Column:
    """Key of the restoration time: occupancy and depth band."""
    depth = _col(depth)
    band = F.when(depth < 1, "1").when(depth < 4, "4").when(depth < 8, "8").when(depth < 12, "12").otherwise("24")
    return F.concat(_col(occ), band)
