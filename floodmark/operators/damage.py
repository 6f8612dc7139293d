"""Damage operators: row gate, curve matching, losses, debris and restoration time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import fixed_values as fv, hazard, text
from .inventory import first_per_key
from .joins import Lookup, lookup, one_per_key

DEPTHS = list(range(fv.CURVE_MIN_FT, fv.CURVE_MAX_FT + 1))
DEPTH_COLUMNS = {k: (f"m{-k}" if k < 0 else f"p{k}") for k in DEPTHS}
NUMERIC_FIELDS = ["Cost", "Area", "NumStories", "FoundationType", "FirstFloorHt", "Latitude", "Longitude"]
OPTIONAL_NUMERIC = ["ContentCost", "InvCost"]
OPTIONAL_TEXT = ["BDDF_ID", "CDDF_ID", "IDDF_ID"]


@dataclass(frozen=True)
class Lookups:
    """Size-checked lookup tables of the assessment.

    curves       curve_set, curve_key, k, lo, hi, ddf_id
    debris       DebrisID, Finishes, Structure, Foundation
    restoration  RestFnID, Min_Restor_Days, Max_Restor_Days
    econ         Occupancy, AnnualSalesPerSqFt, BusinessInvPctofSales
    library      kind (building, content, inventory), fn_id, Occupancy, pct; optional
    """

    curves: Lookup
    debris: Lookup
    restoration: Lookup
    econ: Lookup
    library: Lookup | None = None

    @classmethod
    def of(cls, curves: DataFrame, debris: DataFrame, restoration: DataFrame, econ: DataFrame,
           library: DataFrame | None = None) -> Lookups:
        """One row per key of each table, the first by its other columns, so that no building is repeated."""
        return cls(
            lookup(one_per_key(curves, ["curve_set", "curve_key", "k"], ["ddf_id"])),
            lookup(one_per_key(debris, ["DebrisID"])), lookup(one_per_key(restoration, ["RestFnID"])),
            lookup(one_per_key(econ, ["Occupancy"])),
            library=None if library is None else user_library(library),
        )


def user_library(library: DataFrame) -> Lookup:
    """User curves with trimmed ids, one per kind and id: the first by occupancy."""
    trimmed = library.withColumn("fn_id", F.trim("fn_id"))
    occupancy = next(c for c in trimmed.columns if c.lower() == "occupancy")
    return lookup(one_per_key(trimmed, ["kind", "fn_id"], [occupancy]))


def curves_long(wide: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """One row per key and whole foot ``k``: the value there (``lo``) and at the next foot (``hi``).

    The deepest point pairs with itself.
    """
    keys, extra = list(keys), list(extra)
    points = F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(c).cast("double").alias("lo")) for k, c in DEPTH_COLUMNS.items()
    ])
    long = wide.select(*keys, *extra, F.explode(points).alias("_p")).select(*keys, *extra, "_p.k", "_p.lo")
    following = F.lead("lo").over(Window.partitionBy(*keys).orderBy("k"))
    return long.withColumn("hi", F.coalesce(following, F.col("lo")))


def curves_packed(wide: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """One row per key with its 29 points as the array ``pct``, for large curve libraries."""
    points = F.array(*[F.col(c).cast("double") for c in DEPTH_COLUMNS.values()])
    return wide.select(*keys, *extra, points.alias("pct"))


def first_curve(wide: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First curve of each key in table order."""
    return first_per_key(wide, key, [F.col(c) for c in order])


def apply_field_map(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Project the fifteen logical fields from their physical columns; ``""`` gives a typed NULL."""
    unknown = set(mapping) - set(fv.ENGINE_FIELDS)
    missing = set(fv.ENGINE_FIELDS) - set(mapping)
    if unknown or missing:
        raise ValueError(f"a field map has exactly these keys: {fv.ENGINE_FIELDS}")
    return df.select(*[
        (F.col(mapping[f]) if mapping[f] else F.lit(None).cast("string")).alias(f) for f in fv.ENGINE_FIELDS
    ])


def field_map(**supplied: str) -> dict[str, str]:
    """A field map with every field not named left unsupplied."""
    return {f: supplied.get(f, "") for f in fv.ENGINE_FIELDS}


def _cell(df: DataFrame, name: str) -> Column:
    """Cell of a column with blanks as NULL; numbers keep their type."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return text.clean_cell(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(name), F.lit(None).cast(kind))
    return F.col(name)


def _number(df: DataFrame, name: str) -> Column:
    cell = _cell(df, name)
    return cell.try_cast("double") if isinstance(df.schema[name].dataType, T.StringType) else cell.cast("double")


def flag_incomplete(df: DataFrame, mapping: dict[str, str]) -> Column:
    """Row status from its required cells: INCOMPLETE (blank), ROW_ERROR (not a number) or OK."""
    blank, broken = F.lit(False), F.lit(False)
    for field in fv.REQUIRED_ENGINE_FIELDS:
        name = mapping[field]
        if not name:
            raise ValueError(f"required field {field} is not mapped")
        blank = blank | _cell(df, name).isNull()
        if field in NUMERIC_FIELDS:
            broken = broken | _number(df, name).isNull()
    return F.when(blank, "INCOMPLETE").when(broken, "ROW_ERROR").otherwise("OK")


def typed_fields(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Add the typed logical fields as ``_<field>`` columns, plus ``status``.

    The one-element explode starts a new generated method and holds back a filter on ``status``, which would otherwise be
    worked out from the raw cells once more, in one method that the JIT does not compile.
    """
    cols = {"status": flag_incomplete(df, mapping)}
    for field in NUMERIC_FIELDS + OPTIONAL_NUMERIC:
        if mapping[field]:
            cols[f"_{field}"] = _number(df, mapping[field])
    for field in ["OCC", *OPTIONAL_TEXT]:
        if mapping[field]:
            cols[f"_{field}"] = _cell(df, mapping[field]).cast("string")
    return df.withColumns(cols).withColumn("status", F.explode(F.array("status")))


def building_curve_set(occ, flood_class) -> Column:
    """Default curve set of a building: coastal sets apply to residential occupancies only."""
    occ = F.col(occ) if isinstance(occ, str) else occ
    residential = F.substring(occ, 1, 3) == "RES"
    return (
        F.when(residential & (flood_class == "CAE"), F.lit("coastal_a"))
        .when(residential & flood_class.isin("V", "VE"), F.lit("coastal_v"))
        .otherwise(F.lit("default"))
    )


def match_curve(df: DataFrame, curves: Lookup, kind: str, set_name: Column, key: Column, k: Column,
                guard: Column | None = None) -> DataFrame:
    """Add ``_<kind>_lo``, ``_<kind>_hi`` and ``_<kind>_id`` from the default curves; a miss gives NULL."""
    wanted = key if guard is None else F.when(guard, key)
    table = Lookup(
        curves.df.select(
            F.col("curve_set").alias("_set"), F.col("curve_key").alias("_key"), F.col("k").alias("_k"),
            F.col("lo").alias(f"_{kind}_lo"), F.col("hi").alias(f"_{kind}_hi"),
            F.col("ddf_id").cast("string").alias(f"_{kind}_id"),
        ),
        curves.bounded,
    )
    keyed = df.withColumns({"_set": F.concat_ws("_", F.lit(kind), set_name), "_key": wanted, "_k": k})
    return table.join(keyed, ["_set", "_key", "_k"]).drop("_set", "_key", "_k")


def override_curve(df: DataFrame, library: Lookup | None, kind: str, user_id: str, k: Column) -> DataFrame:
    """Let a user-supplied curve id take precedence when the library holds it."""
    if library is None or user_id not in df.columns:
        return df.withColumn(f"_{kind}_user", F.lit(False))
    table = Lookup(
        library.df.where(F.col("kind") == kind).select(F.trim("fn_id").alias("_fn"), F.col("pct").alias("_upct")),
        library.bounded,
    )
    point = k - fv.CURVE_MIN_FT
    found = F.col("_upct").isNotNull() & k.isNotNull()
    lo = F.get("_upct", point)
    hi = F.get("_upct", F.least(point + 1, F.lit(len(DEPTHS) - 1)))
    return table.join(df.withColumn("_fn", F.col(user_id)), ["_fn"]).withColumns({
        f"_{kind}_user": found,
        f"_{kind}_lo": F.when(found, lo).otherwise(F.col(f"_{kind}_lo")),
        f"_{kind}_hi": F.when(found, hi).otherwise(F.col(f"_{kind}_hi")),
        f"_{kind}_id": F.when(found, F.col("_fn")).otherwise(F.col(f"_{kind}_id")),
    }).drop("_fn", "_upct")


def interp_damage(lo, hi, depth) -> Column:
    """Damage fraction between two whole-foot points of a curve."""
    lo, hi, depth = (F.col(c) if isinstance(c, str) else c for c in (lo, hi, depth))
    return (lo + (depth - F.floor(depth)) * (hi - lo)) / 100


def debris(df: DataFrame, rates: Lookup, occ: str, foundation: str, area: str, depth: Column) -> DataFrame:
    """Add debris id and tons by part; only where the clamped depth is above zero."""
    wet = depth > 0
    table = Lookup(
        rates.df.select(
            F.col("DebrisID"), F.col("Finishes").cast("double").alias("_fin"),
            F.col("Structure").cast("double").alias("_str"), F.col("Foundation").cast("double").alias("_fnd"),
        ),
        rates.bounded,
    )
    keyed = df.withColumn("DebrisID", F.when(wet, hazard.debris_key(occ, foundation, depth)))
    tons = {name: F.col(area) * F.col(rate) / 1000
            for name, rate in (("Debris_Fin", "_fin"), ("Debris_Struc", "_str"), ("Debris_Found", "_fnd"))}
    return (
        table.join(keyed, ["DebrisID"]).withColumns(tons)
        .withColumn("Debris_Tot", F.col("Debris_Fin") + F.col("Debris_Struc") + F.col("Debris_Found"))
        .drop("_fin", "_str", "_fnd")
    )


def restoration(df: DataFrame, days: Lookup, occ: str, depth: Column) -> DataFrame:
    """Add restoration days; zero where the clamped depth is not above zero, NULL on a lookup miss."""
    wet = depth > 0
    table = Lookup(
        days.df.select(
            F.col("RestFnID").alias("_rest"), F.col("Min_Restor_Days").cast("bigint").alias("_rmin"),
            F.col("Max_Restor_Days").cast("bigint").alias("_rmax"),
        ),
        days.bounded,
    )
    keyed = df.withColumn("_rest", F.when(wet, hazard.restoration_key(occ, depth)))
    zero = F.lit(0).cast("bigint")
    return table.join(keyed, ["_rest"]).withColumns({
        "Restor_Days_Min": F.when(wet, F.col("_rmin")).when(depth.isNotNull(), zero),
        "Restor_Days_Max": F.when(wet, F.col("_rmax")).when(depth.isNotNull(), zero),
    }).drop("_rest", "_rmin", "_rmax")


def inventory_value(df: DataFrame, econ: Lookup, occ: str, area: str, supplied: str | None,
                    blank_means_default: bool = False) -> DataFrame:
    """Add ``InventoryCostUSD`` from the economics table or the supplied value."""
    table = Lookup(
        econ.df.select(
            F.col("Occupancy").alias("_eocc"), F.col("AnnualSalesPerSqFt").cast("double").alias("_sales"),
            F.col("BusinessInvPctofSales").cast("double").alias("_pct"),
        ),
        econ.bounded,
    )
    value = hazard.inventory_cost(occ, area, "_sales", "_pct", supplied, blank_means_default)
    return (
        table.join(df.withColumn("_eocc", F.col(occ)), ["_eocc"])
        .withColumn("InventoryCostUSD", value).drop("_eocc", "_sales", "_pct")
    )


def curve_qc(df: DataFrame, library: Lookup, kind: str, user_id: str, occ: str, key: str) -> DataFrame:
    """Rows whose user curve is unknown or belongs to another occupancy."""
    known = Lookup(
        library.df.where(F.col("kind") == kind)
        .select(F.trim("fn_id").alias("_fn"), F.col("Occupancy").alias("_locc")),
        library.bounded,
    )
    rows = df.select(
        F.col(key), F.col(occ).alias("occ"), text.clean_cell(user_id).alias("_fn")
    ).where(F.col("_fn").isNotNull())
    issue = (
        F.when(F.col("_locc").isNull(), "UNKNOWN_CURVE").when(F.col("_locc") != F.col("occ"), "OCCUPANCY_MISMATCH")
    )
    return (
        known.join(rows, ["_fn"]).withColumn("issue", issue).where(F.col("issue").isNotNull())
        .select(key, "occ", F.col("_fn").alias("curve_id"), F.col("_locc").alias("curve_occ"), "issue")
    )


def run_stats(pred: DataFrame) -> DataFrame:
    """Per grid: rows, row errors, flooded rows and rows without a curve."""
    return pred.groupBy("GridName").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("status") == "ROW_ERROR").alias("row_errors"),
        F.count_if((F.col("status") == "OK") & (F.col("flExp") == 1)).alias("flooded"),
        F.count_if(F.col("status") == "UNMATCHED").alias("unmatched"),
    )
