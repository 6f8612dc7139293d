"""The damage assessment: buildings and depth grids to predictions, as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed_values as fv, hazard
from ..operators import damage
from ..operators.damage import Lookups
from ..operators.joins import Lookup
from ..operators.raster import PackedCells, Raster, outside_grids, sample_depth, sample_inside

DEFAULT_MAP = damage.field_map(
    UserDefinedFltyId="FltyId", OCC="Occ", Cost="Cost", Area="Area", NumStories="NumStories",
    FoundationType="FoundationType", FirstFloorHt="FirstFloorHt", ContentCost="ContentCost",
    Latitude="Latitude", Longitude="Longitude",
)


def assess(buildings: DataFrame, cells: DataFrame | Lookup | PackedCells, rasters: Sequence[Raster], lookups: Lookups,
           flood_class: str = "CoastalA", mapping: dict[str, str] | None = None, wet_only: bool = False,
           blank_means_default: bool = False, truncate: bool = False) -> DataFrame:
    """Evaluate every building on every grid.

    Adds the prediction columns, ``status`` (OK, INCOMPLETE, ROW_ERROR, UNMATCHED) and
    ``flags`` (lookups that missed).  Rows that are not computed keep their input columns.
    ``wet_only`` drops buildings off the wet cells instead of reporting them with depth 0.

    Only buildings inside a grid are paired with it, sampled and sent through the curves.  For the grids they are not
    in, their row of depth 0 is finished first and then repeated per grid, as the result names every pair.
    """
    mapping = mapping or DEFAULT_MAP
    passthrough = [c for c in buildings.columns if c not in fv.PREDICTION_COLUMNS]
    ok = F.col("status") == "OK"
    # What doesn't depend on the grid is worked out once per building.
    rows = damage.typed_fields(buildings, mapping).withColumns({
        "SOID": F.when(ok, hazard.specific_occupancy("_OCC", "_NumStories", "_FoundationType")),
        "ContentCostUSD": F.when(ok, hazard.content_cost(
            "_OCC", "_Cost", "_ContentCost" if mapping["ContentCost"] else None, blank_means_default)),
    })
    rows = damage.inventory_value(
        rows, lookups.econ, "_OCC", "_Area", "_InvCost" if mapping["InvCost"] else None, blank_means_default
    ).withColumn("InventoryCostUSD", F.when(ok, F.col("InventoryCostUSD")))
    # One-element explodes start a new generated method; without them the whole assessment
    # becomes one method that the JIT does not compile.
    rows = rows.withColumn("status", F.explode(F.array("status")))
    at = ("_Latitude", "_Longitude")
    if wet_only:
        return _sorted_out(sample_depth(rows, cells, rasters, *at, True, truncate), passthrough, lookups, flood_class, mapping)
    inside = _sorted_out(sample_inside(rows, cells, rasters, *at, truncate), passthrough, lookups, flood_class, mapping)
    return inside.unionByName(_dry(outside_grids(rows, rasters, *at, truncate, "_outside"), passthrough, inside))


def _dry(rows: DataFrame, passthrough: Sequence[str], like: DataFrame) -> DataFrame:
    """Predictions of depth 0 on the grids of ``_outside``, which need no curve: finished once per building, then named per grid."""
    ok = F.col("status") == "OK"
    kinds = dict(like.dtypes)
    known = {
        "Depth_Grid": F.lit(0.0), "flExp": F.lit(0), "SOID": F.col("SOID"), "ContentCostUSD": F.col("ContentCostUSD"),
        "InventoryCostUSD": F.col("InventoryCostUSD"), "Restor_Days_Min": F.lit(0), "Restor_Days_Max": F.lit(0),
        **{c: F.lit("0") for c in ("BDDF_ID", "CDDF_ID", "IDDF_ID")},
        **{c: F.lit(0.0) for c in ("BldgDmgPct", "BldgLossUSD", "ContDmgPct", "ContentLossUSD", "InvDmgPct", "InventoryLossUSD")},
    }
    values = {c: F.when(ok, v) for c, v in known.items()}
    values["Depth_in_Struc"] = F.when(ok, hazard.structure_depth(F.lit(0.0), "_FirstFloorHt")).when(
        F.col("status") == "INCOMPLETE", F.lit(fv.INCOMPLETE_DEPTH))
    values["GridName"] = F.explode("_outside")
    out = [values.get(c, F.lit(None)) for c in fv.PREDICTION_COLUMNS]
    return rows.select(
        *passthrough, *[v if c == "GridName" else v.cast(kinds[c]) for c, v in zip(fv.PREDICTION_COLUMNS, out)], "status",
        F.lit("").alias("flags"),
    ).toDF(*like.columns)


def _sorted_out(rows: DataFrame, passthrough: Sequence[str], lookups: Lookups, flood_class: str, mapping: dict[str, str]) -> DataFrame:
    """:func:`_evaluate`; of a library too large to broadcast, only the rows that name a user curve are shuffled to it."""
    named = [F.col(f"_{f}").isNotNull() for f in damage.OPTIONAL_TEXT if mapping[f]]
    if lookups.library is None or lookups.library.bounded or not named:
        return _evaluate(rows, passthrough, lookups, flood_class, mapping)
    some = reduce(Column.__or__, named)
    return _evaluate(rows.where(some), passthrough, lookups, flood_class, mapping).unionByName(
        _evaluate(rows.where(~some), passthrough, replace(lookups, library=None), flood_class, mapping))


def _evaluate(rows: DataFrame, passthrough: Sequence[str], lookups: Lookups, flood_class: str, mapping: dict[str, str]) -> DataFrame:
    """Predictions of buildings on the grids they were sampled on."""
    rows = rows.withColumn("Depth_Grid", F.explode(F.array("Depth_Grid")))
    ok = F.col("status") == "OK"
    exposed = ok & (F.col("Depth_Grid") > 0)
    rows = rows.withColumns({
        "Depth_in_Struc": F.when(ok, hazard.structure_depth("Depth_Grid", "_FirstFloorHt"))
        .when(F.col("status") == "INCOMPLETE", F.lit(fv.INCOMPLETE_DEPTH)),
        "flExp": F.when(ok, exposed.cast("int")),
        "Depth_Grid": F.when(ok, F.col("Depth_Grid")),
    })
    exposed = F.col("flExp") == 1

    rows = rows.withColumn("_d", F.explode(F.array(F.when(exposed, hazard.clamp("Depth_in_Struc")))))
    d = F.col("_d")
    k = F.floor(d).cast("int")
    code = F.lit(str(text_flood_class(flood_class)))
    default_set = damage.building_curve_set("_OCC", code)
    holds_inventory = F.col("_OCC").isin(fv.INVENTORY_OCCUPANCIES)
    for kind, field, set_name, guard in (
        ("building", "BDDF_ID", default_set, None),
        ("content", "CDDF_ID", default_set, None),
        ("inventory", "IDDF_ID", F.lit("default"), holds_inventory),
    ):
        rows = damage.match_curve(rows, lookups.curves, kind, set_name, F.col("SOID"), k, guard)
        rows = damage.override_curve(rows, lookups.library if mapping[field] else None, kind, f"_{field}", k)

    matched = exposed & F.col("_building_lo").isNotNull()
    rows = rows.withColumn("_m", F.explode(F.array(F.when(matched, d)))).withColumn(
        "status", F.when(exposed & F.col("_m").isNull(), "UNMATCHED").otherwise(F.col("status"))
    )
    m = F.col("_m")
    rows = damage.debris(rows, lookups.debris, "_OCC", "_FoundationType", "_Area", m)
    rows = damage.restoration(rows, lookups.restoration, "_OCC", m)

    dry = F.col("flExp") == 0
    wet = m.isNotNull()
    cost = F.col("_Cost").cast("bigint")
    building = damage.interp_damage("_building_lo", "_building_hi", m)
    content = damage.interp_damage("_content_lo", "_content_hi", m)
    no_inventory = wet & ~holds_inventory & ~F.col("_inventory_user")
    inventory = F.when(no_inventory, F.lit(0.0)).otherwise(damage.interp_damage("_inventory_lo", "_inventory_hi", m))
    rows = rows.withColumns({"_b": building, "_c": content, "_i": inventory})

    zero = F.lit(0.0)
    days = F.lit(0).cast("bigint")
    outputs = {
        "BDDF_ID": F.when(dry, "0").when(wet, F.col("_building_id")).when(F.col("status") == "UNMATCHED", "Unmatched"),
        "BldgDmgPct": F.when(dry, zero).otherwise(F.col("_b") * 100),
        "BldgLossUSD": F.when(dry, zero).otherwise(F.col("_b") * cost),
        "CDDF_ID": F.when(dry, "0").when(wet, F.col("_content_id")),
        "ContDmgPct": F.when(dry, zero).otherwise(F.col("_c") * 100),
        "ContentLossUSD": F.when(dry, zero).otherwise(F.col("_c") * F.col("ContentCostUSD")),
        "IDDF_ID": F.when(dry | no_inventory, "0").when(wet, F.col("_inventory_id")),
        "InvDmgPct": F.when(dry, zero).otherwise(F.col("_i") * 100),
        "InventoryLossUSD": F.when(dry, zero).otherwise(F.col("_i") * F.col("InventoryCostUSD")),
        "Restor_Days_Min": F.when(dry, days).otherwise(F.col("Restor_Days_Min")),
        "Restor_Days_Max": F.when(dry, days).otherwise(F.col("Restor_Days_Max")),
    }
    flags = F.concat_ws(
        ",",
        F.when(wet & F.col("_c").isNull(), "CONTENT"),
        F.when(wet & F.col("_i").isNull(), "INVENTORY"),
        F.when((m > 0) & F.col("Debris_Tot").isNull(), "DEBRIS"),
        F.when((m > 0) & F.col("Restor_Days_Min").isNull(), "RESTORATION"),
    )
    return rows.withColumns(outputs).withColumn("flags", flags).select(
        *passthrough, *fv.PREDICTION_COLUMNS, "status", "flags"
    )


def text_flood_class(flood_class: str | None) -> str:
    """Driver-side spelling of the run's flood class."""
    word = (flood_class or "").strip()
    return fv.FLOOD_CLASS_CODES.get(word.lower(), word)
