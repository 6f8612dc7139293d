"""Ordered CSV exports, the partitioned prediction store and published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import fixed_values as fv
from ..params import RunParams


def ordered(df: DataFrame, key: str) -> DataFrame:
    """Rows in global order of ``key``; the other columns break ties, so equal keys can be split."""
    return df.orderBy(key, *[c for c in df.columns if c != key])


def write_ordered_csv(df: DataFrame, path: str, key: str = "FltyId", mode: str = "errorifexists") -> None:
    """CSV parts with a header that are in order when read by part number."""
    ordered(df, key).write.option("header", True).mode(mode).csv(path)


def engine_export(df: DataFrame) -> DataFrame:
    """The ten engine input columns."""
    return df.select(*fv.ENGINE_INPUT_COLUMNS)


def crosswalk(df: DataFrame) -> DataFrame:
    """Building id and block code."""
    return df.select(F.col("FltyId").alias("fltyid"), "cbfips")


def sort_by_depth(df: DataFrame, depth: str = "Depth_in_Struc", key: str = "FltyId") -> DataFrame:
    """Deepest first; the id splits runs of equal depth over several tasks."""
    return df.orderBy(F.col(depth).desc(), key)


def write_predictions(df: DataFrame, root: str, event: str, adv: int, raster_name: str, run_id: str, flc: str) -> None:
    """Add provenance and replace what this run (event, advisory, flood class, raster) wrote before; all else stays."""
    out = df.withColumns({
        "event": F.lit(event), "adv": F.lit(int(adv)), "raster_name": F.lit(raster_name),
        "run_id": F.lit(run_id), "flc": F.lit(flc),
    })
    out.write.partitionBy("event", "adv", "flc", "raster_name").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)


def publish(df: DataFrame, params: RunParams, folder: str, mode: str = "errorifexists") -> str:
    """Write the final table under a name that carries storm, advisory and geography."""
    path = f"{folder.rstrip('/')}/{params.output_name}"
    df.write.option("header", True).mode(mode).csv(path)
    return path


def to_json_records(df: DataFrame, digits: int = 6) -> DataFrame:
    """One JSON text per row, fractional numbers rounded."""
    cols = [
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema
    ]
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("record"))
