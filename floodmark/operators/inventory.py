"""Inventory operators: filters, defaults, dedup, summaries and state resolution."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import fixed_values as fv, text
from .counts import Counts, counted

REQUIRED = [
    "bid", "occtype", "val_struct", "sqft", "num_story", "found_type", "found_ht", "latitude", "longitude",
]


def in_bbox(df: DataFrame, min_lon: float, min_lat: float, max_lon: float, max_lat: float,
            lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows inside a bounding box, edges included.  Literal bounds reach the Parquet scan."""
    return df.where(F.col(lat).between(min_lat, max_lat) & F.col(lon).between(min_lon, max_lon))


def require(df: DataFrame, cols: Sequence[str] = REQUIRED) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL (NaN is a value and is kept)."""
    return df.where(reduce(Column.__and__, (F.col(c).isNotNull() for c in cols)))


def fill_defaults(df: DataFrame) -> DataFrame:
    """Fill missing cost, area and content with 0 and stories and floor height with 1."""
    return df.na.fill({"val_struct": 0.0, "sqft": 0.0, "num_story": 1.0, "found_ht": 1.0, "val_cont": 0.0})


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key.  The planner limits each map task to one row per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _total_order(df: DataFrame, lead: Sequence[str], tie_breakers: Sequence[str] | None) -> list[Column]:
    rest = tie_breakers if tie_breakers is not None else [c for c in df.columns if c not in lead]
    return [F.col(c).asc_nulls_last() for c in rest]


def dedup_inventory(df: DataFrame, key: str = "bid", value: str = "val_struct",
                    tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Keep the row with the highest structure value per building id.

    Equal values are ordered by ``tie_breakers``, by default every remaining column, so the
    result does not depend on the input order.
    """
    order = [F.col(value).desc_nulls_last(), *_total_order(df, (key, value), tie_breakers)]
    return first_per_key(df, [key], order)


def dedup_predictions(df: DataFrame, key: str = "fltyid", value: str = "bldgdmgpct",
                      tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Keep the row with the highest damage percentage per building."""
    return dedup_inventory(df, key, value, tie_breakers)


def engine_input(df: DataFrame, on_missing: str = "drop", tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Inventory rows to engine input columns plus ``cbfips``: clean, dedup, rename.

    ``on_missing="drop"`` drops rows that lack a required attribute; ``"fill"`` fills defaults
    and drops only rows without id, position or occupancy.
    """
    if on_missing == "drop":
        rows = require(df)
    elif on_missing == "fill":
        rows = require(fill_defaults(df), ["bid", "occtype", "latitude", "longitude"])
    else:
        raise ValueError("on_missing must be 'drop' or 'fill'")
    return dedup_inventory(rows, tie_breakers=tie_breakers).select(
        F.col("bid").alias("FltyId"),
        text.norm_occ("occtype").alias("Occ"),
        F.col("val_struct").alias("Cost"),
        F.col("sqft").alias("Area"),
        F.col("num_story").alias("NumStories"),
        text.foundation_code("found_type").alias("FoundationType"),
        F.col("found_ht").alias("FirstFloorHt"),
        F.coalesce("val_cont", F.lit(0.0)).alias("ContentCost"),
        F.col("latitude").alias("Latitude"),
        F.col("longitude").alias("Longitude"),
        text.norm_fips("cbfips").alias("cbfips"),
    )


def keep_types(df: DataFrame, types: dict[str, str] | Iterable[str], occ: str = "occ") -> DataFrame:
    """Rows whose occupancy is marked ``Y`` (or is listed)."""
    if isinstance(types, dict):
        types = [t for t, flag in types.items() if str(flag).strip().upper() == "Y"]
    return df.where(F.col(occ).isin(list(types)))


def inventory_summary(df: DataFrame, occ: str = "Occ", source: str = "state") -> DataFrame:
    """One row: row count, residential count and number of distinct sources."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col(occ).startswith("RES")).alias("residential_count"),
        F.countDistinct(source).alias("source_state_count"),
    )


def union_states(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of per-state frames, columns matched by name, absent columns NULL."""
    if not frames:
        raise ValueError("no frames to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_ordered(df: DataFrame, key: str, pos: str) -> DataFrame:
    """Distinct keys with their first position, in order of first appearance."""
    return df.groupBy(key).agg(F.min(pos).alias(pos)).orderBy(pos, key)


def state_dimension(spark: SparkSession) -> DataFrame:
    """The fixed table of 51 states: name, abbr, fips, path_name."""
    return spark.createDataFrame(fv.STATES, "name string, abbr string, fips string").withColumn(
        "path_name", F.translate("name", " ", "_")
    )


def _state_keys(spark: SparkSession) -> DataFrame:
    """Three lookup keys per state; 153 fixed rows."""
    keys = F.array(F.lower("name"), F.col("abbr"), F.col("fips"))
    return state_dimension(spark).withColumn("state_key", F.explode(keys))


def resolve_states(df: DataFrame, col: str, pos: str, on_unknown: str = "fail") -> DataFrame:
    """States named by ``col`` (code, abbreviation or name), once each, in first-seen order.

    An identifier that names no state stops the run, or with ``on_unknown="warn"`` is left out with a warning;
    :func:`unresolved_states` lists them.
    """
    if on_unknown not in ("fail", "warn"):
        raise ValueError("on_unknown must be 'fail' or 'warn'")
    unknown = unresolved_states(df, col).agg(F.count("*"), F.min(col)).first()
    if unknown[0]:
        message = f"{unknown[0]} identifiers name no state, first {unknown[1]!r}"
        if on_unknown == "fail":
            raise ValueError(message)
        warnings.warn(message, stacklevel=2)
    keyed = df.withColumn("state_key", text.state_key(col))
    return (
        keyed.join(F.broadcast(_state_keys(df.sparkSession)), "state_key")
        .groupBy("fips", "abbr", "name", "path_name").agg(F.min(pos).alias(pos))
        .orderBy(pos, "fips")
    )


def unresolved_states(df: DataFrame, col: str) -> DataFrame:
    """Distinct identifiers that name no state."""
    keyed = df.withColumn("state_key", text.state_key(col))
    return keyed.join(F.broadcast(_state_keys(df.sparkSession)), "state_key", "left_anti").select(col).distinct()


def resolve_states_counted(df: DataFrame, col: str) -> tuple[DataFrame, Counts]:
    """Rows with the state that ``col`` names, and how many are ``resolved`` and ``unknown``, known once they were read.

    Unlike :func:`resolve_states` it reads the identifiers once: ``counts.require_none("unknown")`` after the job is the strict
    check.
    """
    keyed = df.withColumn("state_key", text.state_key(col))
    named = keyed.join(F.broadcast(_state_keys(df.sparkSession)), "state_key", "left").drop("state_key")
    seen, counts = counted(named, {"resolved": F.count("fips"), "unknown": F.count_if(F.col("fips").isNull())})
    return seen.where("fips is not null"), counts


def load_manifest(raw: DataFrame, processed: DataFrame, state: str = "state") -> DataFrame:
    """Per state: features read, rows written and whether the two agree."""
    a = raw.groupBy(state).agg(F.count("*").alias("feature_count"))
    b = processed.groupBy(state).agg(F.count("*").alias("processed_parquet_rows"))
    joined = a.join(b, state, "full").na.fill(0, ["feature_count", "processed_parquet_rows"])
    return joined.withColumn("complete", F.col("feature_count") == F.col("processed_parquet_rows"))


def files_of(df: DataFrame, state: str = "state") -> DataFrame:
    """Files behind the rows of a scan: state, file, rows, bytes and time of the last change.

    ``df`` is a scan with Spark's hidden file columns (or has them as ``_metadata``).  Nothing but them and the state is
    read, so Parquet files give their row counts from their footers.  A file without rows is not seen.
    """
    return df.groupBy(state, F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.max("_metadata.file_size").alias("bytes"),
        F.max("_metadata.file_modification_time").alias("modified"))


def _load(files: DataFrame, state: str, rows: str, path: str) -> DataFrame:
    """One row per state: its rows, the file or, of several, their common folder, their number, bytes and last change."""
    lead = F.array_sort(F.collect_set(F.regexp_replace("file", "/[^/]*$", "")))
    one = F.when(F.count("*") == 1, F.max("file")).when(F.size(lead) == 1, F.get(lead, F.lit(0))).otherwise(
        F.regexp_replace(F.get(lead, F.lit(0)), "/[^/]*$", ""))
    return files.groupBy(state).agg(
        F.sum("rows").alias(rows), one.alias(path), F.count("*").alias(f"{path}_files"), F.sum("bytes").alias(f"{path}_bytes"),
        F.max("modified").alias(f"{path}_modified"))


def file_manifest(raw: DataFrame, processed: DataFrame, state: str = "state") -> DataFrame:
    """Load manifest from the files themselves: per state its name and codes, features read and rows written, and of the
    raw and the processed files the path, number, bytes and last change; ``complete`` if all features were written.

    ``raw`` holds features and ``processed`` inventory rows, both with their file columns (see :func:`files_of`).  States of either
    side are listed, also those that are no known state.
    """
    a = _load(files_of(raw, state), state, "feature_count", "raw_lines")
    b = _load(files_of(processed, state), state, "processed_parquet_rows", "processed_parquet")
    keys = _state_keys(raw.sparkSession).select("state_key", "name", "abbr", "fips")
    joined = a.join(b, state, "full").na.fill(0, [
        c for c in [*a.columns, *b.columns] if c.endswith(("_count", "_rows", "_files", "_bytes"))])
    named = joined.withColumn("state_key", text.state_key(state)).join(F.broadcast(keys), "state_key", "left").drop("state_key")
    return named.withColumn("complete", F.col("feature_count") == F.col("processed_parquet_rows"))
