"""Inventory tables: scan, prune, validate, conform, write."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import geodesy, text
from ..operators.counts import Counts, counted
from ..schema import GEOMETRY_COLUMNS, INVENTORY


def read_inventory(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = INVENTORY,
                   merge: bool = False) -> DataFrame:
    """Parquet inventory files as one table, columns matched by name, absent ones NULL.

    The columns are those of ``schema``, and no footer is read for them.  ``merge`` takes the union of the columns of
    all files instead, which reads every footer first.
    """
    paths = [paths] if isinstance(paths, str) else list(dict.fromkeys(paths))
    if not paths:
        raise ValueError("at least one path is needed")
    reader = spark.read.option("mergeSchema", True) if merge else spark.read.schema(schema)
    return reader.parquet(*paths)


def state_partitions(states: Sequence[str]) -> list[str]:
    """Lower-case partition values of state names, in first-seen order."""
    return list(dict.fromkeys("_".join(s.replace("-", " ").replace("_", " ").split()).lower() for s in states))


def scan_states(df: DataFrame, states: Sequence[str], on_missing: str = "fail") -> DataFrame:
    """Rows of the named states.  The filter is on the partition column only, so other files are not read.

    A named state without a partition stops the scan; with ``on_missing="warn"`` it is named in a warning, and only
    a scan that finds no state at all stops.  That check reads the partition column before the scan is used; a scan by
    :func:`scan_states_counted` is checked by the job that uses it.
    """
    if on_missing not in ("fail", "warn"):
        raise ValueError("on_missing must be 'fail' or 'warn'")
    wanted, kept = _of_states(df, states)
    have = {r[0] for r in kept.select(F.lower("state")).distinct().collect()}
    absent = [s for s in wanted if s not in have]
    if absent and (on_missing == "fail" or not have):
        raise FileNotFoundError(f"no partition for {absent}")
    if absent:
        warnings.warn(f"no partition for {absent}", stacklevel=2)
    return kept


def _of_states(df: DataFrame, states: Sequence[str]) -> tuple[list[str], DataFrame]:
    wanted = state_partitions(states)
    if not wanted:
        raise ValueError("no states given")
    return wanted, df.where(F.lower("state").isin(wanted))


def scan_states_counted(df: DataFrame, states: Sequence[str]) -> tuple[DataFrame, Counts]:
    """Rows of the named states, and their numbers per state, known once a job has read the rows.

    ``counts.require_all()`` then stops when a named state had no row.
    """
    wanted, kept = _of_states(df, states)
    return counted(kept, {s: F.count_if(F.lower("state") == s) for s in wanted})


def unmatched_states(df: DataFrame, states: Sequence[str]) -> DataFrame:
    """The named states that have no partition."""
    wanted = df.sparkSession.createDataFrame([(s,) for s in state_partitions(states)], "state string")
    have = df.select(F.lower("state").alias("state")).distinct()
    return wanted.join(have, "state", "left_anti")


def check_columns(df: DataFrame, required: Sequence[str] = tuple(INVENTORY.names)) -> None:
    """Raise when a required column is missing; names only."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def conform(df: DataFrame, schema: T.StructType = INVENTORY, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Cast rows to the fixed schema: names match without case, absent columns are NULL.

    The position columns come from ``lon`` and ``lat``; ``processed_at`` is the ingest time.
    Cells that do not fit their type become NULL.
    """
    have = {c.lower(): c for c in df.columns}
    position = {"longitude": lon, "latitude": lat}
    out = []
    for f in schema:
        source = have.get(position.get(GEOMETRY_COLUMNS.get(f.name), f.name).lower())
        if f.name == "processed_at":
            value = F.current_timestamp()
        elif source is None:
            value = F.lit(None)
        elif isinstance(f.dataType, T.LongType):
            value = F.col(source).try_cast("double").try_cast("bigint")
        else:
            value = F.col(source).try_cast(f.dataType)
        out.append(value.cast(f.dataType).alias(f.name))
    return df.select(*out)


def write_inventory(df: DataFrame, root: str, mode: str = "errorifexists", order: str = "curve") -> None:
    """Snappy Parquet partitioned by state; an existing target is kept unless ``mode`` says otherwise.

    Rows are range-partitioned and sorted by state and position, so a large state is spread over tasks and a bounding box
    skips row groups.  ``order="curve"`` sorts along a Morton curve, on which a row group covers a small box in both
    directions; ``"latitude"`` sorts by latitude, then longitude, which narrows a box in one direction only.
    """
    if order not in ("curve", "latitude"):
        raise ValueError("order is 'curve' or 'latitude'")
    out = df.withColumn("state", text.state_partition("state"))
    if not {"latitude", "longitude"} <= set(out.columns):
        place = []
    elif order == "curve":
        place = [geodesy.morton("latitude", "longitude")]
    else:
        place = [F.col("latitude"), F.col("longitude")]
    # A hash of the row splits places that many rows share, such as none at all.
    spread = out.repartitionByRange("state", *place, F.xxhash64(*out.columns))
    spread.sortWithinPartitions("state", *place).write.partitionBy("state").mode(mode).option(
        "compression", "snappy"
    ).parquet(root)
