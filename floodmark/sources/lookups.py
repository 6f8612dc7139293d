"""Lookup tables: curves, debris rates, restoration times and economics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.damage import DEPTH_COLUMNS, curves_long, curves_packed, first_curve


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header as text columns; a byte-order mark before the first name is dropped."""
    df = spark.read.option("header", True).csv(path)
    df = df.withColumnsRenamed({c: c.lstrip("﻿").strip() for c in df.columns})
    return df.select(*[F.trim(c).alias(c) for c in df.columns])


def conform_curves(raw: DataFrame, curve_set: str, key: str, ddf_id: str | None = "DDF_ID",
                   order: Sequence[str] = ()) -> DataFrame:
    """Wide curve rows of one set: trimmed key, numeric depth columns, first row of each key."""
    wide = raw.select(
        F.lit(curve_set).alias("curve_set"), F.trim(key).alias("curve_key"),
        (F.trim(F.col(ddf_id).cast("string")) if ddf_id else F.lit(None).cast("string")).alias("ddf_id"),
        *[F.col(c).cast("double").alias(c) for c in DEPTH_COLUMNS.values()],
        *[F.col(c).cast("double").alias(f"_o{i}") for i, c in enumerate(order)],
    )
    ranked = first_curve(wide, ["curve_set", "curve_key"], [*[f"_o{i}" for i in range(len(order))], "ddf_id"])
    return ranked.drop(*[f"_o{i}" for i in range(len(order))])


def load_curves(spark: SparkSession, path: str, curve_set: str, key: str = "SpecificOccupId") -> DataFrame:
    """A default curve file as long curve rows of the named set."""
    raw = read_table(spark, path)
    order = [c for c in ("SortOrder",) if c in raw.columns]
    return curves_long(conform_curves(raw, curve_set, key, order=order), ["curve_set", "curve_key"], ["ddf_id"])


def library_packed(raw: DataFrame, kind: str, id_col: str, occ: str = "Occupancy") -> DataFrame:
    """A full curve library, one row per trimmed text id with its points as an array."""
    wide = raw.select(
        F.lit(kind).alias("kind"), F.trim(F.col(id_col).cast("string")).alias("fn_id"), F.trim(occ).alias("Occupancy"),
        *[F.col(c) for c in DEPTH_COLUMNS.values()],
    )
    return curves_packed(wide, ["kind", "fn_id"], ["Occupancy"])


def load_library(spark: SparkSession, path: str, kind: str, id_col: str) -> DataFrame:
    return library_packed(read_table(spark, path), kind, id_col)
