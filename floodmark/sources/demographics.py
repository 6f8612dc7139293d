"""Vacancy documents and vulnerability tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import fixed_values as fv


def parse_vacancy(docs: DataFrame, level: str = "county", doc: str = "doc") -> DataFrame:
    """Vacancy documents (a header row, then value and codes) to (FIPS, Num_Vacant_Units)."""
    parts = {"county": (1, 2), "tract": (1, 2, 3), "census tract": (1, 2, 3)}[level.lower()]
    rows = docs.select(F.posexplode(F.from_json(doc, "array<array<string>>")).alias("pos", "r")).where("pos > 0")
    units = F.coalesce(F.get("r", F.lit(0)).try_cast("double").cast("bigint"), F.lit(0).cast("bigint"))
    return rows.select(
        F.concat(*[F.get("r", F.lit(i)) for i in parts]).alias("FIPS"), units.alias("Num_Vacant_Units")
    )


def svi_projection(df: DataFrame) -> DataFrame:
    """The vulnerability columns, codes as text and measures as numbers."""
    text = {"ST_ABBR", "COUNTY", "FIPS"}
    return df.select(*[
        (F.col(c).cast("string") if c in text else F.col(c).try_cast("double")).alias(c) for c in fv.SVI_COLUMNS
    ])


def read_svi(spark: SparkSession, path: str) -> DataFrame:
    """Vulnerability CSV, projected while it is read."""
    return svi_projection(spark.read.option("header", True).csv(path))
