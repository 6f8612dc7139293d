"""Prediction files and the partitioned prediction store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schema import PREDICTIONS


def read_predictions(spark: SparkSession, path: str, schema: T.StructType = PREDICTIONS) -> DataFrame:
    """Prediction CSV with ids as text and all names in lower case; an empty file is an error.

    Columns are matched by header name; the known ones get their fixed type, others stay text.
    """
    kinds = {f.name.lower(): f.dataType for f in schema}
    raw = spark.read.option("header", True).csv(path)
    df = raw.select(*[
        F.col(c).try_cast(kinds.get(c.lower(), T.StringType())).alias(c.lower()) for c in raw.columns
    ])
    if df.limit(1).count() == 0:
        raise RuntimeError("prediction file is empty")
    return df


def read_prediction_store(spark: SparkSession, root: str) -> DataFrame:
    """The prediction store, pruned by ``event`` and ``adv`` filters."""
    return spark.read.parquet(root)
