"""Texts handed to Python workers in batches of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows and bytes of an Arrow batch: a worker holds a batch, as Arrow data and as Python texts, at a time.
ROWS, BYTES = 512, 8 << 20


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """`df.mapInArrow` in batches of at most ROWS rows, and BYTES where one row is not larger.

    The limits are settings of the session; smaller ones stay.
    """
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", ROWS), ("maxBytesPerBatch", BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = _bytes(conf.get(key))
        if not 0 < now <= most:
            conf.set(key, str(most))
    return df.mapInArrow(function, schema)


def _bytes(setting: str) -> int:
    text = setting.strip().lower().removesuffix("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], 1)
    return int(text[:-1] if unit > 1 else text) * unit
