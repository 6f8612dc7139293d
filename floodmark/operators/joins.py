"""Joins against lookup tables whose size is checked before anything is broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from ..session import work_folder

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256_000_000


@dataclass(frozen=True)
class Lookup:
    """A lookup table and whether its rows and bytes were found to be within the broadcast bounds."""

    df: DataFrame
    bounded: bool

    def join(self, rows: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
        """Join ``rows`` to the table: broadcast within the bounds, a shuffle join beyond them.

        The table has one row per key (see :func:`one_per_key`), so a hot key is hot in ``rows`` only and
        adaptive execution splits its partition, equal rows too, and reads the key's row once per split.
        Beyond the bounds the hint keeps Spark from a broadcast of its own: it goes by the bytes of compressed files and
        takes an array for one element.
        """
        table = F.broadcast(self.df) if self.bounded else self.df.hint("merge")
        return rows.join(table, list(on), how)


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row by its types: 8 a number, texts and arrays by their length.  No value is formatted."""
    def of(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 8
        if isinstance(kind, T.StructType):
            return sum((of(c[f.name], f.dataType) for f in kind), F.lit(8))
        if isinstance(kind, T.ArrayType):
            fixed = _fixed(kind.elementType)
            if fixed is not None:
                return F.coalesce(F.size(c), F.lit(0)) * fixed + 8
            return F.coalesce(F.aggregate(c, F.lit(0), lambda a, x: a + of(x, kind.elementType)), F.lit(0)) + 8
        if isinstance(kind, T.MapType):
            return of(F.map_entries(c), T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])))
        return F.lit(16)

    return sum((of(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType) for f in schema), F.lit(16)).cast("bigint")


def _fixed(kind: T.DataType) -> int | None:
    """Bytes of a value of fixed size."""
    if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)):
        return None
    if isinstance(kind, T.StructType):
        parts = [_fixed(f.dataType) for f in kind]
        return None if None in parts else 8 + sum(parts)
    return 8


def _size(schema: T.StructType) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(schema)), F.lit(0)).alias("bytes")]


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows of a table and their bytes, summed in every task before anything moves."""
    row = df.agg(*_size(df.schema)).first()
    return row[0], row[1]


def written_lookup(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> Lookup:
    """A lookup that is dear to compute: written to the cluster's work folder, counted on the way, and read from there.

    It is evaluated once, where :func:`lookup` evaluates it for its size and again for the join.
    """
    size = Observation()
    path = work_folder(df.sparkSession)
    df.observe(size, *_size(df.schema)).write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    return Lookup(kept, size.get["rows"] <= max_rows and size.get["bytes"] <= max_bytes)


def lookup(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> Lookup:
    """Count the rows and bytes of ``df`` and wrap it."""
    rows, size = measured(df)
    return Lookup(df, rows <= max_rows and size <= max_bytes)


def one_per_key(df: DataFrame, keys: Sequence[str], first: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``first``, then by the remaining columns; nulls last."""
    rest = [*first, *[c for c in df.columns if c not in (*keys, *first)]]
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in rest])
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def as_lookup(table: DataFrame | Lookup) -> Lookup:
    return table if isinstance(table, Lookup) else lookup(table)
