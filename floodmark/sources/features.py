"""Newline-delimited feature streams and paged feature documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import PROPERTY_COLUMNS


PLACE = ("file", "block_start")


def read_lines(spark: SparkSession, path: str | Sequence[str], place: bool = False) -> DataFrame:
    """Text lines; with ``place`` also the file of each and where in it the part of its task starts."""
    lines = spark.read.text(path if isinstance(path, str) else list(path)).withColumnRenamed("value", "line")
    if not place:
        return lines
    return lines.withColumns({"file": F.col("_metadata.file_path"), "block_start": F.col("_metadata.file_block_start")})


def judged_features(lines: DataFrame, properties: Sequence[str] = tuple(PROPERTY_COLUMNS), line: str = "line",
                    keep: Sequence[str] = ()) -> DataFrame:
    """Every line with what it was parsed to: ``keep``, the properties as text, longitude, latitude, ``problem`` and ``line``.

    ``problem`` is NULL for a feature and else ``blank``, ``not_feature`` or ``malformed``; such a line has no properties.  Only
    Point geometry carries a position.
    """
    fields = ",".join(f"`{p}`:string" for p in properties)
    schema = (
        f"struct<type:string,properties:struct<{fields}>,"
        "geometry:struct<type:string,coordinates:array<double>>,_bad:string>"
    )
    text = F.trim(F.col(line), F.lit(" \t\r\n"))
    rows = lines.select(*keep, F.col(line).alias("_raw"), text.alias("_line"))
    parsed = F.from_json("_line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    is_object = F.col("_line").startswith("{")
    malformed = F.when(is_object, F.col("_f").isNull() | F.col("_f._bad").isNotNull()).otherwise(F.try_parse_json("_line").isNull())
    problem = (
        F.when(F.coalesce("_line", F.lit("")) == "", "blank").when(malformed, "malformed")
        .when(~F.coalesce(F.col("_f.type") == "Feature", F.lit(False)), "not_feature")
    )
    # One-element explodes keep the columns and filters below from repeating the parse of every line.
    rows = rows.withColumn("_f", F.explode(F.array(F.when(is_object, parsed)))).withColumn("problem", F.explode(F.array(problem)))
    feature = F.when(F.col("problem").isNull(), F.col("_f"))
    point = F.when(feature["geometry"]["type"] == "Point", feature["geometry"]["coordinates"])
    return rows.select(
        *keep, *[feature["properties"][p].alias(p) for p in properties],
        F.get(point, F.lit(0)).alias("longitude"), F.get(point, F.lit(1)).alias("latitude"), "problem", F.col("_raw").alias("line"),
    )


def parse_features(lines: DataFrame, on_bad: str = "fail", on_nonfeature: str = "skip",
                   properties: Sequence[str] = tuple(PROPERTY_COLUMNS), line: str = "line",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Feature lines to rows: the properties as text, then longitude and latitude.

    Blank lines are skipped.  Lines of another type are skipped or, with
    ``on_nonfeature="fail"``, stop the job.  A malformed line stops the job or, with
    ``on_bad="null"``, gives a row of NULLs.  :func:`split_features` keeps such lines apart instead.
    """
    if on_bad not in ("fail", "null") or on_nonfeature not in ("skip", "fail"):
        raise ValueError("on_bad is 'fail' or 'null', on_nonfeature is 'skip' or 'fail'")
    rows = judged_features(lines, properties, line, keep)
    for problem, strict, says in (("malformed", on_bad, "malformed feature line: "), ("not_feature", on_nonfeature, "not a feature: ")):
        if strict == "fail":
            rows = rows.where(F.when(F.col("problem") == problem, F.raise_error(
                F.concat(F.lit(says), F.substring(F.trim("line"), 1, 200)))).otherwise(True))
    return rows.where("problem is null or problem = 'malformed'").drop("problem", "line")


def split_features(judged: DataFrame, nonfeatures: bool = False) -> tuple[DataFrame, DataFrame]:
    """Judged lines as (features, quarantined lines): together with blank lines and, unless ``nonfeatures`` puts them into
    quarantine too, lines of another type, they are all lines read.

    A quarantined line keeps its text, its problem and the columns kept beside it, such as its file and place.
    """
    held = ["malformed", "not_feature"] if nonfeatures else ["malformed"]
    kept = [c for c in judged.columns[: judged.columns.index("longitude")] if c not in PROPERTY_COLUMNS]
    return (
        judged.where("problem is null").drop("problem", "line"),
        judged.where(F.col("problem").isin(held)).select(*kept, "problem", "line"),
    )


def require_rows(df: DataFrame) -> DataFrame:
    """Raise when there is no row."""
    if df.limit(1).count() == 0:
        raise ValueError("empty feature stream")
    return df


def parse_feature_pages(pages: DataFrame, doc: str = "doc") -> DataFrame:
    """Paged feature documents to (FIPS, RPL_THEMES) rows."""
    schema = "struct<features:array<struct<attributes:struct<FIPS:string,RPL_THEMES:double>>>>"
    return pages.select(F.explode(F.from_json(doc, schema)["features"]).alias("f")).select(
        "f.attributes.FIPS", "f.attributes.RPL_THEMES"
    )
