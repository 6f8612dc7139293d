"""Landed feature lines to the partitioned inventory."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.counts import counted
from ..schema import INVENTORY
from ..session import work_folder
from ..sources.features import PLACE, judged_features, parse_features, split_features
from ..sources.inventory import conform, write_inventory


def _conformed(rows: DataFrame, state: str) -> DataFrame:
    return conform(rows, T.StructType([*INVENTORY.fields, T.StructField(state, T.StringType())]))


def features_to_inventory(lines: DataFrame, line: str = "line", state: str = "state", on_bad: str = "fail",
                          on_nonfeature: str = "fail") -> DataFrame:
    """Feature lines with their state to conformed inventory rows; all states in one job."""
    return _conformed(parse_features(lines, on_bad, on_nonfeature, line=line, keep=(state,)), state)


@dataclass(frozen=True)
class Ingest:
    """What an ingest did with every line: ``lines`` = ``features`` + ``malformed`` + ``not_feature`` + ``blank``."""

    counts: dict[str, int]
    quarantined: DataFrame


def ingest_features(lines: DataFrame, root: str, quarantine: str, mode: str = "errorifexists", state: str = "state",
                    nonfeatures: bool = False) -> Ingest:
    """Feature lines to the inventory at ``root``, failed lines to ``quarantine``, each line parsed once.

    The parse is written to the work folder with its counts taken on the way; both outputs are read from there, so a
    job that is repeated after a lost executor parses nothing again.  Quarantine is Parquet with the line's state, text, problem
    and, where the scan has them (see ``read_lines(place=True)``), file and place.  Features without a line failing stop for
    nothing; an input without any feature is an error, and then nothing is written.
    """
    judged = judged_features(lines, keep=(state, *[c for c in PLACE if c in lines.columns]))
    kinds = {k: F.count_if(F.col("problem") == k) for k in ("malformed", "not_feature", "blank")}
    seen, counts = counted(judged, {"lines": F.count(F.lit(1)), "features": F.count_if(F.col("problem").isNull()), **kinds})
    path = work_folder(lines.sparkSession)
    seen.withColumn("line", F.when(F.col("problem").isNotNull(), F.col("line"))).write.parquet(path)
    found = counts.get()
    if not found["features"]:
        raise ValueError("empty feature stream")
    staged = lines.sparkSession.read.schema(judged.schema).parquet(path)
    good, bad = split_features(staged, nonfeatures)
    write_inventory(_conformed(good, state), root, mode)
    bad.write.mode(mode).parquet(quarantine)
    return Ingest(found, lines.sparkSession.read.schema(bad.schema).parquet(quarantine))
