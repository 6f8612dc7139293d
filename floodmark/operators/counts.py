"""Counts that are gathered while a result is computed, in place of a job of their own."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F


@dataclass(frozen=True)
class Counts:
    """Numbers of one run of a frame, by name.  They are there once an action on the frame has ended.

    The first action counts.  A frame that is read in part only, as by a limit, is counted in part.  Rows that are written
    by the same tasks count once; where a shuffle follows, tasks that are run again after their output was lost count
    again, which can raise a number but never makes 0 of it or something of 0.
    """

    observation: Observation

    def get(self) -> dict[str, int]:
        return {k: v or 0 for k, v in self.observation.get.items()}

    def require_all(self) -> dict[str, int]:
        """The numbers; stops when one of them is 0."""
        found = self.get()
        absent = sorted(k for k, v in found.items() if not v)
        if absent:
            raise LookupError(f"no row for {absent}")
        return found

    def require_none(self, name: str) -> dict[str, int]:
        """The numbers; stops when the one called ``name`` is not 0."""
        found = self.get()
        if found[name]:
            raise LookupError(f"{found[name]} rows are {name}")
        return found

    def match_pct(self) -> float:
        """Percentage of ``matched`` among ``total``, as of a report over the written rows."""
        found = self.get()
        return found["matched"] * 100 / max(found["total"], 1)

    def row(self, df: DataFrame) -> DataFrame:
        """The match report of these counts as a table of one row."""
        found = self.get()
        values = (found["matched"], found["total"], self.match_pct())
        return df.sparkSession.createDataFrame([values], "matched long, total long, match_pct double")


def counted(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, Counts]:
    """The same rows, with aggregates over them that each task adds to as the rows pass."""
    observation = Observation()
    return df.observe(observation, *[c.alias(n) for n, c in counts.items()]), Counts(observation)


def match_counted(df: DataFrame, col: str) -> tuple[DataFrame, Counts]:
    """The same rows, with the number of all and of those that have ``col``: the match rate of a left join in flight."""
    return counted(df, {"matched": F.count(col), "total": F.count(F.lit(1))})
