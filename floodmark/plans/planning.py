"""Located predictions to the planning table and its validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import planning, validation


def planning_table(pred: DataFrame, by: Sequence[str] = ("event", "county_fips5")) -> DataFrame:
    """Affected and impacted people per zone and the mass-care need, one row per event and county."""
    return planning.mass_care(planning.zones_wide(planning.affected_impacted(pred, by), by))


def validated(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """Planning rows joined to the observed shelter population."""
    return validation.join_truth(planning_table(pred), truth)
