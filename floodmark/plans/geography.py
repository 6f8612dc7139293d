"""Predictions to the published geography table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import geography as geo
from ..operators.inventory import dedup_predictions, keep_types
from ..params import RunParams


def located_predictions(pred: DataFrame, xwalk: DataFrame, params: RunParams) -> DataFrame:
    """Predictions once per building, with block code, residential types only."""
    unique = dedup_predictions(pred)
    return keep_types(geo.attach_block(unique, xwalk), dict(params.building_types))


def geography_table(pred: DataFrame, xwalk: DataFrame, vacancy: DataFrame, svi: DataFrame, params: RunParams) -> DataFrame:
    """The published table: roll-up, vacancy, vulnerability and filled names."""
    rolled = geo.geo_rollup(located_predictions(pred, xwalk, params), params.geography, params.labels)
    joined = geo.attach_svi(geo.attach_vacancy(rolled, vacancy), svi)
    return geo.final_columns(geo.fill_names(joined))
