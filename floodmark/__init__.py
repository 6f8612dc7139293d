"""Flood impact analytics on Spark DataFrames."""

from .operators.damage import Lookups
from .operators.joins import Lookup, lookup
from .operators.raster import Raster
from .params import RunParams, run_params
from .plans.assess import assess
from .plans.geography import geography_table
from .plans.planning import planning_table
from .session import configure, cut_lineage

__all__ = [
    "Lookup", "Lookups", "Raster", "RunParams", "assess", "configure", "cut_lineage", "geography_table", "lookup",
    "planning_table", "run_params",
]
