"""Run parameters: defaults, overrides and normalisation."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from typing import Any

from .functions import fixed_values as fv


def _types() -> dict[str, str]:
    return dict.fromkeys(fv.RESIDENTIAL, "")


def _categories() -> dict[str, str]:
    return {">9": "", ">6": "", ">3": "", ">1": ""}


@dataclass(frozen=True)
class RunParams:
    storm_id: str = ""
    storm_name: str = ""
    advisory: int = 0
    year: int = 0
    flood_load_condition: str = "CoastalA"
    building_types: Mapping[str, str] = field(default_factory=_types)
    damage_categories: Mapping[str, str] = field(default_factory=_categories)
    geography: str = "county"
    output_csv_name: str = "shelter_demand_output.csv"

    @property
    def labels(self) -> list[str]:
        """The four category labels, deepest first."""
        from .functions.hazard import check_labels

        return check_labels(list(self.damage_categories.values()))

    @property
    def residential_types(self) -> list[str]:
        return [t for t, flag in self.building_types.items() if flag == "Y"]

    @property
    def output_name(self) -> str:
        """File name of the published table: base name, storm, advisory and geography."""
        stem, dot, ext = self.output_csv_name.rpartition(".")
        stem, ext = (stem, dot + ext) if stem else (self.output_csv_name, ".csv")
        return f"{stem}_{self.storm_name}_{self.storm_id}_{self.advisory}_{self.geography}{ext}"


def _text(value: Any, default: str = "") -> str:
    return default if value is None else str(value).strip()


def run_params(overrides: Mapping[str, Any] | None = None) -> RunParams:
    """Defaults with ``overrides`` laid over them; nested mappings are merged key by key."""
    given = dict(overrides or {})
    known = {f.name for f in fields(RunParams)}
    if unknown := set(given) - known:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    base = RunParams()
    for name in ("building_types", "damage_categories"):
        merged = {**getattr(base, name), **given.get(name, {})}
        given[name] = {k: _text(v).upper() for k, v in merged.items()}
    params = replace(base, **given)
    condition = _text(params.flood_load_condition, "CoastalA")
    key = re.sub(r"[\s_-]+", "", condition).lower()
    return replace(
        params,
        storm_id=_text(params.storm_id).upper(),
        storm_name=_text(params.storm_name).upper(),
        advisory=int(params.advisory),
        year=int(params.year),
        geography=_text(params.geography, "county").lower(),
        flood_load_condition=fv.FLOOD_CLASS_NAMES.get(key, condition),
    )
