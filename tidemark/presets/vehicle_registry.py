"""The public vehicle registry as parameters of the general operators.

The values are in ``vehicle_registry.yml``; the checks below follow from the contracts.
"""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

from ..contracts import TableContract, contracts_from_entries, find_contract, load_yaml
from ..operators import quality
from ..operators.explore import FilterSpec
from ..operators.filter_state import OPEN_TOP, RANGE_DEFAULTS
from ..operators.metrics import MetricView
from ..plans.jobs import GoldSpec

# Rules that do not follow from the contracts.
KEY = "license_plate"
KEY_LENGTH = 6
REQUIRED = ("vehicle_type", "make", "trade_name")
CHECKED_DATES = ("mot_expiry_date", "registration_date", "first_admission_date", "first_registration_date_nl")
FIRST_DATE = "1890-01-01"
JUDGMENT_CODES = ("00", "01", "02", "03", "04", "05", "06", "07", "NG")


@lru_cache(maxsize=1)
def _values() -> dict:
    return load_yaml(Path(__file__).with_suffix(".yml"))


def contracts() -> list[TableContract]:
    return contracts_from_entries(_values()["tables"])


def contract(name: str) -> TableContract:
    return find_contract(contracts(), name)


def checks(name: str) -> list[quality.Check]:
    """Keys are given; the main table and the code table have rules of their own."""
    table = contract(name)
    out = [quality.is_not_null(k, name=f"pk_{k}_not_null") for k in table.primary_keys()]
    if not table.primary_keys():
        out = [quality.is_not_null(k, name=f"fk_{k}_not_null") for k in table.foreign_keys()]
    if KEY in table.primary_keys():
        out += [quality.is_not_null(c) for c in REQUIRED]
        out.append(quality.has_length(KEY, KEY_LENGTH))
        out += [
            quality.sql_check(
                f"{c}_valid_date",
                f"{c} IS NULL OR {c} >= '{FIRST_DATE}'",
                f"{c} should be null or a valid date after {FIRST_DATE}",
                "warn",
            )
            for c in CHECKED_DATES
        ]
    elif table.primary_keys():
        out += [quality.in_list(k, JUDGMENT_CODES) for k in table.primary_keys()]
    return out


def metric_view() -> MetricView:
    return MetricView.from_values(_values()["metrics"])


def gold_spec() -> GoldSpec:
    return GoldSpec(**_values()["gold"], view=metric_view())


def display_kinds() -> dict[str, str]:
    return dict(_values()["display"]["kinds"])


def display_categories() -> dict[str, list[str]]:
    return dict(_values()["display"]["categories"])


def description_parts() -> list[tuple[str, str, str]]:
    return [tuple(p) for p in _values()["display"]["parts"]]


def search_filter(state: dict) -> FilterSpec:
    """What a filter state (see ``filter_state``) selects from the displayed table."""
    brands = state.get("brands") or []
    return FilterSpec(
        equals={"merk": brands[0] if brands else None},
        in_lists={
            "handelsbenaming": state.get("models") or [],
            "voertuigsoort": state.get("vehicle_types") or [],
            "eerste_kleur": state.get("colors") or [],
        },
        ranges={
            "cilinderinhoud": state.get("engine_range"),
            "massa_ledig_voertuig": state.get("weight_range"),
            "aantal_zitplaatsen": state.get("seats"),
        },
        defaults={
            "cilinderinhoud": RANGE_DEFAULTS["engine_range"],
            "massa_ledig_voertuig": RANGE_DEFAULTS["weight_range"],
            "aantal_zitplaatsen": RANGE_DEFAULTS["seats"],
        },
        open_top={"aantal_zitplaatsen": OPEN_TOP["seats"]},
        years={"datum_eerste_toelating": state.get("year_range")},
    )
