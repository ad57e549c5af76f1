"""Column names."""

from __future__ import annotations

import re


def snake_case(name: str) -> str:
    """Lower case, with every run of other characters as one inner underscore."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def title_label(name: str) -> str:
    """``max_speed`` -> ``Max Speed``."""
    return name.replace("_", " ").title()
