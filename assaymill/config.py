"""Configuration is a plain dict; these helpers read the parts the engine uses."""

from __future__ import annotations

from collections.abc import Mapping
from copy import deepcopy
from typing import Any

from . import fixed_values as fixed


def default_config() -> dict[str, Any]:
    """A fresh config with the default mappings and constraints and no file paths."""
    return {
        "files": {},
        "data": {
            "column_mappings": deepcopy(fixed.COLUMN_MAPPINGS),
            "value_mappings": deepcopy(fixed.VALUE_MAPPINGS),
            "constraints": deepcopy(fixed.CONSTRAINTS),
        },
        "summary": {"groupby_columns": list(fixed.PROJECT_KEYS)},
    }


def data_section(config: Mapping[str, Any] | None, section: str, table: str) -> dict[str, Any]:
    """``config['data'][section][table]``; a missing or null level is an empty dict."""
    level: Any = config or {}
    for key in ("data", section, table):
        level = level.get(key) or {}
    return dict(level)
