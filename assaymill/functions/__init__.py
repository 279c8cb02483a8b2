"""Column functions: every one is built-in Spark SQL, so it stays inside code generation."""

from .convert import convert, null_if_nan, to_double, to_long, to_timestamp
from .mapping import compile_mapping, map_values
from .scores import (
    band, executive_status, first_match, percentage, severity, severity_priority, success_rate,
)
from .text import (
    collapse_spaces, composite_code, contains_any, is_finished, standardize, strip,
)

__all__ = [
    "band", "collapse_spaces", "compile_mapping", "composite_code", "contains_any", "convert",
    "executive_status", "first_match", "is_finished", "map_values", "null_if_nan", "percentage",
    "severity", "severity_priority", "standardize", "strip", "success_rate", "to_double",
    "to_long", "to_timestamp",
]
