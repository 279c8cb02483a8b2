"""A PySpark-native data-quality engine for tabular data."""

from .config import default_config
from .errors import AssayError, ExtractionError, GateFailed, PlanError, ValidationFailed
from .specs import (
    MERGED, PROJECTS, RESULTS, SPECS, SUBJECTS, SUMMARY, Check, ColumnSpec, TableCheck, TableSpec,
    get_spec, spec_frame, spec_lint, spec_metadata,
)

__all__ = [
    "AssayError", "Check", "ColumnSpec", "ExtractionError", "GateFailed", "MERGED", "PROJECTS",
    "PlanError", "RESULTS", "SPECS", "SUBJECTS", "SUMMARY", "TableCheck", "TableSpec",
    "ValidationFailed", "default_config", "get_spec", "spec_frame", "spec_lint", "spec_metadata",
]
