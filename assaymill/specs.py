"""Declarative table specifications.

A :class:`TableSpec` says what a table must look like; every other part of the engine -- cleaning,
constraint filters, validation, lint -- is compiled from it into DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixed_values as fixed
from . import sqltext as sql
from .local import local_table

STRING, DOUBLE, LONG, TIMESTAMP = "string", "double", "long", "timestamp"
SPARK_TYPES = {STRING: "string", DOUBLE: "double", LONG: "bigint", TIMESTAMP: "timestamp_ntz"}
# Names under which the types are shown in metadata and check names.
SHOWN_TYPES = {STRING: "str", DOUBLE: "float64", LONG: "int64", TIMESTAMP: "datetime64[ns]"}


@dataclass(frozen=True)
class Check:
    """One value check. ``kind`` is a constraint kind, so specs and configs share a vocabulary."""

    kind: str
    value: Any

    @property
    def name(self) -> str:
        shown = list(self.value) if self.kind == "allowed_values" else self.value
        names = {
            "allowed_values": "isin",
            "min_value": "greater_than_or_equal_to",
            "max_value": "less_than_or_equal_to",
            "greater_than": "greater_than",
            "less_than": "less_than",
        }
        return f"{names[self.kind]}({shown})"

    def holds(self, operand: str) -> str:
        """SQL predicate: true / false for a value, null for a null."""
        if self.kind == "allowed_values":
            return sql.in_list(operand, self.value)
        return f"{operand} {_OPERATORS[self.kind]} {sql.literal(self.value)}"


_OPERATORS = {"min_value": ">=", "max_value": "<=", "greater_than": ">", "less_than": "<"}
CHECK_KINDS = ("allowed_values", *_OPERATORS)


def at_least(value) -> Check:
    return Check("min_value", value)


def at_most(value) -> Check:
    return Check("max_value", value)


def one_of(values) -> Check:
    return Check("allowed_values", tuple(values))


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str = STRING
    nullable: bool = False
    checks: tuple[Check, ...] = ()
    description: str = ""


@dataclass(frozen=True)
class TableCheck:
    """A check over the whole table.

    ``test(df)`` gives either an aggregate Column that must come out true, or a DataFrame of the
    rows that fail.
    """

    name: str
    test: Callable[[DataFrame], Column | DataFrame]


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    strict: bool = False          # extra columns are errors
    coerce: bool = True           # types are checked by casting instead of by the column type
    unique_key: tuple[str, ...] = ()   # validated: at most one row per key
    dedup_key: tuple[str, ...] = ()    # cleaned: keep one row per key
    table_checks: tuple[TableCheck, ...] = ()

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)

    def __getitem__(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def of_type(self, *types: str) -> list[str]:
        return [c.name for c in self.columns if c.type in types]


def _strings(*names: str, nullable: bool = False) -> tuple[ColumnSpec, ...]:
    return tuple(
        ColumnSpec(n, nullable=nullable, description=n.replace("_", " ").capitalize()) for n in names
    )


_UNIT = (at_least(0.0), at_most(1.0))

PROJECTS = TableSpec(
    "projects",
    _strings(
        *fixed.PROJECT_KEYS, "project_name", "study_name", "study_cohort_name",
        "project_manager_name", "disease_name",
    ),
    strict=True, coerce=False,
    unique_key=fixed.PROJECT_KEYS, dedup_key=fixed.PROJECT_KEYS,
)
SUBJECTS = TableSpec(
    "subjects", _strings(*fixed.SUBJECT_KEYS, "sample_type"), dedup_key=fixed.SUBJECT_KEYS,
)
RESULTS = TableSpec(
    "results",
    (
        ColumnSpec("sample_id", description="Sample identifier"),
        ColumnSpec("detection_value", DOUBLE, True, _UNIT, "Detection value"),
        ColumnSpec("cancer_detected", STRING, True, (one_of(fixed.DETECTED_VALUES),),
                   "Detection result"),
        ColumnSpec("sample_status", STRING, True, (one_of(fixed.STATUS_VALUES),), "Sample status"),
        ColumnSpec("fail_reason", STRING, True, (), "Failure reason"),
        ColumnSpec("sample_quality", DOUBLE, True, _UNIT, "Sample quality score"),
        ColumnSpec("sample_quality_threshold", DOUBLE, True, _UNIT, "Sample quality threshold"),
        ColumnSpec("date_of_run", TIMESTAMP, True, (), "Date of run"),
    ),
    dedup_key=fixed.RESULT_KEYS,
)
MERGED = TableSpec(
    "merged",
    _strings(*fixed.SUBJECT_KEYS)
    + (ColumnSpec("detection_value", DOUBLE, True, _UNIT, "Detection value"),)
    + _strings("cancer_detected", "sample_status", nullable=True),
)
SUMMARY = TableSpec(
    "summary",
    (
        ColumnSpec("Code", description="Project, study and cohort code"),
        ColumnSpec("Total_Samples", LONG, False, (at_least(0),), "Number of samples"),
        ColumnSpec("Finished_Percentage", DOUBLE, False, (at_least(0.0), at_most(100.0)),
                   "Percentage of finished samples"),
        ColumnSpec("Lowest_Detection", DOUBLE, True, _UNIT, "Lowest detection value"),
    ),
)

SPECS = {s.name: s for s in (PROJECTS, SUBJECTS, RESULTS, MERGED, SUMMARY)}


def get_spec(name: str) -> TableSpec:
    if name not in SPECS:
        raise ValueError(f"no table spec is called {name!r}; there are {', '.join(SPECS)}")
    return SPECS[name]


def spec_metadata(name: str) -> dict[str, Any]:
    """VAL20: fields, required and nullable fields and types of a built-in spec."""
    spec = get_spec(name)
    return {
        "file_type": spec.name,
        "fields": list(spec.names),
        "required_fields": [c.name for c in spec.columns if not c.nullable],
        "nullable_fields": [c.name for c in spec.columns if c.nullable],
        "field_types": {c.name: SHOWN_TYPES[c.type] for c in spec.columns},
    }


def spec_frame(spark: SparkSession, *specs: TableSpec) -> DataFrame:
    """VAL19 / VAL20: one row per column of the given specs, to join onto errors."""
    rows = [
        (s.name, i, c.name, SHOWN_TYPES[c.type], c.nullable, [k.name for k in c.checks],
         c.description)
        for s in (specs or tuple(SPECS.values()))
        for i, c in enumerate(s.columns)
    ]
    return local_table(
        spark, rows,
        "table_name string, position int, column_name string, data_type string, nullable boolean, "
        "checks array<string>, description string",
    )


@dataclass(frozen=True)
class LintRule:
    types: tuple[str, ...]
    exempt: tuple[str, ...]
    kind: str
    advice: str


# fixed values: required columns that need no check of their own
LINT_RULES = (
    LintRule((STRING,), ("project_code", "study_code", "study_cohort_code", "subject_id", "sample_id"),
             "string_validation", "No check limits the texts of this column"),
    LintRule((DOUBLE, LONG), ("detection_value", "sample_quality"),
             "range_validation", "No check limits the numbers of this column"),
)


def spec_lint(spark: SparkSession, *specs: TableSpec) -> DataFrame:
    """PRJ19: required columns that no check looks at."""
    unchecked = [(s.name, c) for s in specs or SPECS.values() for c in s.columns if not (c.nullable or c.checks)]
    rows = [
        (table, c.name, rule.kind, rule.advice)
        for table, c in unchecked for rule in LINT_RULES if c.type in rule.types and c.name not in rule.exempt
    ]
    return local_table(
        spark, rows, "table_name string, column_name string, rule_type string, suggestion string"
    ).orderBy(F.col("table_name"), F.col("column_name"))
