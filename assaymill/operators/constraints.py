"""Constraint filters (FLT1-FLT5, FLT8-FLT10) and the count of what each rule removes (AGG18)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import sqltext as sql
from ..specs import CHECK_KINDS, STRING, Check, TableSpec


@dataclass(frozen=True)
class Constraint:
    """A row is kept when the check holds or, with ``null_ok``, when the value is null."""

    column: str
    check: Check
    null_ok: bool = True

    @property
    def label(self) -> str:
        return f"{self.column}:{self.check.kind}"

    def keep(self) -> str:
        """SQL predicate of the rows that stay."""
        c = sql.name(self.column)
        holds = self.check.holds(c)
        return f"{holds} OR {c} IS NULL" if self.null_ok else f"{holds} AND {c} IS NOT NULL"


def constraints_for(
    spec: TableSpec, configured: Mapping[str, Mapping[str, Any]] | None = None,
    null_in_enum: str = "drop",
) -> list[Constraint]:
    """FLT9, FLT10: the checks of a spec, overridden per kind by configured ones.

    ``null_in_enum`` says what happens to a null in a text column with an allowed-value list:
    ``"drop"`` removes the row, ``"keep"`` keeps it. Other nulls always pass.
    """
    if null_in_enum not in ("drop", "keep"):
        raise ValueError(f"null_in_enum must be 'drop' or 'keep', not {null_in_enum!r}")
    wanted: dict[str, dict[str, Any]] = {
        c.name: {k.kind: k.value for k in c.checks} for c in spec.columns if c.checks
    }
    for column, kinds in (configured or {}).items():
        for kind, value in kinds.items():
            if kind in CHECK_KINDS:
                wanted.setdefault(column, {})[kind] = (
                    tuple(value) if kind == "allowed_values" else value
                )
    texts = set(spec.of_type(STRING))
    return [
        Constraint(
            column, Check(kind, kinds[kind]),
            null_ok=not (kind == "allowed_values" and column in texts and null_in_enum == "drop"),
        )
        for column, kinds in wanted.items()
        for kind in CHECK_KINDS
        if kind in kinds
    ]


def present(df: DataFrame, constraints: Sequence[Constraint]) -> list[Constraint]:
    return [c for c in constraints if c.column in df.columns]


def apply_constraints(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Drop the rows that break any constraint: one filter."""
    keeps = [c.keep() for c in present(df, constraints)]
    return df.filter(sql.all_of(keeps)) if keeps else df


def first_broken(constraints: Sequence[Constraint]) -> Column:
    """Label of the first constraint a row breaks, null for a clean row.

    Counting rows by this label gives what each rule would remove if the rules ran one after the
    other.
    """
    # anything but a plain true drops the row, as in the filter
    return F.expr(sql.first_case(
        [(f"({c.keep()}) IS NOT TRUE", sql.literal(c.label)) for c in constraints],
        sql.literal(None),
    ))


def removed_counters(constraints: Sequence[Constraint], label: str) -> list[Column]:
    """Aggregates ``removed_0 .. removed_n`` over the label column."""
    return [
        F.expr(f"count_if({label} = {sql.literal(c.label)}) AS removed_{i}")
        for i, c in enumerate(constraints)
    ]


def drop_counts(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """FLT8: rows removed by each constraint, one pass, rules without losses included."""
    rules = present(df, constraints)
    counts = df.select(first_broken(rules).alias("_broken")).agg(
        F.count(F.lit(1)).alias("rows_in"), *removed_counters(rules, "_broken"),
    )
    def row(number: int, column: str, rule: str, removed: str) -> dict[str, str]:
        return {"rule_number": str(number), "column_name": sql.literal(column),
                "rule": sql.literal(rule), "rows_in": "rows_in", "rows_removed": removed}

    entries = [row(i + 1, c.column, c.check.kind, f"removed_{i}") for i, c in enumerate(rules)]
    out = counts.selectExpr(sql.rows(entries or [row(0, "", "", "0L")]))
    return out if entries else out.limit(0)
