"""SQL text for generated expressions.

Rules, counters and their decoding are generated, often by the hundred; written as SQL text, each
bundle is one expression to parse instead of hundreds of calls into the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def literal(value: Any) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_list(operand: str, values: Iterable[Any]) -> str:
    return f"{operand} IN ({', '.join(literal(v) for v in values)})"


def struct(fields: Mapping[str, str]) -> str:
    return "struct(" + ", ".join(f"{sql} AS {name(n)}" for n, sql in fields.items()) + ")"


def array_of_structs(rows: Sequence[Mapping[str, str]]) -> str:
    return "array(" + ", ".join(struct(r) for r in rows) + ")"


def rows(fields: Sequence[Mapping[str, str]]) -> str:
    """A generator that turns one row of counters into one row per entry."""
    return f"inline({array_of_structs(fields)})"


def any_of(predicates: Sequence[str]) -> str:
    return " OR ".join(f"({p})" for p in predicates) if predicates else "false"


def all_of(predicates: Sequence[str]) -> str:
    return " AND ".join(f"({p})" for p in predicates) if predicates else "true"


def first_case(cases: Sequence[tuple[str, str]], otherwise: str = "NULL") -> str:
    """CASE over (condition, result)."""
    if not cases:
        return otherwise
    return "CASE " + " ".join(f"WHEN {c} THEN {r}" for c, r in cases) + f" ELSE {otherwise} END"
