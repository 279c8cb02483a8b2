"""Value mapping (PRJ4)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import sqltext as sql

# How a null cell reads when a mapping names it.
_NULL_TEXT = "nan"


def compile_mapping(mapping: Mapping[str, str | None]) -> dict[str, str | None]:
    """Resolve an ordered mapping to one lookup by lower-cased text.

    Entries apply one after the other, so an entry may pick up what an earlier one produced; the
    chain is followed here once instead of per row. A value mapped to null stays null.
    """
    entries = [(str(old).lower(), new) for old, new in mapping.items()]
    resolved: dict[str, str | None] = {}
    for start, _ in entries:
        value: str | None = start
        for old, new in entries:
            if value is not None and value.lower() == old:
                value = new
        resolved[start] = value
    return resolved


def map_values(column: str, mapping: Mapping[str, str | None]) -> Column:
    """Replace whole values, ignoring case; values without an entry stay as they are."""
    lookup = compile_mapping(mapping)
    if not lookup:
        return F.col(column)
    by_target: dict[str | None, list[str]] = {}
    for source, target in lookup.items():
        by_target.setdefault(target, []).append(source)
    text = f"CAST({sql.name(column)} AS STRING)"
    cases = [
        (sql.in_list(f"lower({text})", sources), sql.literal(target))
        for target, sources in by_target.items()
    ]
    if lookup.get(_NULL_TEXT) is not None:
        cases.append((f"{text} IS NULL", sql.literal(lookup[_NULL_TEXT])))
    return F.expr(sql.first_case(cases, text))
