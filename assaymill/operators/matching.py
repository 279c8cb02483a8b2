"""One-to-one matching of schema names and table columns (PRJ3).

Each pair has a weight: the same name, the configured name, or a loose likeness; the matching of
greatest total weight is found by the Hungarian method. So no column serves two names, and a name gives
up its best column where another one needs it more. Tables have at most thousands of columns:
this is plan-building work.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from difflib import SequenceMatcher
from typing import Any

from pyspark.sql import DataFrame

from ..config import data_section
from ..specs import TableSpec

#: Weights: one pair of a kind outweighs any number of pairs of lesser kinds' likenesses.
SAME, CONFIGURED, CONTAINED, ALIKE = 8.0, 6.0, 3.0, 1.0
#: Names less alike than this are no pair.
LEAST_LIKENESS = 0.6


def plain(name: str) -> str:
    """A name without case, underscores, blanks and signs."""
    return re.sub(r"[\W_]", "", name).lower()


def weight(name: str, column: str, configured: Mapping[str, str], loose: bool = True) -> float:
    """How well a column serves a schema name; 0 if not at all."""
    if name == column:
        return SAME
    if configured.get(column) == name:
        return CONFIGURED
    a, b = plain(name), plain(column)
    if not loose or not a or not b:
        return 0.0
    if a in b or b in a:
        return CONTAINED + min(len(a), len(b)) / max(len(a), len(b))
    likeness = SequenceMatcher(None, a, b, autojunk=False).ratio()
    return ALIKE * likeness if likeness >= LEAST_LIKENESS else 0.0


def best_assignment(weights: Sequence[Sequence[float]]) -> list[int | None]:
    """For each row the column it gets, or None: the assignment of greatest total weight, in which pairs
    of weight 0 don't stand. Of equal ones the first by position of the columns is found."""
    n_rows, n_columns = len(weights), len(weights[0]) if weights else 0
    n = max(n_rows, n_columns)
    if not n:
        return []
    top = max(max(row, default=0.0) for row in weights)
    cost = [[top - (weights[i][j] if i < n_rows and j < n_columns else 0.0) for j in range(n)] for i in range(n)]
    rows_price, columns_price, owner = [0.0] * (n + 1), [0.0] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):  # one row more at a time, along the cheapest alternating path
        owner[0], at = i, 0
        least, came, done = [float("inf")] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        while owner[at]:
            done[at] = True
            row, step, nearest = owner[at], float("inf"), 0
            for j in range(1, n + 1):
                if not done[j]:
                    slack = cost[row - 1][j - 1] - rows_price[row] - columns_price[j]
                    if slack < least[j]:
                        least[j], came[j] = slack, at
                    if least[j] < step:
                        step, nearest = least[j], j
            for j in range(n + 1):
                if done[j]:
                    rows_price[owner[j]] += step
                    columns_price[j] -= step
                else:
                    least[j] -= step
            at = nearest
        while at:
            owner[at] = owner[came[at]]
            at = came[at]
    out: list[int | None] = [None] * n_rows
    for j in range(1, n_columns + 1):
        i = owner[j] - 1
        if i < n_rows and weights[i][j - 1] > 0:
            out[i] = j - 1
    return out


def match_columns(
    df: DataFrame, spec: TableSpec, config: Mapping[str, Any] | None = None, loose: bool = True,
) -> dict[str, str]:
    """PRJ3: schema name -> table column, each column at most once."""
    configured = data_section(config, "column_mappings", spec.name)
    columns = df.columns
    found = best_assignment([[weight(n, c, configured, loose) for c in columns] for n in spec.names])
    return {n: columns[j] for n, j in zip(spec.names, found) if j is not None}


def with_schema_names(
    df: DataFrame, spec: TableSpec, config: Mapping[str, Any] | None = None, loose: bool = True,
) -> DataFrame:
    """The table with the matched columns under their schema names; others keep theirs."""
    return df.withColumnsRenamed({c: n for n, c in match_columns(df, spec, config, loose).items()})
