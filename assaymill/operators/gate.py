"""The quality gate in front of cleaning (GAT1-GAT5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .. import sqltext as sql
from .profile import data_columns, null_cells, null_counts

GATE_COLUMNS = ("table_name", "rule", "column_name", "measured", "threshold", "passed")


def _rule(table: str, rule: str, column: str | None, measured: str, threshold: float) -> dict[str, str]:
    limit = sql.literal(float(threshold))
    return {
        "table_name": sql.literal(table), "rule": sql.literal(rule),
        "column_name": sql.literal(column), "measured": f"CAST({measured} AS DOUBLE)",
        "threshold": limit, "passed": f"{measured} <= {limit}",
    }


def key_gate(
    df: DataFrame, table: str, keys: Sequence[str], stats: DataFrame | None = None,
) -> DataFrame:
    """GAT1, GAT4: the key columns are there and hold no null.

    ``stats`` may bring the aggregates of :func:`null_counts` from a pass made anyway.
    """
    names = data_columns(df)
    stats = df.agg(*null_counts(df)) if stats is None else stats
    rules = []
    for k in keys:
        missing = k not in names
        rules.append(_rule(table, "missing_key_column", k, str(int(missing)), 0))
        if not missing:
            rules.append(_rule(table, "null_key", k, f"nulls_{names.index(k)}", 0))
    return stats.selectExpr(sql.rows(rules))


def null_ratio_gate(
    df: DataFrame, table: str, threshold: float = fixed.MAX_NULL_RATIO,
    stats: DataFrame | None = None,
) -> DataFrame:
    """GAT2, GAT3: the share of null cells is at most the threshold; an empty table passes."""
    names = data_columns(df)
    if stats is None:
        stats = df.agg(F.count(F.lit(1)).alias("row_count"), *null_counts(df))
    ratio = f"coalesce(try_divide({null_cells(names)}, row_count * {len(names)}), CAST(0 AS DOUBLE))"
    return stats.selectExpr(sql.rows([_rule(table, "null_ratio", None, ratio, threshold)]))


def quality_gate(
    projects: DataFrame, subjects: DataFrame, results: DataFrame,
    keys: Sequence[str] = fixed.PROJECT_KEYS, threshold: float = fixed.MAX_NULL_RATIO,
) -> DataFrame:
    """GAT5: every rule with its measured value; one aggregate per table."""
    return (
        key_gate(projects, "projects", keys)
        .unionByName(null_ratio_gate(subjects, "subjects", threshold))
        .unionByName(null_ratio_gate(results, "results", threshold))
    )


def gate_passed(gate: DataFrame) -> bool:
    """Action: whether every rule passed."""
    return gate.filter(~F.col("passed")).isEmpty()
