"""Joining the cleaned tables (JON1-JON6, SET1, SET2, PRJ14)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..errors import PlanError
from .dedup import ROW_POSITION, drop_duplicates
from .skew import join_on_keys


def _suffix_clashes(left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    taken = set(left.columns) - set(keys)
    return right.withColumnsRenamed(
        {c: c + suffix for c in right.columns if c in taken and c not in keys}
    )


def inner_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str = "_right",
    null_safe: bool = False, hot: Sequence[int] = (),
) -> DataFrame:
    """JON1, JON4: inner equi-join; right columns that clash get ``suffix``.

    Null keys match nothing unless ``null_safe``. ``hot`` names keys of ``left`` to spread, see
    :mod:`assaymill.operators.skew`. No side is broadcast by a hint: Spark broadcasts a side whose
    size it knows, or finds out at run time, to be under its threshold, and sort-merges otherwise.
    """
    missing = [k for k in keys if k not in left.columns or k not in right.columns]
    if missing:
        raise PlanError(f"join keys missing: {missing}")
    right = _suffix_clashes(left, right, keys, suffix)
    return join_on_keys(left, right, keys, null_safe, hot)


def join_projects(
    samples: DataFrame, projects: DataFrame, keys: Sequence[str] = fixed.PROJECT_KEYS,
    order_by: Sequence[Column | str] | None = None, null_safe: bool = False,
    hot: Sequence[int] = (),
) -> DataFrame:
    """JON2, JON3, SET1: attach project attributes.

    Joins on the keys both sides have, with the projects made unique on them first. When one side
    has none of the keys at all, the rows are stacked instead.
    """
    ours = [k for k in keys if k in samples.columns]
    theirs = [k for k in keys if k in projects.columns]
    if not ours or not theirs:
        return stack(samples, projects)
    common = [k for k in ours if k in theirs]
    if not common:
        raise PlanError(f"no common merge key: {ours} against {theirs}")
    unique = drop_duplicates(projects, common, order_by).drop(ROW_POSITION)
    return inner_join(samples, unique, common, "_projects", null_safe, hot)


def stack(top: DataFrame, bottom: DataFrame) -> DataFrame:
    """SET1: rows of both tables, columns by name, null where a side lacks one."""
    return top.unionByName(bottom, allowMissingColumns=True)


def select_known(df: DataFrame, columns: Sequence[str] = fixed.MERGED_COLUMNS) -> DataFrame:
    """PRJ14: the known output columns the table has, in fixed order; all columns if none."""
    names = [c for c in columns if c in df.columns]
    return df.select(*names) if names else df


def merge_tables(
    projects: DataFrame, subjects: DataFrame, results: DataFrame,
    order_by: Sequence[Column | str] | None = None, null_safe: bool = False,
    hot_samples: Sequence[int] = (), hot_projects: Sequence[int] = (),
) -> DataFrame:
    """JON5: subjects with their results and project attributes.

    ``order_by`` decides which of several equal projects is kept. ``hot_samples`` /
    ``hot_projects`` are the hot keys of ``subjects`` (see :func:`assaymill.operators.skew.hot_keys`).
    """
    if "sample_id" not in subjects.columns or "sample_id" not in results.columns:
        raise PlanError("sample_id is needed in subjects and results")
    subjects, results = subjects.drop(ROW_POSITION), results.drop(ROW_POSITION)
    samples = inner_join(subjects, results, ["sample_id"], "_results", null_safe, hot_samples)
    merged = join_projects(
        samples, projects, order_by=order_by, null_safe=null_safe, hot=hot_projects
    )
    return select_known(merged)


def orphan_rows(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JON6: rows of ``left`` an inner join would lose; a null key matches nothing."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    # rows without a whole key are orphans already, so a hot null key is never dealt to one task
    lost = left.filter(~has_null).join(right.select(*keys).distinct(), list(keys), "left_anti")
    return lost.select(*left.columns).unionByName(left.filter(has_null))


def orphan_counts(
    projects: DataFrame, subjects: DataFrame, results: DataFrame,
    keys: Sequence[str] = fixed.PROJECT_KEYS,
) -> DataFrame:
    """JON6: how many rows of each table find no partner.

    The two sides of a relation are counted per key in one aggregation, so a hot key is
    pre-aggregated before the shuffle and both directions come out of the same pass.
    """
    common = [k for k in keys if k in subjects.columns and k in projects.columns]
    parts = [
        _unmatched(subjects, results, ["sample_id"],
                   "subjects_without_results", "results_without_subjects"),
    ]
    if common:
        parts.append(_unmatched(subjects, projects, common, "subjects_without_project", None))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _unmatched(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_name: str, right_name: str | None,
) -> DataFrame:
    def side(df: DataFrame, l: int, r: int) -> DataFrame:
        return df.select(*keys, F.lit(l).alias("_l"), F.lit(r).alias("_r"))

    per_key = (
        side(left, 1, 0).unionByName(side(right, 0, 1))
        .groupBy(*keys).agg(F.sum("_l").alias("l"), F.sum("_r").alias("r"))
    )
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    lost = per_key.agg(
        F.sum(F.when(null_key | (F.col("r") == 0), F.col("l"))).alias("l"),
        F.sum(F.when(null_key | (F.col("l") == 0), F.col("r"))).alias("r"),
    )
    rows = [F.struct(F.lit(left_name).alias("relation"),
                     F.coalesce(F.col("l"), F.lit(0)).cast("bigint").alias("lost_rows"))]
    if right_name:
        rows.append(F.struct(F.lit(right_name).alias("relation"),
                             F.coalesce(F.col("r"), F.lit(0)).cast("bigint").alias("lost_rows")))
    return lost.select(F.explode(F.array(*rows)).alias("o")).select("o.*")


def column_differences(df: DataFrame, expected: Sequence[str]) -> dict[str, list[str]]:
    """SET2: which expected columns are missing, which are extra, which are there."""
    have = df.columns
    return {
        "missing": [c for c in expected if c not in have],
        "extra": [c for c in have if c not in expected],
        "valid": [c for c in expected if c in have],
    }
