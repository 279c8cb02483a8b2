"""Tables stored by key, so that duplicate removal and joins share one exchange (JON1, JON5, DST1).

A table is dealt by its join key once. Its duplicates are removed where they lie, as equal rows have
equal join keys; it is written in buckets of that key; and a join of two such tables reads bucket
against bucket. Rows of hot keys, and rows without a key, would make buckets of any size: they are
stored apart, spread, and meet the other side's few rows of the same keys by broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..errors import PlanError
from ..sources.staging import Staging
from .dedup import ROW_POSITION, drop_duplicates
from .merge import inner_join, join_projects, select_known
from .skew import key_hash


@dataclass
class KeyedTable:
    """``keyed`` lies in buckets of ``key``; ``apart`` holds the rows of the hot keys and without a key."""

    keyed: DataFrame
    apart: DataFrame
    key: str
    hot: tuple[int, ...]

    def whole(self) -> DataFrame:
        return self.keyed.unionByName(self.apart)


def stage_by_key(
    staging: Staging, df: DataFrame, name: str, key: str, subset: Sequence[str], hot: Sequence[int] = (),
    buckets: int | None = None, order_by: Sequence[Column | str] | None = None,
) -> KeyedTable:
    """Remove the duplicates of ``df`` by ``subset`` (which holds ``key``) and store what is left by ``key``.

    ``hot`` are hashes of hot keys (see :func:`~assaymill.operators.skew.hot_keys`); tables that are to be
    joined need the same ones, and the same number of ``buckets`` (the session's shuffle partitions, if
    not given). Rows with an incomplete ``subset`` all stay. Which keys are hot never changes a result.
    """
    if key not in subset:
        raise PlanError(f"the join key {key} is no part of {list(subset)}: equal rows could lie apart")
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_apart = F.col(key).isNull()
    if hot:
        is_apart = is_apart | key_hash([key]).isin(*hot)
    is_apart = F.coalesce(is_apart, F.lit(True))

    def unique(rows: DataFrame) -> DataFrame:
        return drop_duplicates(rows, subset, order_by, null_keys_equal=False).drop(ROW_POSITION)

    keyed = unique(df.where(~is_apart).repartition(buckets, F.col(key)))
    return KeyedTable(
        staging.put_bucketed(keyed, f"{name}_keyed", [key], buckets),
        staging.put(unique(df.where(is_apart)), f"{name}_apart"), key, tuple(hot))


def join_keyed(left: KeyedTable, right: KeyedTable, suffix: str = "_right") -> DataFrame:
    """JON1: inner join on the tables' key. ``right`` is unique by that key."""
    if left.key != right.key or left.hot != right.hot:
        raise PlanError("the tables are stored by different keys or hot keys")
    key = left.key
    cold = inner_join(left.keyed, right.keyed, [key], suffix)
    # one row per hot key, and there are at most 1 / HOT_SHARE of those in a set
    few = F.broadcast(right.apart.where(F.col(key).isNotNull()))
    warm = inner_join(left.apart.where(F.col(key).isNotNull()), few, [key], suffix)
    return cold.unionByName(warm)


def merge_keyed(
    projects: DataFrame, subjects: KeyedTable, results: KeyedTable,
    project_keys: Sequence[str] = fixed.PROJECT_KEYS, hot_projects: Sequence[int] = (),
) -> DataFrame:
    """JON5 over stored tables: as :func:`~assaymill.operators.merge.merge_tables`, without an exchange on
    the sample."""
    return select_known(join_projects(join_keyed(subjects, results, "_results"), projects, project_keys, hot=hot_projects))
