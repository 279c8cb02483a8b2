"""Duplicate removal (DST1-DST3) and duplicate counting (AGG9, VAL8)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import PlanError

# Position of a row in its source, put there by the scans: the meaning of "first" in "keep first".
ROW_POSITION = "_row_position"


def default_order(df: DataFrame, order_by: Sequence[Column | str] | None = None) -> list[Column]:
    """The given order, else the source position, else all columns (any total order will do)."""
    if order_by:
        return [F.col(c) if isinstance(c, str) else c for c in order_by]
    if ROW_POSITION in df.columns:
        return [F.col(ROW_POSITION)]
    return [F.col(f"`{c}`") for c in df.columns]


def drop_duplicates(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None,
    keep: str | bool = "first", null_keys_equal: bool = True,
) -> DataFrame:
    """One row per key: the first or last in order, or with ``keep=False`` only unrepeated keys.

    ``dropDuplicates`` does not say which row survives; this does, whatever the partitioning, as
    long as the order has no ties. Null keys equal each other, or with
    ``null_keys_equal=False`` nothing, so that their rows all stay; keys the table lacks are ignored.

    Skew: for first / last the optimizer puts a ``WindowGroupLimit`` in front of the shuffle, so
    each task sends at most one row per key. ``keep=False`` counts with a partial aggregate, so a
    hot key is reduced to one row per task as well.
    """
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df
    if keep is False:
        return _drop_all_repeated(df, keys, null_keys_equal)
    if keep not in ("first", "last"):
        raise PlanError(f"keep must be 'first', 'last' or False, not {keep!r}")
    order = default_order(df, order_by)
    order = [c.asc_nulls_first() if keep == "first" else c.desc_nulls_last() for c in order]
    rank = "_dup_rank"
    # a row without a whole key is a group by itself, which also spreads such rows over the tasks
    alone = [] if null_keys_equal else [F.when(_any_null(keys), F.struct(*default_order(df, order_by)))]
    # the hash goes first: sorting then compares numbers, and texts only within a key
    window = Window.partitionBy(F.xxhash64(*keys), *keys, *alone).orderBy(*order)
    return (
        df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)
    )


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _drop_all_repeated(df: DataFrame, keys: Sequence[str], null_keys_equal: bool) -> DataFrame:
    """The keys alone are counted, in a hash aggregate; rows meet the few repeated ones again."""
    repeated = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")).filter(F.col("_copies") > 1)
        .select(*[F.col(k).alias(f"_repeated_{k}") for k in keys])
    )
    equal = [F.col(k).eqNullSafe(F.col(f"_repeated_{k}")) if null_keys_equal
             else F.col(k) == F.col(f"_repeated_{k}") for k in keys]
    return df.join(repeated, reduce(lambda a, b: a & b, equal), "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """VAL8: keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def duplicate_count(df: DataFrame, keys: Sequence[str], null_keys_equal: bool = True) -> DataFrame:
    """AGG9: one row, the number of rows that repeat an earlier key; see :func:`drop_duplicates`."""
    surplus = F.col("copies") - 1
    if not null_keys_equal:
        surplus = F.when(_any_null(keys), 0).otherwise(surplus)
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("rows_in"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.coalesce(F.sum(surplus), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        )
    )
