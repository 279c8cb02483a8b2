"""Profiling of raw or cleaned tables (AGG7-AGG8, AGG10, AGG17, TOP3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import sqltext as sql
from .dedup import ROW_POSITION, default_order

_FLOATS = ("double", "float")


def data_columns(df: DataFrame) -> list[str]:
    """Columns of the table itself, without the engine's row position."""
    return [c for c in df.columns if c != ROW_POSITION]


def is_missing(column: str, data_type: str) -> str:
    """FLT7, as SQL: null, or NaN in a floating-point column."""
    c = sql.name(column)
    return f"({c} IS NULL OR isnan({c}))" if data_type in _FLOATS else f"{c} IS NULL"


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Aggregates ``nulls_0 .. nulls_n``, one per column, for use in a shared single pass."""
    types = dict(df.dtypes)
    return [
        F.expr(f"count_if({is_missing(c, types[c])}) AS nulls_{i}")
        for i, c in enumerate(columns or data_columns(df))
    ]


def null_cells(columns: Sequence[str]) -> str:
    """SQL sum of the counters of :func:`null_counts`."""
    return " + ".join(f"nulls_{i}" for i in range(len(columns)))


def null_profile(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """AGG7: rows, nulls and share of nulls per column, one pass; none if ``stats`` brings the counts
    (see :func:`assaymill.sources.footers.stored_null_counts`)."""
    names = data_columns(df)
    if stats is None:
        stats = df.agg(F.count(F.lit(1)).alias("row_count"), *null_counts(df))
    return stats.selectExpr(sql.rows([
        {"column_name": sql.literal(c), "row_count": "row_count", "null_count": f"nulls_{i}",
         "null_ratio": f"coalesce(try_divide(nulls_{i}, row_count), CAST(0 AS DOUBLE))"}
        for i, c in enumerate(names)
    ]))


def null_ratio(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """AGG8: one row, the share of null cells in the table; 0 for an empty table. ``stats`` as above."""
    names = data_columns(df)
    if stats is None:
        stats = df.agg(F.count(F.lit(1)).alias("row_count"), *null_counts(df))
    return stats.selectExpr(
        "row_count", f"{null_cells(names)} AS null_cells",
        f"coalesce(try_divide({null_cells(names)}, row_count * {len(names)}), CAST(0 AS DOUBLE)) "
        "AS null_ratio",
    )


def _cells(columns: Sequence[str]) -> str:
    return sql.array_of_structs([
        {"column_name": sql.literal(c), "value": f"CAST({sql.name(c)} AS STRING)"} for c in columns
    ])


def value_census(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG17: every distinct value of the given columns with its number of rows."""
    return (
        df.select(F.expr(f"inline({_cells(columns)})"))
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))
    )


def sample_values(
    df: DataFrame, columns: Sequence[str], order_by: Sequence[Column | str] | None = None, n: int = 3,
) -> DataFrame:
    """TOP3: the first ``n`` non-null values of each column, with their rank.

    The rank filter becomes a group limit in front of the shuffle: each task passes on at most
    ``n`` rows per column.
    """
    order = F.struct(*default_order(df, order_by))
    window = Window.partitionBy("column_name").orderBy("_order")
    return (
        df.select(order.alias("_order"), F.expr(f"inline({_cells(columns)})"))
        .filter(F.col("value").isNotNull())
        .withColumn("value_rank", F.row_number().over(window))
        .filter(F.col("value_rank") <= n)
        .select("column_name", "value_rank", "value")
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """AGG10: rows per named table, in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
