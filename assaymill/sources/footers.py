"""Row and null counts of stored Parquet tables from the file footers (AGG7, AGG8, GAT1-GAT3).

A footer holds each row group's number of rows and, per column, of nulls. An aggregation of counts over
such a table is pushed into the source, so that no data page is read: 100 TB of columns are measured
by their footers. Footers know nothing of NaN, nor of nested columns; only these are read.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import sqltext as sql
from ..local import local_rows
from ..operators.dedup import ROW_POSITION
from ..operators.profile import is_missing

_FLOATS = (T.DoubleType, T.FloatType)
_NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
# what the source says where a footer lacks the number of nulls
_NO_COUNTS = "aggregatePushdown"


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of its own, over the same context, whose Parquet source takes aggregates."""
    session = spark.newSession()
    v1 = session.conf.get("spark.sql.sources.useV1SourceList")
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in v1.split(",") if x != "parquet"))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def counted_by_footers(schema: T.StructType) -> list[str]:
    """The columns whose nulls the footers tell."""
    return [f.name for f in schema if not isinstance(f.dataType, (*_FLOATS, *_NESTED))]


def footer_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``row_count`` and ``values_0 .. values_n``, the non-null values of each column that
    :func:`counted_by_footers` names."""
    table = footer_session(spark).read.parquet(path)
    names = counted_by_footers(table.schema)
    return table.agg(F.count(F.lit(1)).alias("row_count"), *[
        F.count(F.col(f"`{c}`")).alias(f"values_{i}") for i, c in enumerate(names)])


def stored_null_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row as :func:`assaymill.operators.profile.null_counts` gives it for the whole table, with
    ``row_count``: what the gate and the null profile take as ``stats``. Columns are the table's own.

    Files whose footers leave counts out are read like any others.
    """
    table = spark.read.parquet(path)
    fields = [f for f in table.schema if f.name != ROW_POSITION]
    types, known = dict(table.dtypes), counted_by_footers(T.StructType(fields))
    try:
        row = footer_counts(spark, path).first()
        rows = row["row_count"] or 0  # null where there is no row group at all
        found = {c: rows - (row[f"values_{i}"] or 0) for i, c in enumerate(known)}
    except (PySparkException, Py4JJavaError) as e:
        if _NO_COUNTS not in str(e):
            raise
        found, rows = {}, None
    rest = [f.name for f in fields if f.name not in found]
    if rest or rows is None:
        row = table.agg(F.count(F.lit(1)).alias("row_count"), *[
            F.expr(f"count_if({is_missing(c, types[c])}) AS {sql.name(f'nulls_{i}')}") for i, c in enumerate(rest)]).first()
        found.update({c: row[f"nulls_{i}"] for i, c in enumerate(rest)})
        rows = row["row_count"]
    schema = T.StructType([T.StructField("row_count", T.LongType())] + [
        T.StructField(f"nulls_{i}", T.LongType()) for i in range(len(fields))])
    return local_rows(spark, [[rows, *(found[f.name] for f in fields)]], schema)
