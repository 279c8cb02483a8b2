"""Small tables held by the plan itself.

A table made from an Arrow table is a local relation: no Python worker reads it, its size is known
to the optimizer, and projections over it are folded away.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_table(spark: SparkSession, rows: Iterable[Sequence[Any]], ddl: str) -> DataFrame:
    """Rows known to the driver (specs, mappings, counts) as a table."""
    return local_rows(spark, rows, T.StructType.fromDDL(ddl))


def local_rows(spark: SparkSession, rows: Iterable[Sequence[Any]], schema: T.StructType) -> DataFrame:
    """The same with a schema at hand."""
    rows = list(rows)
    arrays = [
        pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(to_arrow_schema(schema))
    ]
    return spark.createDataFrame(pa.table(arrays, names=schema.names), schema)


def measured(df: DataFrame) -> DataFrame:
    """Run a plan whose result is bounded by the number of rules and hold the result."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)
