"""The library's column functions for SQL text (§2.12, §2.14).

Each function is the SQL of the expression that the Python function builds, taken from the analysed
plan, so the two can't drift apart. SQL-defined functions are inlined by the optimizer: a query that
calls them has the plan it would have with the expression written out, without any UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..config import data_section, default_config
from .convert import to_double, to_long, to_timestamp
from .mapping import map_values
from .scores import band, executive_status, severity, severity_priority
from .text import collapse_spaces, composite_code, is_finished, standardize, strip

PREFIX = "assay_"

# name -> (parameters, expression over columns of these names, type)
_FUNCTIONS: dict[str, tuple[dict[str, str], Callable[[], Column], str]] = {
    "strip": ({"x": "string"}, lambda: strip(F.col("x")), "string"),
    "collapse_spaces": ({"x": "string"}, lambda: collapse_spaces(F.col("x")), "string"),
    "standardize": ({"x": "string"}, lambda: standardize(F.col("x")), "string"),
    "tidy": ({"x": "string"}, lambda: standardize(F.col("x"), lower=False), "string"),
    "is_finished": ({"x": "string"}, lambda: is_finished(F.col("x")), "boolean"),
    "code": ({"a": "string", "b": "string", "c": "string"}, lambda: composite_code("a", "b", "c"), "string"),
    "to_double": ({"x": "string"}, lambda: to_double(F.col("x")), "double"),
    "to_long": ({"x": "string"}, lambda: to_long(F.col("x")), "bigint"),
    "to_timestamp": ({"x": "string"}, lambda: to_timestamp(F.col("x"), held=False), "timestamp_ntz"),
    "severity": ({"x": "string"}, lambda: severity(F.col("x")), "string"),
    "severity_priority": ({"x": "string"}, lambda: severity_priority(F.col("x")), "int"),
    "rate_band": ({"rate": "double"}, lambda: band(F.col("rate")), "string"),
    "executive_status": ({"rate": "double"}, lambda: executive_status(F.col("rate")), "string"),
}


def sql_of(spark: SparkSession, parameters: Mapping[str, str], expression: Column, result: str) -> str:
    """The SQL text of an expression over columns of the given names and types."""
    row = spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in parameters.items()])
    plan = row.select(expression.cast(result).alias("_value"))._jdf.queryExecution().analyzed()
    return plan.expressions().apply(0).child().sql()


def define(spark: SparkSession, name: str, parameters: Mapping[str, str], expression: Column, result: str) -> str:
    """A temporary SQL function of the session; gives its name."""
    arguments = ", ".join(f"{n} {t}" for n, t in parameters.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {PREFIX}{name}({arguments}) RETURNS {result} "
              f"RETURN {sql_of(spark, parameters, expression, result)}")
    return f"{PREFIX}{name}"


def register_functions(spark: SparkSession, config: Mapping | None = None) -> list[str]:
    """Define every function for SQL, and ``assay_map_<table>_<column>`` for each value mapping of the
    configuration (the default one, if not given); gives the names."""
    names = [define(spark, n, p, make(), t) for n, (p, make, t) in _FUNCTIONS.items()]
    config = default_config() if config is None else config
    for table in ("projects", "subjects", "results"):
        for column, mapping in data_section(config, "value_mappings", table).items():
            if mapping:
                names.append(define(spark, f"map_{table}_{column}", {"x": "string"}, map_values("x", mapping), "string"))
    return names
