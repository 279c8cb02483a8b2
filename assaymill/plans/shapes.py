"""Messy project, subject and result tables made from the star-schema tables.

The star schema is clean, so the mess -- padding, mixed case, unknown words, impossible numbers,
nulls, duplicates -- is made by expressions over whole tables. The expressions are plain SQL that
Spark and other engines read alike; so a check can start from the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import ROW_POSITION
from ..sources import spread

_CENTS = "cast(round(l_discount * 100) AS bigint)"

# raw column name -> expression over lineitem
RESULTS = {
    "sample_id":
        "CASE WHEN l_orderkey % 97 = 0 THEN NULL "
        "ELSE ' S-' || cast(l_orderkey AS string) || '  ' END",
    " detection_value ":
        "CASE WHEN l_partkey % 10 = 0 THEN CASE l_linenumber "
        "WHEN 1 THEN ' ' WHEN 2 THEN 'N/A' WHEN 3 THEN 'NOT_A_NUMBER' WHEN 4 THEN '1.5' "
        "WHEN 5 THEN '-0.5' WHEN 6 THEN NULL ELSE '1e-1' END "
        f"ELSE '0.' || lpad(cast({_CENTS} * 9 AS string), 2, '0') END",
    "cancer_detected_(yes_no)":
        "CASE l_returnflag WHEN 'R' THEN CASE l_linenumber % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'y' "
        "ELSE 'True' END WHEN 'A' THEN CASE l_linenumber % 3 WHEN 0 THEN 'no' WHEN 1 THEN '0' "
        "ELSE 'FALSE' END ELSE CASE l_linenumber % 4 WHEN 0 THEN 'InvalidValue' WHEN 1 THEN 'NA' "
        "WHEN 2 THEN NULL ELSE 'Yes  ' END END",
    "sample_status(running/finished/failed)":
        "CASE WHEN l_linestatus = 'F' THEN CASE l_linenumber % 3 WHEN 0 THEN 'FINISHED' "
        "WHEN 1 THEN 'completed' ELSE 'Finished ' END "
        "ELSE CASE l_linenumber % 5 WHEN 0 THEN 'running' WHEN 1 THEN ' failed ' "
        "WHEN 2 THEN 'INVALID_STATUS' WHEN 3 THEN 'Error' ELSE 'InProgress' END END",
    "fail_reason(technical/quality)":
        "CASE WHEN l_linestatus = 'F' THEN '  Low' || chr(9) || ' Quality  ' ELSE NULL END",
    "sample_quality":
        "'0.' || lpad(cast(cast(round(l_tax * 100) AS bigint) * 11 AS string), 2, '0')",
    "sample_quality_minimum_threshold":
        "CASE WHEN l_suppkey % 5 = 0 THEN 'n.d.' ELSE '0.5' END",
    "date of run":
        "lpad(cast(day(l_shipdate) AS string), 2, '0') || '/' || cast(month(l_shipdate) AS string) "
        "|| '/' || cast(year(l_shipdate) AS string)",
}
# A total order over lineitem rows: what "first" means for duplicate results.
RESULT_ORDER = (
    "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_orderkey",
)
# The same row told by text.
RESULT_ROW = (
    "lpad(cast(l_orderkey AS string), 12, '0') || '-' || cast(l_linenumber AS string) || '-' || "
    "lpad(cast(l_partkey AS string), 9, '0') || '-' || lpad(cast(l_suppkey AS string), 9, '0') "
    "|| '-' || cast(cast(round(l_extendedprice * 100) AS bigint) AS string)"
)
# over orders, customer and nation
SUBJECTS = {
    "project_code": "' ' || n_name || '  '",
    "study_code": "CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE c_mktsegment END",
    "study_cohort_code": "o_orderstatus",
    "subject_id": "'C-' || cast(o_custkey AS string)",
    "sample_id": "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE 'S-' || cast(o_orderkey AS string) END",
    "type": "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderpriority END",
}
# over orders, customer, nation and region; many rows per key, so keep-first matters
PROJECTS = {
    "project_code": "n_name",
    "study_code": "CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE c_mktsegment END",
    "study_cohort_code": "o_orderstatus",
    "project_name": "'Project  ' || n_name",
    "study_name": "'Study ' || c_mktsegment",
    "study_cohort_name": "'Cohort ' || o_orderstatus",
    "project_manager_name": "c_name",
    "disease_name": "r_name",
}
PROJECT_ORDER = ("o_orderkey",)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shaped(df: DataFrame, shape: Mapping[str, str], order: tuple[str, ...] = ()) -> DataFrame:
    columns = [F.expr(e).alias(c) for c, e in shape.items()]
    if order:
        columns.append(F.struct(*order).alias(ROW_POSITION))
    return df.select(*columns)


def raw_results(spark: SparkSession, folder: str) -> DataFrame:
    return shaped(spread(table(spark, folder, "lineitem")), RESULTS, RESULT_ORDER)


def _orders_of_nations(spark: SparkSession, folder: str) -> DataFrame:
    orders = spread(table(spark, folder, "orders"))
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )


def raw_subjects(spark: SparkSession, folder: str) -> DataFrame:
    return shaped(_orders_of_nations(spark, folder), SUBJECTS, PROJECT_ORDER)


def raw_projects(spark: SparkSession, folder: str) -> DataFrame:
    region = table(spark, folder, "region")
    joined = _orders_of_nations(spark, folder).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return shaped(joined, PROJECTS, PROJECT_ORDER)
