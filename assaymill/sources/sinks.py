"""Writes (SNK1-SNK6). Any callable taking a DataFrame can stand in for these (SNK6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """SNK1: replace the table at ``path``."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_summary_csv(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """SNK2: CSV with a header, sorted by key.

    The sort leaves range partitions that adaptive execution packs into as few files as the size
    allows: a summary of ordinary size is one file, a huge one is not forced through one task.
    """
    out = df.orderBy(*order_by) if order_by else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_report(df: DataFrame, path: str, report_type: str, run_id: str) -> int:
    """SNK3, SNK4: put one report of a run, as JSON, into a table of reports; gives its number of rows.

    The report replaces what the same run wrote before, and nothing else. Null fields are written, so
    that a column of nulls is read back. A report without rows, which the write itself tells, becomes
    one row of nulls whose ``is_empty`` is true: it was made, and found nothing.
    """
    def write(rows: DataFrame, empty: bool) -> None:
        (
            rows.withColumns({"is_empty": F.lit(empty), "report_type": F.lit(report_type), "run_id": F.lit(run_id)})
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("ignoreNullFields", False).partitionBy("report_type", "run_id").json(path)
        )

    observation = Observation(f"{report_type}-{run_id}")
    write(df.observe(observation, F.count(F.lit(1)).alias("rows")), False)
    rows = observation.get["rows"]
    if not rows:
        write(df.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]), True)
    return rows


def write_recipes(recipes: DataFrame, path: str) -> None:
    """SNK5: the recipes, one folder per table, replaced on every run."""
    recipes.write.mode("overwrite").partitionBy("table_name").json(path)
