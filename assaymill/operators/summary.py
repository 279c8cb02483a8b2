"""Per-group summary (AGG1-AGG6, PRJ15, PRJ16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..errors import PlanError
from ..functions import composite_code, is_finished, percentage, to_double

METRICS = ("samples_detected", "finished_percentage", "lowest_detection")


def summarise(
    df: DataFrame, keys: Sequence[str] = fixed.PROJECT_KEYS, metrics: Sequence[str] = METRICS,
    status_column: str = "sample_status", value_column: str = "detection_value",
    ordered: bool = True,
) -> DataFrame:
    """AGG6: samples, share of finished ones and lowest value per group, in one aggregation.

    Rows with a null key are left out. A missing status column gives 0.0, a missing value column
    null; missing keys are an error. An empty input gives an empty table with all columns.
    """
    missing = [k for k in keys if k not in df.columns]
    if missing or not keys:
        raise PlanError(f"Missing required columns: {missing}" if missing else "No group columns")
    unknown = [m for m in metrics if m not in METRICS]
    if unknown:
        raise PlanError(f"Unknown metrics: {unknown}")
    types = dict(df.dtypes)
    rows = F.count(F.lit(1))
    finished = (
        percentage(F.count_if(is_finished(F.col(status_column))), rows, 2)
        if status_column in types else F.lit(0.0)
    )
    lowest = (
        F.min(to_double(F.col(value_column), types[value_column]))
        if value_column in types else F.lit(None).cast("double")
    )
    aggregates = {
        "samples_detected": rows.alias("Total_Samples"),
        "finished_percentage": finished.alias("Finished_Percentage"),
        "lowest_detection": lowest.alias("Lowest_Detection"),
    }
    out = (
        df.dropna(subset=list(keys)).groupBy(*keys).agg(*[aggregates[m] for m in metrics])
        .withColumn("Code", composite_code(*keys))
    )
    rest = [c for c in out.columns if c not in keys and c != "Code"]
    out = out.select(*keys, "Code", *rest)
    return out.orderBy(*keys) if ordered else out
