"""What cleaning did, measured (AGG10, AGG11, AGG18, RPT17, RPT19, RPT20)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import percentage
from .. import sqltext as sql
from ..local import local_table
from ..plans.recipe import Recipe, apply_recipe, apply_step, trace_recipe
from .constraints import first_broken, present, removed_counters
from .dedup import duplicate_count
from .profile import row_counts

STEP_SCHEMA = (
    "table_name string, step_number int, step_name string, column_name string, rule string, "
    "rows_in bigint, cells_changed bigint, rows_removed bigint"
)


def step_metrics(df: DataFrame, recipe: Recipe, deduplicate: bool = True) -> DataFrame:
    """RPT20, AGG18: per step, column and rule: cells changed and rows removed.

    One aggregation measures all column steps and constraints together: the values before each
    step are kept beside the values after it. A removed row is charged to the first constraint it
    breaks. The duplicate removal needs its shuffle and is counted apart (on the keys only);
    ``deduplicate=False`` leaves it to the caller.
    """
    traced, changed = trace_recipe(df, recipe)
    step = recipe.step("constraint_application")
    rules = present(traced, step.parameters["constraints"]) if step else []
    label = first_broken(rules)
    stats = traced.select("*", label.alias("_broken")).agg(
        F.count(F.lit(1)).alias("rows_in"),
        *[F.expr(f"count_if({cond}) AS changed_{i}") for i, (_, _, cond) in enumerate(changed)],
        *removed_counters(rules, "_broken"),
    )

    def row(number: int, step_name: str, column, rule, cells: str, removed: str) -> dict[str, str]:
        return {
            "table_name": sql.literal(recipe.spec.name), "step_number": str(number),
            "step_name": sql.literal(step_name), "column_name": sql.literal(column),
            "rule": sql.literal(rule), "rows_in": "rows_in", "cells_changed": cells,
            "rows_removed": removed,
        }

    rows = [row(s.number, s.name, c, None, f"changed_{i}", "0L")
            for i, (s, c, _) in enumerate(changed)]
    rows += [row(step.number, step.name, r.column, r.check.kind, "0L", f"removed_{i}")
             for i, r in enumerate(rules)]
    out = stats.selectExpr(sql.rows(rows or [row(0, "none", None, None, "0L", "0L")]))
    dedup = recipe.step("duplicate_removal")
    if deduplicate and dedup:
        filtered = apply_recipe(df, recipe.without("duplicate_removal"))
        keys = [k for k in dedup.parameters["subset"] if k in filtered.columns]
        if keys:
            out = out.unionByName(duplicate_count(filtered, keys, null_keys_equal=False).select(
                F.lit(recipe.spec.name).alias("table_name"),
                F.lit(dedup.number).alias("step_number"), F.lit(dedup.name).alias("step_name"),
                F.lit(None).cast("string").alias("column_name"),
                F.lit(None).cast("string").alias("rule"), "rows_in",
                F.lit(0).cast("bigint").alias("cells_changed"),
                F.col("duplicate_rows").alias("rows_removed"),
            ))
    return out


def mapping_effects(df: DataFrame, recipe: Recipe) -> DataFrame:
    """RPT17: every value mapping with the rows it applies to.

    Counts the distinct values of the mapped columns first (pre-aggregated), then matches them with
    the mapping entries, of which there are few.
    """
    step = recipe.step("value_mapping")
    rename = recipe.step("column_mapping")
    renamed = apply_step(df, rename) if rename else df
    entries = [
        (c, str(old).lower(), old, new)
        for c, m in (step.parameters["value_mappings"] if step else {}).items()
        if c in renamed.columns for old, new in m.items()
    ]
    known = local_table(
        df.sparkSession, entries, "column_name string, key string, from_value string, to_value string"
    )
    columns = list(dict.fromkeys(e[0] for e in entries))
    if not columns:
        return known.select("column_name", "from_value", "to_value",
                            F.lit(0).cast("bigint").alias("rows_affected"))
    cells = []
    for c in columns:
        key = f"lower(CAST({sql.name(c)} AS STRING))"
        known_key = sql.in_list(key, {k: None for c2, k, _, _ in entries if c2 == c})
        cells.append({"column_name": sql.literal(c), "key": f"CASE WHEN {known_key} THEN {key} END"})
    hits = (
        renamed.selectExpr(sql.rows(cells))
        .filter(F.col("key").isNotNull())
        .groupBy("column_name", "key").agg(F.count(F.lit(1)).alias("rows_affected"))
    )
    return known.join(hits, ["column_name", "key"], "left").select(
        "column_name", "from_value", "to_value",
        F.coalesce("rows_affected", F.lit(0)).alias("rows_affected"),
    )


def table_metrics(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame]) -> DataFrame:
    """RPT19, AGG10: input rows, output rows, filtered rows and success rate per table."""
    rows_in = row_counts(before).withColumnRenamed("row_count", "input_rows")
    rows_out = row_counts(after).withColumnRenamed("row_count", "output_rows")
    return with_rates(rows_in.join(rows_out, "table_name", "full"))


def counted_metrics(
    spark: SparkSession, rows_in: Mapping[str, int], rows_out: Mapping[str, int],
) -> DataFrame:
    """RPT19 from numbers of rows that staged writes have counted."""
    return with_rates(local_table(
        spark, [(n, rows_in.get(n), rows_out[n]) for n in rows_out],
        "table_name string, input_rows bigint, output_rows bigint"))


def with_rates(counts: DataFrame) -> DataFrame:
    """``table_name, input_rows, output_rows`` with what was lost. A table without an input (made
    by the run itself) has neither loss nor rate."""
    return counts.select(
        "table_name", "input_rows", "output_rows",
        (F.col("input_rows") - F.col("output_rows")).alias("filtered_rows"),
        F.when(F.col("input_rows").isNotNull(),
               percentage(F.col("output_rows"), F.col("input_rows"), 1)).alias("success_rate"),
    )


def stage_delta(
    before: DataFrame, after: DataFrame, table: str, rows: tuple[int, int] | None = None,
) -> DataFrame:
    """AGG11: shape before and after cleaning, rows removed, columns added. ``rows`` brings the numbers of
    rows where a staged write has counted them; only then neither table is read."""
    if rows is None:
        counts = (
            row_counts({"before": before, "after": after})
            .groupBy().pivot("table_name", ["before", "after"]).agg(F.max("row_count")))
    else:
        counts = local_table(before.sparkSession, [rows], "before bigint, after bigint")
    return (
        counts.select(
            F.lit(table).alias("table_name"), F.col("before").alias("rows_before"),
            F.col("after").alias("rows_after"),
            F.lit(len(before.columns)).alias("columns_before"),
            F.lit(len(after.columns)).alias("columns_after"),
            (F.col("before") - F.col("after")).alias("rows_removed"),
            F.lit(len(after.columns) - len(before.columns)).alias("columns_added"),
        )
    )


def column_mapping_effects(df: DataFrame, recipe: Recipe) -> DataFrame:
    """RPT17: every configured rename and whether the table has the column."""
    step = recipe.step("column_mapping")
    return local_table(
        df.sparkSession, [(recipe.spec.name, old, new, old in df.columns)
         for old, new in (step.parameters["column_mappings"] if step else {}).items()],
        "table_name string, from_column string, to_column string, applied boolean",
    )
