"""Validation against a spec (VAL1-VAL18).

All rules of a table are counted in one aggregation without a shuffle of its rows. Only when the
failing cells themselves are asked for does a second pass produce them, and then only from the
rows that fail.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import sqltext as sql
from ..errors import ValidationFailed
from ..functions import convert
from ..local import local_table
from ..specs import SHOWN_TYPES, SPARK_TYPES, STRING, TableSpec
from .compute import computed_once
from .dedup import ROW_POSITION, default_order, duplicate_count
from .profile import data_columns, is_missing

MISSING_COLUMN, EXTRA_COLUMN = "MissingColumn", "ExtraColumn"
TYPE_MISMATCH, VALUE_ERROR = "TypeMismatch", "ValidationError"


@dataclass(frozen=True)
class CellRule:
    """A rule on single cells; ``failed`` is an SQL predicate, true or false for every row."""

    column: str
    check_name: str
    error_type: str
    failed: str


def failure_message(column: str, check: str, value: str) -> str:
    """VAL11, as SQL over SQL operands."""
    return (
        f"concat('Column \\'', {column}, '\\' failed check \\'', {check}, '\\': ', "
        f"coalesce({value}, 'null'))"
    )


class Validation:
    """The rules of one spec laid over one table at one stage. Nothing runs until asked for."""

    def __init__(self, df: DataFrame, spec: TableSpec, stage: str = "validation"):
        self.df, self.spec, self.stage = df, spec, stage
        self.columns = data_columns(df)
        self.missing = [c for c in spec.names if c not in self.columns]
        self.extra = [c for c in self.columns if c not in spec.names]
        self._types = dict(df.dtypes)
        # VAL3: without coercion the column type itself has to fit
        self.mistyped = [] if spec.coerce else [
            c.name for c in spec.columns
            if c.name in self._types and self._types[c.name] != SPARK_TYPES[c.type]
        ]
        self.rules, self._typed = self._cell_rules()

    # --- rules ---------------------------------------------------------------------------------

    def _cell_rules(self) -> tuple[list[CellRule], dict[str, Column]]:
        """The rules, and the typed copies of columns that some of them look at."""
        rules, typed = [], {}
        for c in self.spec.columns:
            if c.name not in self.columns or c.name in self.mistyped:
                continue
            source = self._types[c.name]
            missing = is_missing(c.name, source)
            value = sql.name(c.name)
            if source != SPARK_TYPES[c.type]:
                copy = f"_typed_{c.name}"
                typed[copy] = convert(F.col(f"`{c.name}`"), c.type, source)
                value = sql.name(copy)
                if c.type != STRING:  # VAL4: everything has a text form
                    rules.append(CellRule(
                        c.name, f"coerce_dtype('{SHOWN_TYPES[c.type]}')", TYPE_MISMATCH,
                        f"NOT ({missing}) AND {value} IS NULL",
                    ))
            if not c.nullable:  # VAL5
                rules.append(CellRule(c.name, "not_nullable", VALUE_ERROR, missing))
            for check in c.checks:  # VAL6, VAL7: nulls pass
                rules.append(CellRule(
                    c.name, check.name, VALUE_ERROR, f"({check.holds(value)}) IS FALSE"
                ))
        return rules, typed

    def prepared(self) -> DataFrame:
        """The table with the typed copies its rules look at."""
        return self.df.withColumns(self._typed) if self._typed else self.df

    def _static_findings(self) -> list[tuple[str, str, str, str]]:
        """(column, check, error type, example) of everything the schema alone tells."""
        found = [(c, "column_in_dataframe", MISSING_COLUMN, c) for c in self.missing]
        if self.spec.strict:
            found += [(c, "column_in_schema", EXTRA_COLUMN, c) for c in self.extra]
        found += [
            (c, f"dtype('{SHOWN_TYPES[self.spec[c].type]}')", TYPE_MISMATCH, self._types[c])
            for c in self.mistyped
        ]
        return found

    def any_failed(self) -> str:
        return sql.any_of([r.failed for r in self.rules])

    # --- counting --------------------------------------------------------------------------------

    def aggregates(self) -> list[Column]:
        """Aggregates over :meth:`prepared` for a shared single pass; :meth:`rule_counts` reads
        them back."""
        # without a required column no row is valid
        invalid = "count(1)" if self.missing else f"count_if({self.any_failed()})"
        out = ["count(1) AS total_rows", f"{invalid} AS invalid_rows"]
        for i, r in enumerate(self.rules):
            example = f"CASE WHEN {r.failed} THEN CAST({sql.name(r.column)} AS STRING) END"
            out.append(f"count_if({r.failed}) AS failed_{i}")
            out.append(f"min({example}) AS example_{i}")
        columns = [F.expr(e) for e in out]
        for i in self._aggregate_checks():
            columns.append(self.spec.table_checks[i].test(self.df).alias(f"table_check_{i}"))
        return columns

    def stats(self, *more: Column) -> DataFrame:
        """One row with the aggregates, and ``more`` of the caller's from the same pass."""
        return self.completed(self.prepared().agg(*self.aggregates(), *more))

    def completed(self, stats: DataFrame) -> DataFrame:
        """The row of :meth:`aggregates`, wherever it was measured, with the counts of the rules that
        need a shuffle."""
        out = stats
        for i, (_, counted) in enumerate(self._counted_elsewhere()):
            out = out.withColumn(f"elsewhere_{i}", counted.select("failed_cells").scalar())
        return out

    def entries(self) -> list[tuple[str | None, str, str, str, str]]:
        """Every rule as (column, check, error type, SQL of its count, SQL of its example), the
        last two over the columns of :meth:`stats`. The place in the list is the rule number."""
        none = sql.literal(None)
        out = [
            (column, check, error_type, "1", sql.literal(example))
            for column, check, error_type, example in self._static_findings()
        ]
        out += [
            (r.column, r.check_name, r.error_type, f"failed_{i}", f"example_{i}")
            for i, r in enumerate(self.rules)
        ]
        out += [  # VAL9
            (None, self.spec.table_checks[i].name, VALUE_ERROR,
             f"int(table_check_{i} IS NOT TRUE)", none)
            for i in self._aggregate_checks()
        ]
        out += [
            (None, check, VALUE_ERROR, f"elsewhere_{i}", none)
            for i, (check, _) in enumerate(self._counted_elsewhere())
        ]
        return out

    def rule_counts(self, stats: DataFrame | None = None) -> DataFrame:
        """Every rule with the number of cells that fail it; rules without failures included."""
        stats = self.stats() if stats is None else stats
        entries = self.entries()
        rows = [
            {
                "rule_number": str(n), "table_name": sql.literal(self.spec.name),
                "stage": sql.literal(self.stage), "column_name": sql.literal(column),
                "check_name": sql.literal(check), "error_type": sql.literal(error_type),
                "failed_cells": f"CAST({failed} AS BIGINT)", "example": example,
            }
            for n, (column, check, error_type, failed, example)
            in enumerate(entries or [(None, "none", VALUE_ERROR, "0", sql.literal(None))], 1)
        ]
        out = stats.selectExpr(sql.rows(rows))
        return out if entries else out.limit(0)

    def _aggregate_checks(self) -> list[int]:
        return [i for i, t in enumerate(self.spec.table_checks)
                if isinstance(t.test(self.df), Column)]

    def _counted_elsewhere(self) -> list[tuple[str, DataFrame]]:
        """Rules that need a shuffle: unique keys (VAL8) and row-valued table checks (VAL9)."""
        out = []
        key = self.spec.unique_key
        if key and all(k in self.columns for k in key):
            out.append((
                f"unique({list(key)})",
                duplicate_count(self.df, key).withColumnRenamed("duplicate_rows", "failed_cells"),
            ))
        for t in self.spec.table_checks:
            test = t.test(self.df)
            if isinstance(test, DataFrame):
                out.append((t.name, test.agg(F.count(F.lit(1)).alias("failed_cells"))))
        return out

    # --- failing cells -----------------------------------------------------------------------------

    def failures(
        self, row_id: Column | str | None = None, limit_per_rule: int | None = None,
    ) -> DataFrame:
        """VAL10, VAL11: one row per failing cell, one per row that repeats an earlier unique key, and
        one per finding about the schema.

        ``row_id`` says where the row is (by default its source position). With ``limit_per_rule``
        only the first cells of each rule are kept (TOP4); the limit is applied before the shuffle.
        """
        if row_id is None:
            has_position = ROW_POSITION in self.df.columns
            row_id = ROW_POSITION if has_position else F.lit(None).cast("string")
        order = F.col(row_id) if isinstance(row_id, str) else row_id
        fields = [
            (r.failed, {
                "column_name": sql.literal(r.column), "check_name": sql.literal(r.check_name),
                "error_type": sql.literal(r.error_type),
                "failure_case": f"CAST({sql.name(r.column)} AS STRING)",
            })
            for r in self.rules
        ]
        if not fields:
            fields = [("false", {k: sql.literal(None) for k in
                                 ("column_name", "check_name", "error_type", "failure_case")})]
        cells = ", ".join(f"CASE WHEN {f} THEN {sql.struct(s)} END" for f, s in fields)
        out = (
            # rows without a failure leave before anything is built for them
            computed_once(self.prepared(), [*self._typed, *{r.column for r in self.rules}])
            .filter(self.any_failed())
            .select(order.alias("row_id"), F.expr(f"explode(array({cells})) AS f"))
            .filter("f IS NOT NULL")
            .select("row_id", "f.*")
        )
        key = self.spec.unique_key
        if key and all(k in self.columns for k in key):
            out = out.unionByName(self._repeated_keys(list(key), order))
        if limit_per_rule is not None:
            window = Window.partitionBy("column_name", "check_name").orderBy("row_id")
            out = (
                out.withColumn("_n", F.row_number().over(window))
                .filter(F.col("_n") <= limit_per_rule).drop("_n")
            )
        found = self._static_findings()
        if found:
            static = local_table(
                self.df.sparkSession, found,
                "column_name string, check_name string, error_type string, failure_case string",
            )
            out = out.unionByName(static, allowMissingColumns=True)
        return out.selectExpr(
            f"{sql.literal(self.spec.name)} AS table_name", f"{sql.literal(self.stage)} AS stage",
            "row_id", "column_name", "check_name", "error_type", "failure_case",
            failure_message("column_name", "check_name", "failure_case") + " AS error_message",
        )

    def _repeated_keys(self, key: list[str], row_id: Column) -> DataFrame:
        """VAL8: the rows that repeat a key, all but the first of each. The repeated keys and their
        first rows are pre-aggregated, so a hot key is one row per task; rows then meet them by an
        equi-join, whose large partitions Spark splits."""
        place = F.struct(*default_order(self.df))
        rows = self.df.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key)],
                              place.alias("_place"), row_id.alias("row_id"))
        names = [f"_key_{i}" for i in range(len(key))]
        repeated = rows.groupBy(*[F.col(n).alias(f"{n}_of") for n in names]).agg(
            F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{n}_of")) for n in names])
        shown = F.concat_ws("-", *[F.col(n).cast("string") for n in names])
        return rows.join(repeated, same).filter(F.col("_place") > F.col("_first")).select(
            "row_id", F.lit(None).cast("string").alias("column_name"), F.lit(f"unique({key})").alias("check_name"),
            F.lit(VALUE_ERROR).alias("error_type"), shown.alias("failure_case"))

    # --- verdicts -----------------------------------------------------------------------------------

    def column_status(self, counts: DataFrame | None = None) -> DataFrame:
        """VAL12, VAL13, SET2: one row per column of the spec or the table."""
        counts = self.rule_counts() if counts is None else counts
        by_column = (
            counts.filter("column_name IS NOT NULL AND failed_cells > 0")
            .groupBy("column_name")
            .agg(
                F.expr("sum(failed_cells) AS cells"),
                F.expr("min_by(struct(error_type, check_name, example), rule_number) AS first"),
                # at most one entry per rule of the column
                F.expr("array_sort(collect_list(struct(rule_number, check_name, failed_cells, "
                       "example))) AS details"),
            )
        )
        known = local_table(
            self.df.sparkSession,
            [(c, "missing" if c in self.missing else "extra" if c in self.extra else "there")
             for c in [*self.spec.names, *self.extra]],
            "column_name string, presence string",
        )

        def verdict(missing: str, extra: str, failed: str, valid: str, alias: str) -> str:
            return (f"CASE presence WHEN 'missing' THEN {missing} WHEN 'extra' THEN {extra} "
                    f"ELSE CASE WHEN cells > 0 THEN {failed} ELSE {valid} END END AS {alias}")

        none = sql.literal(None)
        return known.join(by_column, "column_name", "left").selectExpr(
            f"{sql.literal(self.spec.name)} AS table_name", "column_name",
            verdict("false", "false", "false", "true", "is_valid"),
            verdict("1L", "1L", "cells", "0L", "error_count"),
            verdict(f"'{MISSING_COLUMN}'", f"'{EXTRA_COLUMN}'", "first.error_type", none,
                    "error_type"),
            verdict("concat('Column \\'', column_name, '\\' not found in dataframe')",
                    "concat('Unexpected column \\'', column_name, '\\' found in dataframe')",
                    failure_message("column_name", "first.check_name", "first.example"), none,
                    "error_message"),
            verdict("'ColumnExists'", "'ColumnExists'", "first.check_name", none, "check_name"),
            verdict("'COLUMN_MISSING'", "'EXTRA_COLUMN'", "'VALIDATION_FAILED'", "'SUCCESS'",
                    "error_code"),
            "details",
        )

    def score(self, stats: DataFrame | None = None) -> DataFrame:
        """VAL18: rows, valid rows, invalid rows and the share of valid ones, measured."""
        stats = self.stats() if stats is None else stats
        valid = "total_rows - invalid_rows"
        return stats.selectExpr(
            f"{sql.literal(self.spec.name)} AS table_name", f"{sql.literal(self.stage)} AS stage",
            "total_rows", f"{valid} AS valid_rows", "invalid_rows",
            f"coalesce(try_divide({valid}, total_rows) * 100, CAST(100 AS DOUBLE)) "
            "AS data_quality_score",
        )

    def raise_if_failed(self, counts: DataFrame | None = None) -> None:
        """VAL16: action; stops the run when any rule fails."""
        counts = self.rule_counts() if counts is None else counts
        # at most one row per rule of the spec
        broken = counts.filter("failed_cells > 0").orderBy("rule_number").collect()
        if broken:
            shown = "; ".join(
                f"{r['column_name'] or self.spec.name}: {r['check_name']} ({r['failed_cells']})"
                for r in broken
            )
            raise ValidationFailed(f"{self.spec.name} ({self.stage}): {shown}")


def validate(df: DataFrame, spec: TableSpec, stage: str = "validation") -> Validation:
    return Validation(df, spec, stage)


def first_errors(
    failures: DataFrame, n: int = 10, by: Sequence[str] = ("table_name", "stage"),
) -> DataFrame:
    """TOP4: the first ``n`` failing cells per group; the limit is applied before the shuffle."""
    window = Window.partitionBy(*by).orderBy("row_id", "column_name", "check_name")
    return (
        failures.withColumn("error_rank", F.row_number().over(window))
        .filter(F.col("error_rank") <= n)
    )
