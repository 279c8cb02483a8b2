"""The whole run: extract, gate, clean, merge, validate, summarise, save, report.

Every table is scanned once and staged as Parquet (see :class:`Staging`); each later stage reads
the staged columns it needs. Row, null and rule counts are observed by the write that makes a table,
so no table is read again to be counted; only unique keys need a shuffle of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..config import default_config
from ..errors import AssayError, ExtractionError, GateFailed, PlanError
from ..local import local_table, measured
from ..operators.gate import gate_passed, key_gate, null_ratio_gate
from ..operators.merge import merge_tables, orphan_counts
from ..operators.metrics import STEP_SCHEMA, counted_metrics, mapping_effects, step_metrics
from ..operators.profile import null_counts
from ..operators.reports import AFTER_CLEANING, build_reports, run_documents, validation_events
from ..operators.skew import hot_keys
from ..operators.summary import summarise
from ..operators.validate import Validation, validate
from ..sources import (
    RunLog, Staging, extract_projects, extract_results, extract_subjects, spread, write_parquet, write_recipes,
    write_summary_csv,
)
from ..specs import MERGED, PROJECTS, RESULTS, SUBJECTS, SUMMARY, TableSpec, spec_frame
from .recipe import apply_recipe, generate_recipe, recipe_frame, rename_columns

INPUTS = (PROJECTS, SUBJECTS, RESULTS)
BEFORE_CLEANING = "before_cleaning"

Source = Callable[[SparkSession, str], DataFrame]


@dataclass
class RunResult:
    """What a run produced. ``tables`` holds projects, subjects, results, merged and summary."""

    run_id: str
    succeeded: bool = False
    error: AssayError | None = None
    tables: dict[str, DataFrame] = field(default_factory=dict)
    gate: DataFrame | None = None
    events: DataFrame | None = None
    reports: dict[str, DataFrame] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)

    def data_summary(self) -> dict[str, int]:
        """AGG10: rows per table as observed when it was written, 0 for a table the run did not reach."""
        names = ("projects", "subjects", "results", "merged", "summary")
        return {n: self.rows.get(n, 0) for n in names}


class Pipeline:
    """One configured run over three sources.

    ``config['files']`` names the inputs (``projects_file``, ``subjects_file``, ``results_file``)
    and outputs (``output_parquet``, ``summary_csv``, optional ``reports`` and ``recipes``
    folders). ``sources`` replaces a scan by any callable ``(spark, path) -> DataFrame``.
    """

    def __init__(
        self, spark: SparkSession, config: Mapping[str, Any] | None = None,
        sources: Mapping[str, Source] | None = None, null_in_enum: str = "drop",
    ):
        self.spark = spark
        self.config = dict(default_config() if config is None else config)
        self.sources: dict[str, Source] = {
            "projects": extract_projects, "subjects": extract_subjects,
            "results": extract_results, **(sources or {}),
        }
        self.recipes = {
            s.name: generate_recipe(s, self.config, null_in_enum) for s in INPUTS
        }

    def run(self, write: bool = True, strict: bool = False) -> RunResult:
        """Run all stages. A run that is stopped says why in ``error`` (or raises if ``strict``);
        ``write=False`` skips every output but the staged tables."""
        staging = Staging(self.spark)
        result = RunResult(staging.run_id)
        try:
            self._run(result, staging, write)
            result.succeeded = True
        except AssayError as e:
            result.error = e
            if strict:
                raise
        return result

    # --- stages -------------------------------------------------------------------------------------

    def _run(self, result: RunResult, staging: Staging, write: bool) -> None:
        # the write of a raw table measures the gate and the validation before cleaning
        raw, before, stats = {}, {}, {}
        for s in INPUTS:
            raw[s.name], before[s.name], stats[s.name] = self._extract(s, staging)
        result.gate = self._gate({n: v.df for n, v in before.items()}, stats)
        if not gate_passed(result.gate):
            raise GateFailed("Data quality check failed - too much corrupted data")

        after, stats_after = {}, {}
        for s in INPUTS:
            tidy = apply_recipe(raw[s.name], self.recipes[s.name])
            self._put_checked(result, staging, tidy, s, f"clean_{s.name}", after, stats_after)
        cleaned = {s.name: result.tables[s.name] for s in INPUTS}

        subjects = cleaned["subjects"]
        project_keys = [k for k in fixed.PROJECT_KEYS
                        if k in subjects.columns and k in cleaned["projects"].columns]
        hot = hot_keys(subjects, ["sample_id"], *([project_keys] if project_keys else []))
        joined = merge_tables(cleaned["projects"], subjects, cleaned["results"],
                              hot_samples=hot[0], hot_projects=hot[1] if project_keys else ())
        merged = self._put_checked(result, staging, joined, MERGED, "merged", after, stats_after)
        after["merged"].raise_if_failed(after["merged"].rule_counts(stats_after["merged"]))

        keys = (self.config.get("summary") or {}).get("groupby_columns") or fixed.PROJECT_KEYS
        summary = self._put_checked(
            result, staging, summarise(merged, keys, ordered=False), SUMMARY, "summary", after, stats_after)

        files = self.config.get("files") or {}
        if write:
            write_parquet(merged, self._path("output_parquet"))
            write_summary_csv(summary, self._path("summary_csv"), keys)

        result.events = self._events(result.run_id, before, stats, after, stats_after)
        result.reports = build_reports(
            result.events, spec_frame(self.spark),
            self._metrics(raw, cleaned, stats, stats_after),
        )
        if write and files.get("reports"):
            log = RunLog(self.spark, files["reports"])
            log.append(result.run_id, result.events, result.reports, run_documents(result.events, result.run_id))
            log.retain(int((self.config.get("reports") or {}).get("kept_per_type", fixed.REPORTS_KEPT_PER_TYPE)))
        if write and files.get("recipes"):
            write_recipes(recipe_frame(self.spark, *self.recipes.values()), files["recipes"])

    def _path(self, key: str) -> str:
        path = (self.config.get("files") or {}).get(key)
        if not path:
            raise PlanError(f"files.{key} is not configured")
        return path

    def _extract(self, spec: TableSpec, staging: Staging) -> tuple[DataFrame, Validation, DataFrame]:
        """The staged raw table, its validation under the names of the spec, and the counts of both
        the validation and the gate."""
        name = spec.name
        mapping = self.recipes[name].step("column_mapping").parameters["column_mappings"]
        df = self.sources[name](self.spark, self._path(f"{name}_file"))
        try:
            view = rename_columns(spread(df), mapping)
            check = validate(view, spec, BEFORE_CLEANING)
            counts = [*check.aggregates(), *null_counts(view), F.count(F.lit(1)).alias("row_count")]
            raw, stats = staging.put_observed(
                check.prepared(), f"raw_{name}", counts, dict(zip(df.columns, view.columns)))
        except AssayError:
            raise
        except Exception as e:  # a malformed record surfaces when the scan runs
            raise ExtractionError(f"Failed to extract {name}: {str(e).splitlines()[0]}") from e
        staged_check = validate(rename_columns(raw, mapping), spec, BEFORE_CLEANING)
        return raw, staged_check, measured(staged_check.completed(stats))

    def _put_checked(
        self, result: RunResult, staging: Staging, df: DataFrame, spec: TableSpec, name: str,
        after: dict[str, Validation], stats: dict[str, DataFrame],
    ) -> DataFrame:
        """Stage a table of the run; its validation is measured by the write."""
        check = validate(df, spec, AFTER_CLEANING)
        table, counts = staging.put_observed(check.prepared(), name, check.aggregates(), df.columns)
        after[spec.name] = validate(table, spec, AFTER_CLEANING)
        stats[spec.name] = measured(after[spec.name].completed(counts))
        result.tables[spec.name] = table
        result.rows[spec.name] = counts.first()["total_rows"]
        return table

    def _gate(self, tables: Mapping[str, DataFrame], stats: Mapping[str, DataFrame]) -> DataFrame:
        return (
            key_gate(tables["projects"], "projects", fixed.PROJECT_KEYS, stats["projects"])
            .unionByName(null_ratio_gate(tables["subjects"], "subjects", stats=stats["subjects"]))
            .unionByName(null_ratio_gate(tables["results"], "results", stats=stats["results"]))
        )

    def _events(self, run_id, before, stats, after, stats_after) -> DataFrame:
        parts = [validation_events(v, run_id, stats[n]) for n, v in before.items()]
        parts += [validation_events(v, run_id, stats_after[n]) for n, v in after.items()]
        # at most one per rule, plus two per validation
        return measured(reduce(lambda a, b: a.unionByName(b), parts))

    def _metrics(self, raw, cleaned, stats, stats_after) -> dict[str, DataFrame]:
        rows_in = {n: s.first()["total_rows"] for n, s in stats.items()}
        rows_out = {n: s.first()["total_rows"] for n, s in stats_after.items()}
        steps = []
        for name, recipe in self.recipes.items():
            measured = step_metrics(raw[name], recipe, deduplicate=False).collect()
            steps += [tuple(r) for r in measured]
            dedup = recipe.step("duplicate_removal")
            if dedup:
                # what the constraints left and the cleaned table lacks was a duplicate
                left = rows_in[name] - sum(r["rows_removed"] for r in measured)
                steps.append((name, dedup.number, dedup.name, None, None, left, 0,
                              left - rows_out[name]))
        return {
            "table_metrics": counted_metrics(self.spark, rows_in, rows_out),
            "step_metrics": local_table(self.spark, steps, STEP_SCHEMA),
            "value_mappings": mapping_effects(raw["results"], self.recipes["results"]),
            "orphans": orphan_counts(cleaned["projects"], cleaned["subjects"], cleaned["results"]),
        }
