"""Reports over validation events (RPT1-RPT18, AGG12-AGG16, TOP1-TOP2, SRT2, WIN1, SNK7-SNK8).

Events are rows (see ``EVENT_SCHEMA``): an *error* event for every rule of a table and stage that
failed, a *success* event for a stage without errors, and a *table* event with the measured result
of every validation. All reports are projections and small aggregations over them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .. import sqltext as sql
from ..functions import (
    band, executive_status, first_match, severity, severity_priority, success_rate,
)
from .documents import documents
from .validate import Validation, failure_message

EVENT_SCHEMA = (
    "run_id string, event_ts timestamp, kind string, table_name string, stage string, "
    "rule_number int, column_name string, check_name string, error_type string, "
    "error_message string, actual_value string, failed_cells bigint, total_rows bigint, "
    "valid_rows bigint, invalid_rows bigint, data_quality_score double, is_valid boolean"
)
AFTER_CLEANING = "after_cleaning"
_ERROR, _SUCCESS, _TABLE = ("error", "success", "table")


# --- events ---------------------------------------------------------------------------------------

def validation_events(
    validation: Validation, run_id: str, stats: DataFrame | None = None,
    event_ts: Column | None = None,
) -> DataFrame:
    """RPT1: the events of one validated table, at most one per rule plus two, all read off the
    one row of counts."""
    stats = validation.stats() if stats is None else stats
    schema = [part.split() for part in EVENT_SCHEMA.split(",")]
    table = sql.literal(validation.spec.name)
    entries = validation.entries()
    cells = " + ".join(f"CAST({e[3]} AS BIGINT)" for e in entries) or "0"
    broken = " + ".join(f"int({e[3]} > 0)" for e in entries) or "0"

    def event(condition: str, kind: str, **fields: str) -> str:
        given = {"run_id": sql.literal(run_id), "event_ts": "_ts", "kind": sql.literal(kind),
                 "table_name": table, "stage": sql.literal(validation.stage), **fields}
        row = sql.struct({n: f"CAST({given.get(n, 'NULL')} AS {t})" for n, t in schema})
        return f"CASE WHEN {condition} THEN {row} END"

    events = []
    for n, (column, check, error_type, failed, example) in enumerate(entries, 1):
        message = failure_message(
            sql.literal(column or validation.spec.name), sql.literal(check),
            f"concat({failed}, ' cases, e.g. ', coalesce({example}, 'null'))",
        )
        events.append(event(
            f"{failed} > 0", _ERROR, rule_number=str(n), column_name=sql.literal(column),
            check_name=sql.literal(check), error_type=sql.literal(error_type),
            error_message=message, actual_value=example, failed_cells=failed,
        ))
    result = {
        "failed_cells": cells, "total_rows": "total_rows", "invalid_rows": "invalid_rows",
        "valid_rows": "total_rows - invalid_rows", "is_valid": f"({broken}) = 0",
        "data_quality_score":
            "coalesce(try_divide(total_rows - invalid_rows, total_rows) * 100, 100)",
    }
    events.append(event("true", _TABLE, **result))
    # a stage without errors also counts as a success
    events.append(event(f"({broken}) = 0", _SUCCESS, **result))
    ts = (F.current_timestamp() if event_ts is None else event_ts).cast("timestamp")
    return (
        stats.withColumn("_ts", ts)
        .select(F.expr(f"explode(array({', '.join(events)})) AS e"))
        .filter("e IS NOT NULL").select("e.*")
    )


def error_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("kind") == _ERROR)


def outcomes(events: DataFrame) -> DataFrame:
    """Errors and successes, the events every rate is computed from."""
    return events.filter(F.col("kind").isin(_ERROR, _SUCCESS))


def _or_unknown(column: str) -> Column:
    return F.coalesce(column, F.lit("Unknown"))


# --- counting ----------------------------------------------------------------------------------------

def errors_by(events: DataFrame, column: str, name: str = "error_count") -> DataFrame:
    """AGG12, AGG13: error events per value of a column."""
    return (
        error_events(events).groupBy(_or_unknown(column).alias(column))
        .agg(F.count(F.lit(1)).alias(name))
    )


def top_errors(events: DataFrame, column: str, n: int = 5) -> DataFrame:
    """TOP1, TOP2: the values with most error events; ties by name."""
    return errors_by(events, column).orderBy(F.desc("error_count"), F.asc(column)).limit(n)


def success_summary(events: DataFrame) -> DataFrame:
    """AGG16: successes per table and stage."""
    return (
        events.filter(F.col("kind") == _SUCCESS).groupBy("table_name", "stage")
        .agg(F.count(F.lit(1)).alias("success_count"))
    )


def _totals(events: DataFrame) -> DataFrame:
    is_error, is_success = F.col("kind") == _ERROR, F.col("kind") == _SUCCESS
    of_outcomes = F.try_divide(F.count_if(is_success), F.count_if(is_error | is_success)) * 100
    return events.agg(
        F.count_if(F.col("kind") == _TABLE).alias("total_tables"),
        F.count_if(is_error).alias("total_errors"),
        F.count_if(is_success).alias("total_successes"),
        F.coalesce(of_outcomes, F.lit(0.0)).alias("success_rate"),
        F.min("event_ts").alias("start_time"), F.max("event_ts").alias("end_time"),
    )


def run_summary(events: DataFrame) -> DataFrame:
    """RPT2: tables, errors, successes, success rate and duration of a run."""
    return _totals(events).withColumn(
        "duration_seconds", F.unix_micros("end_time") / 1e6 - F.unix_micros("start_time") / 1e6
    )


def quick_overview(events: DataFrame) -> DataFrame:
    """RPT9: errors, successes, rate, status and band in one row."""
    rate = F.col("success_rate")
    return _totals(events).select(
        "total_errors", "total_successes",
        F.bround(rate, 1).alias("success_rate_percentage"),
        F.when(F.col("total_errors") == 0, F.lit("PASSED")).otherwise(F.lit("FAILED"))
        .alias("overall_status"),
        band(rate).alias("data_quality_status"),
    )


def executive_summary(events: DataFrame) -> DataFrame:
    """RPT15, RPT16: the stricter scale, with the key finding."""
    rate, errors, ok = F.col("success_rate"), F.col("total_errors"), F.col("total_successes")
    finding = (
        F.when(errors == 0, F.lit("All tables passed validation successfully"))
        .when(ok == 0, F.lit("All tables failed validation - immediate attention required"))
        .otherwise(F.format_string("Mixed validation results: %d successes, %d errors", ok, errors))
    )
    return _totals(events).select(
        executive_status(rate).alias("overall_status"), "total_tables", "total_errors",
        "total_successes", F.bround(rate, 1).alias("success_rate_percentage"),
        band(rate, fixed.EXECUTIVE_BANDS).alias("data_quality_status"),
        finding.alias("key_finding"),
    )


def rate_by(events: DataFrame, *by: str) -> DataFrame:
    """AGG15, RPT9, RPT15: success rate with both band scales per group."""
    return (
        outcomes(events).groupBy(*by)
        .agg(F.count(F.lit(1)).alias("validations"),
             success_rate(F.col("kind") == _SUCCESS).alias("_rate"))
        .select(
            *by, "validations", F.bround("_rate", 1).alias("success_rate_percentage"),
            band(F.col("_rate")).alias("overview_band"),
            band(F.col("_rate"), fixed.EXECUTIVE_BANDS).alias("executive_band"),
            executive_status(F.col("_rate")).alias("executive_status"),
        )
    )


# --- errors one by one --------------------------------------------------------------------------------

def numbered(df: DataFrame, order_by: Sequence[Column | str], prefix: str, name: str) -> DataFrame:
    """WIN1: sequential ids ``PREFIX_0001``. The window is global, so this is only for event
    tables: they hold one row per rule, table and stage, however large the data."""
    number = F.row_number().over(Window.orderBy(*order_by))
    return df.withColumn(name, F.format_string(f"{prefix}_%04d", number))


_EVENT_ORDER = ("event_ts", "table_name", "stage", "rule_number", "column_name", "check_name")


def detailed_errors(events: DataFrame, spec_columns: DataFrame | None = None) -> DataFrame:
    """RPT4, VAL19: numbered errors; ``spec_columns`` (see ``spec_frame``) adds what was expected."""
    out = numbered(error_events(events), _EVENT_ORDER, "ERR", "error_id").select(
        "error_id", "event_ts", _or_unknown("table_name").alias("table_name"),
        _or_unknown("column_name").alias("column_name"), "stage",
        _or_unknown("error_type").alias("error_type"),
        F.coalesce("error_message", F.lit(fixed.NO_MESSAGE_PROVIDED)).alias("error_message"),
        "actual_value", "check_name", "failed_cells",
        F.lit(fixed.DEFAULT_FIX).alias("recommended_fix"),
    )
    if spec_columns is None:
        return out
    expected = spec_columns.select(
        "table_name", "column_name", F.col("data_type").alias("expected_type"),
        F.col("nullable").alias("expected_nullable"), F.col("checks").alias("expected_checks"),
    )
    return out.join(expected, ["table_name", "column_name"], "left")


def data_quality_issues(events: DataFrame) -> DataFrame:
    """RPT6, FLT11: numbered value errors."""
    issues = error_events(events).filter(F.col("error_type").isin(*fixed.DATA_QUALITY_TYPES))
    return numbered(issues, _EVENT_ORDER, "DQ", "issue_id").select(
        "issue_id", _or_unknown("table_name").alias("table_name"),
        _or_unknown("column_name").alias("column_name"), F.col("error_type").alias("issue_type"),
        F.lit(fixed.ISSUE_SEVERITY).alias("severity"),
        F.coalesce("error_message", F.lit(fixed.NO_DESCRIPTION)).alias("description"),
        F.coalesce("failed_cells", F.lit(0)).alias("affected_rows"),
        F.col("actual_value").alias("data_sample"),
        F.lit(fixed.DEFAULT_FIX).alias("recommended_action"),
    )


def error_details(events: DataFrame) -> DataFrame:
    """RPT8: errors with severity, priority and what to do."""
    kind = F.coalesce("error_type", F.lit(""))
    return error_events(events).select(
        _or_unknown("table_name").alias("table_name"),
        _or_unknown("column_name").alias("column_name"), "stage", "check_name",
        _or_unknown("error_type").alias("error_type"),
        F.coalesce("error_message", F.lit(fixed.NO_MESSAGE)).alias("error_message"),
        F.coalesce("actual_value", F.lit(fixed.NO_VALUE)).alias("failed_value"), "failed_cells",
        severity(kind).alias("severity"),
        severity_priority(severity(kind)).alias("fix_priority"),
        first_match(kind, fixed.ERROR_ACTIONS, fixed.DEFAULT_ACTION).alias("recommended_action"),
    )


def recommendations(events: DataFrame) -> DataFrame:
    """RPT14, AGG14, SRT2: per error type, most urgent first. The tables of a type are a set of
    table names, so they stay few."""
    kind, count = F.col("error_type"), F.col("error_count")
    effort = first_match(kind, fixed.TYPE_EFFORTS, fixed.DEFAULT_TYPE_EFFORT)
    return (
        error_events(events).groupBy(_or_unknown("error_type").alias("error_type"))
        .agg(F.count(F.lit(1)).alias("error_count"),
             F.sort_array(F.collect_set(_or_unknown("table_name"))).alias("affected_tables"))
        .select(
            "error_type", "error_count", "affected_tables",
            first_match(kind, fixed.TYPE_PRIORITIES, fixed.DEFAULT_TYPE_PRIORITY)
            .alias("priority"),
            first_match(kind, fixed.TYPE_FIXES, fixed.DEFAULT_TYPE_FIX).alias("recommended_fix"),
            F.replace(effort, F.lit("%d"), count.cast("string")).alias("estimated_effort"),
        )
        .orderBy(F.desc("priority"), "error_type")
    )


def coarse_recommendations(events: DataFrame) -> DataFrame:
    """RPT16: one fixed recommendation for each trigger type that occurs."""
    errors = error_events(events)
    seen = errors.agg(*[
        F.count_if(F.col("error_type") == trigger).alias(f"n_{i}")
        for i, (trigger, *_) in enumerate(fixed.COARSE_RECOMMENDATIONS)
    ])
    rows = [
        F.struct(
            (F.col(f"n_{i}") > 0).alias("_seen"), F.lit(priority).alias("priority"),
            F.lit(category).alias("category"), F.lit(text).alias("recommendation"),
            F.lit(impact).alias("impact"),
        )
        for i, (_, priority, category, text, impact) in enumerate(fixed.COARSE_RECOMMENDATIONS)
    ]
    return (
        seen.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        .filter("_seen").drop("_seen")
    )


def next_steps(events: DataFrame) -> DataFrame:
    """RPT16: what to do next, in order."""
    steps = [
        F.struct(F.lit(i).alias("step_number"), F.lit(text).alias("next_step"), needed.alias("_on"))
        for i, (text, needed) in enumerate(
            [(t, F.col("total_errors") > 0) for t in fixed.STEPS_AFTER_ERRORS]
            + [(t, F.col("total_successes") > 0) for t in fixed.STEPS_AFTER_SUCCESSES], 1)
    ]
    return (
        _totals(events).select(F.explode(F.array(*steps)).alias("s")).select("s.*")
        .filter("_on").drop("_on")
    )


def critical_issues(events: DataFrame) -> DataFrame:
    """RPT18: errors titled by what their message says; ``error`` is the head of the message that the
    report shows, ``error_message`` all of it."""
    message = F.coalesce("error_message", F.lit("No message"))
    kind, table = _or_unknown("error_type"), _or_unknown("table_name")
    title = None
    for words, name in fixed.ISSUE_TITLES:
        hit = F.lit(True)
        for w in words:
            hit = hit & message.contains(w)
        title = (F if title is None else title).when(hit, F.lit(name))
    other = F.concat(F.upper(kind), F.lit(" IN "), F.upper(table))
    short = F.concat(
        F.substring(message, 1, 100), F.when(F.length(message) > 100, "...").otherwise("")
    )
    return error_events(events).select(
        "table_name", "column_name", "stage", "check_name", title.otherwise(other).alias("issue"),
        short.alias("error"), message.alias("error_message"),
        F.concat(F.lit("Affects "), table, F.lit("."), _or_unknown("column_name")).alias("impact"),
    )


# --- tables -------------------------------------------------------------------------------------------

def table_analysis(events: DataFrame) -> DataFrame:
    """RPT7: PASSED / FAILED with row counts and score, per table and stage."""
    return events.filter(F.col("kind") == _TABLE).select(
        "table_name", "stage", "event_ts",
        F.when(F.coalesce("is_valid", F.lit(True)), F.lit("PASSED")).otherwise(F.lit("FAILED"))
        .alias("validation_status"),
        F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
        F.coalesce("valid_rows", F.lit(0)).alias("valid_rows"),
        F.coalesce("invalid_rows", F.lit(0)).alias("invalid_rows"),
        F.coalesce("data_quality_score", F.lit(0.0)).alias("data_quality_score"),
    )


def schema_violations(events: DataFrame) -> DataFrame:
    """RPT5: failed tables with the columns that failed, by kind of violation."""
    errors = error_events(events).groupBy("table_name", "stage").agg(
        F.count(F.lit(1)).alias("violation_count"),
        *[
            F.sort_array(F.collect_set(F.when(F.col("error_type") == kind, F.col("column_name"))))
            .alias(name)
            for kind, name in (
                ("MissingColumn", "missing_columns"), ("ExtraColumn", "extra_columns"),
                ("TypeMismatch", "data_type_violations"),
                ("ValidationError", "constraint_violations"),
            )
        ],
    )
    failed = events.filter((F.col("kind") == _TABLE) & ~F.coalesce("is_valid", F.lit(True)))
    return failed.select("table_name", "stage", "event_ts").join(
        errors, ["table_name", "stage"], "left"
    )


def quality_highlights(events: DataFrame) -> DataFrame:
    """RPT16, FLT11: tables with an excellent score."""
    return (
        events.filter((F.col("kind") == _SUCCESS)
                      & (F.col("data_quality_score") >= fixed.HIGHLIGHT_SCORE))
        .select("table_name", "stage", F.concat(
            F.lit("Excellent data quality in "), _or_unknown("table_name"), F.lit(" table")
        ).alias("highlight"))
    )


# --- the report log -----------------------------------------------------------------------------------

def latest_reports(
    reports: DataFrame, by: str = "report_type", ts: str = "generated_at",
    keep: int = fixed.REPORTS_KEPT_PER_TYPE, tie: Sequence[str] = (),
) -> DataFrame:
    """SNK7, LIM1: the newest ``keep`` reports per type; each task passes on at most ``keep``."""
    window = Window.partitionBy(by).orderBy(F.desc(ts), *[F.desc(t) for t in tie])
    return (
        reports.withColumn("report_rank", F.row_number().over(window))
        .filter(F.col("report_rank") <= keep)
    )


def report_stats(reports: DataFrame, by: str = "report_type") -> DataFrame:
    """SNK8: reports per type."""
    return reports.groupBy(by).agg(F.count(F.lit(1)).alias("report_count"))


# --- documents ------------------------------------------------------------------------------------------

def run_documents(events: DataFrame, run_id: str) -> DataFrame:
    """RPT2-RPT10 as two nested documents of a run: the technical one and the summary."""
    def of_run(df: DataFrame) -> DataFrame:
        return df.withColumn("run_id", F.lit(run_id))

    technical = {
        "run_info": run_summary(events), "detailed_errors": detailed_errors(events),
        "schema_violations": schema_violations(events), "data_quality_issues": data_quality_issues(events),
        "table_analysis": table_analysis(events),
    }
    summary = {
        "quick_overview": quick_overview(events), "error_details": error_details(events),
        "error_by_type": errors_by(events, "error_type"), "error_by_table": errors_by(events, "table_name"),
        "actionable_recommendations": recommendations(events),
    }
    return documents("technical_report", {k: of_run(v) for k, v in technical.items()}, ["run_info"]).unionByName(
        documents("summary_report", {k: of_run(v) for k, v in summary.items()}, ["quick_overview"]))


# --- everything -----------------------------------------------------------------------------------------

def build_reports(
    events: DataFrame, spec_columns: DataFrame | None = None,
    metrics: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """RPT3, RPT10, RPT21: every report of a run. Status and rates come from the stage after
    cleaning; the listings show all stages."""
    final = events.filter(F.col("stage") == AFTER_CLEANING)
    return {
        "run_summary": run_summary(events),
        "quick_overview": quick_overview(final),
        "executive_summary": executive_summary(final),
        "table_analysis": table_analysis(events),
        "schema_violations": schema_violations(events),
        "detailed_errors": detailed_errors(events, spec_columns),
        "data_quality_issues": data_quality_issues(events),
        "error_details": error_details(events),
        "error_by_type": errors_by(events, "error_type"),
        "error_by_table": errors_by(events, "table_name"),
        "top_error_types": top_errors(events, "error_type"),
        "top_error_tables": top_errors(events, "table_name"),
        "success_summary": success_summary(events),
        "quality_highlights": quality_highlights(final),
        "recommendations": recommendations(events),
        "coarse_recommendations": coarse_recommendations(events),
        "critical_issues": critical_issues(events),
        "next_steps": next_steps(final),
        **(metrics or {}),
    }
