"""Registered queries: every operator over whole tables of a star schema.

Each takes the session and the folder of the Parquet tables and gives a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import specs
from ..config import default_config
from ..errors import ExtractionError
from ..functions import (
    composite_code, convert, is_finished, map_values, severity, standardize, to_timestamp,
)
from ..functions.registry import register_functions
from ..functions.scores import first_match, severity_priority
from ..local import measured
from ..operators import bitmaps, copartition, dedup, documents, gate, merge, metrics, profile, profile_state, reports
from ..operators.constraints import Constraint, apply_constraints, drop_counts
from ..operators.matching import with_schema_names
from ..operators.skew import hot_keys
from ..operators.summary import summarise
from ..operators.validate import first_errors, validate
from ..sources import (
    RunLog, Staging, extract_projects, extract_results, extract_subjects, scan_csv, scan_csv_split, scan_parquet, spread, stored_null_counts,
    write_parquet, write_recipes, write_report, write_summary_csv,
)
from .. import fixed_values as fixed
from ..sources.arrow_folder import FORMAT, register_sources
from ..specs import MERGED, PROJECTS, RESULTS, SUBJECTS, SUMMARY, Check, ColumnSpec, TableCheck, TableSpec
from . import shapes
from .recipe import apply_recipe, clean, generate_recipe, recipe_frame, rename_columns
from .shapes import raw_projects, raw_results, raw_subjects, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _count(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))


# --- cleaned tables ----------------------------------------------------------------------------------

def _clean_results(spark, folder, null_in_enum="drop") -> DataFrame:
    return clean(raw_results(spark, folder), RESULTS, default_config(), null_in_enum=null_in_enum)


def _clean_subjects(spark, folder) -> DataFrame:
    return clean(raw_subjects(spark, folder), SUBJECTS, default_config())


def _clean_projects(spark, folder) -> DataFrame:
    return clean(raw_projects(spark, folder), PROJECTS, default_config())


def _hot(spark, folder, *key_sets) -> list[list[int]]:
    """Hot keys of the subjects, told from the standardised keys without the duplicate removal."""
    recipe = generate_recipe(SUBJECTS, default_config()).without("duplicate_removal")
    return hot_keys(apply_recipe(raw_subjects(spark, folder), recipe), *key_sets)


def _joined(projects: DataFrame, subjects: DataFrame, results: DataFrame) -> DataFrame:
    """The merged table; ``subjects`` is staged, as its hot keys are looked for first."""
    hot_samples, hot_projects = hot_keys(subjects, ["sample_id"], fixed.PROJECT_KEYS)
    return merge.merge_tables(
        projects, subjects, results, hot_samples=hot_samples, hot_projects=hot_projects)


def _merged(spark, folder) -> DataFrame:
    subjects = Staging(spark).put(_clean_subjects(spark, folder), "clean_subjects")
    return _joined(_clean_projects(spark, folder), subjects, _clean_results(spark, folder))


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date_of_run", F.col("date_of_run").cast("date").cast("string"))


@query
def clean_results(spark, folder):
    return _dates_as_text(_clean_results(spark, folder))


@query
def clean_results_null_kept(spark, folder):
    return _dates_as_text(_clean_results(spark, folder, "keep"))


@query
def clean_subjects(spark, folder):
    return _clean_subjects(spark, folder)


@query
def clean_projects(spark, folder):
    return _clean_projects(spark, folder)


@query
def merge_full(spark, folder):
    return _dates_as_text(_merged(spark, folder))


@query
def cohort_summary(spark, folder):
    return summarise(_merged(spark, folder))


# --- column functions -----------------------------------------------------------------------------------

@query
def column_mapping(spark, folder):
    """PRJ1: rename what is there, ignore what is not."""
    df = table(spark, folder, "supplier")
    return rename_columns(df, {"s_name": "supplier_name", "s_acctbal": "balance", "absent": "x"})


@query
def value_mapping(spark, folder):
    """PRJ4."""
    df = table(spark, folder, "lineitem").select(
        map_values("l_returnflag", {"r": "Yes", "a": "No", "n": None}).alias("mapped"))
    return _count(df, "mapped")


@query
def value_mapping_chain(spark, folder):
    """PRJ4: an entry picks up what an earlier one produced."""
    df = table(spark, folder, "orders").select("o_orderstatus", map_values(
        "o_orderstatus", {"f": "Done", "done": "Closed", "o": "Open", "P": "f"}).alias("mapped"))
    return _count(df, "o_orderstatus", "mapped")


@query
def string_standardize(spark, folder):
    """PRJ5-PRJ7 over whole documents."""
    text = standardize(F.col("text"))
    return spread(table(spark, folder, "documents")).select(
        "doc_id", F.md5(text).alias("text_md5"), F.length(text).cast("bigint").alias("text_length"))


@query
def missing_fill(spark, folder):
    """PRJ8."""
    spec = TableSpec("orders", (ColumnSpec("priority"),))
    df = table(spark, folder, "orders").select(
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"))
    return _count(clean(df, spec), "priority")


@query
def type_convert(spark, folder):
    """PRJ9, PRJ10, PRJ12."""
    text = F.expr(
        "CASE l_linenumber WHEN 1 THEN cast(cast(l_quantity AS bigint) AS string) || '.0' "
        "WHEN 2 THEN '1,000' WHEN 3 THEN '0.5d' WHEN 4 THEN ' 12 ' WHEN 5 THEN '1e3' "
        "WHEN 6 THEN 'abc' ELSE cast(l_partkey AS string) || '.5' END")
    df = table(spark, folder, "lineitem").select(text.alias("source_text"))
    df = df.select(
        "source_text", convert(F.col("source_text"), "double").alias("as_double"),
        convert(F.col("source_text"), "long").alias("as_long"))
    return _count(df, "source_text", "as_double", "as_long")


@query
def date_parse(spark, folder):
    """PRJ11: each value in its own format."""
    text = F.expr(
        "CASE o_orderkey % 4 "
        "WHEN 0 THEN lpad(cast(day(o_orderdate) AS string), 2, '0') || '/' || "
        "lpad(cast(month(o_orderdate) AS string), 2, '0') || '/' || cast(year(o_orderdate) AS string) "
        "WHEN 1 THEN cast(year(o_orderdate) AS string) || '-' || "
        "lpad(cast(month(o_orderdate) AS string), 2, '0') || '-' || "
        "lpad(cast(day(o_orderdate) AS string), 2, '0') "
        "WHEN 2 THEN cast(day(o_orderdate) AS string) || '.' || cast(month(o_orderdate) AS string) "
        "|| '.' || cast(year(o_orderdate) AS string) "
        "ELSE '31/02/' || cast(year(o_orderdate) AS string) END")
    return table(spark, folder, "orders").select(
        "o_orderkey", to_timestamp(text).cast("date").cast("string").alias("parsed"))


@query
def date_shapes(spark, folder):
    """PRJ11: short years, month names, eight digits, the twelve-hour clock."""
    text = F.expr(
        "CASE o_orderkey % 5 WHEN 0 THEN date_format(o_orderdate, 'd/M/yy') "
        "WHEN 1 THEN date_format(o_orderdate, 'dd-MMM-yyyy') WHEN 2 THEN date_format(o_orderdate, 'd MMMM yyyy') "
        "WHEN 3 THEN date_format(o_orderdate, 'yyyyMMdd') ELSE date_format(o_orderdate, 'd/M/yyyy') || ' 1:05 PM' END")
    return table(spark, folder, "orders").select("o_orderkey", to_timestamp(text).cast("string").alias("parsed"))


@query
def composite_keys(spark, folder):
    """PRJ16."""
    df = shapes.raw_projects(spark, folder).select(
        composite_code(*fixed.PROJECT_KEYS).alias("code"))
    return _count(df, "code")


@query
def finished_flag(spark, folder):
    """FLT6: a substring test, null is no."""
    status = F.expr(
        "CASE o_orderstatus WHEN 'F' THEN 'Un' || 'FINISHED' WHEN 'O' THEN 'completed early' "
        "ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Failed' ELSE NULL END END")
    df = table(spark, folder, "orders").select(status.alias("status"))
    return _count(df.withColumn("finished", is_finished(F.col("status"))), "status", "finished")


# --- constraints ------------------------------------------------------------------------------------------

def _lines_with_nulls(spark, folder) -> DataFrame:
    """lineitem with some nulls in the tested columns."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.expr("CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END").alias("l_quantity"),
        F.expr("CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_returnflag END").alias("l_returnflag"))


@query
def constraint_allowed(spark, folder):
    """FLT1."""
    rule = Constraint("l_returnflag", Check("allowed_values", ("A", "R")))
    return apply_constraints(_lines_with_nulls(spark, folder), [rule])


@query
def constraint_range(spark, folder):
    """FLT2, FLT3."""
    rules = [Constraint("l_quantity", Check("min_value", 10.0)),
             Constraint("l_quantity", Check("max_value", 40.0))]
    return apply_constraints(_lines_with_nulls(spark, folder), rules)


@query
def constraint_open(spark, folder):
    """FLT4, FLT5."""
    rules = [Constraint("l_quantity", Check("greater_than", 10.0)),
             Constraint("l_quantity", Check("less_than", 40.0))]
    return apply_constraints(_lines_with_nulls(spark, folder), rules)


@query
def constraint_drop_counts(spark, folder):
    """FLT8, AGG18: rows charged to the first rule they break."""
    rules = [Constraint("l_returnflag", Check("allowed_values", ("A", "R")), null_ok=False),
             Constraint("l_quantity", Check("min_value", 10.0)),
             Constraint("l_quantity", Check("max_value", 40.0)),
             Constraint("l_partkey", Check("greater_than", 100))]
    return drop_counts(_lines_with_nulls(spark, folder), rules)


# --- duplicates ---------------------------------------------------------------------------------------------

_LINE_ORDER = [c for c in shapes.RESULT_ORDER if c != "l_orderkey"]


@query
def dedup_keep_first(spark, folder):
    return dedup.drop_duplicates(table(spark, folder, "lineitem"),
                                 ["l_orderkey"], _LINE_ORDER).drop("l_shipdate")


@query
def dedup_keep_last(spark, folder):
    return dedup.drop_duplicates(table(spark, folder, "lineitem"),
                                 ["l_orderkey"], _LINE_ORDER, keep="last").drop("l_shipdate")


@query
def dedup_keep_none(spark, folder):
    return dedup.drop_duplicates(table(spark, folder, "lineitem").drop("l_shipdate"),
                                 ["l_orderkey", "l_linenumber"], keep=False)


@query
def duplicate_keys(spark, folder):
    return dedup.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def duplicate_count(spark, folder):
    return dedup.duplicate_count(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- joins --------------------------------------------------------------------------------------------------

@query
def merge_inner(spark, folder):
    """JON1: clashing columns of the right side get a suffix."""
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS sample_id", "l_linenumber AS line", "l_extendedprice AS price")
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey AS sample_id", "o_totalprice AS price", "o_orderstatus AS status")
    [hot] = hot_keys(lines, ["sample_id"])
    return merge.inner_join(lines, orders, ["sample_id"], "_results", hot=hot)


@query
def merge_null_safe(spark, folder):
    """JON4: null keys match each other."""
    orders = table(spark, folder, "orders").selectExpr(
        "nullif(o_orderpriority, '5-LOW') AS priority", "o_orderkey", "o_orderstatus")
    totals = _count(orders.select("priority"), "priority")
    return merge.inner_join(orders, totals, ["priority"], null_safe=True,
                            hot=hot_keys(orders, ["priority"], null_safe=True)[0])


@query
def merge_skewed(spark, folder):
    """JON1 with a key that an eighth of the rows share: spread over salts at every size."""
    orders = table(spark, folder, "orders").selectExpr(
        "CASE WHEN o_orderkey % 8 = 0 THEN 'hot' ELSE 'k' || o_custkey END AS k", "o_orderkey")
    totals = _count(orders.select("k"), "k")
    return merge.inner_join(orders, totals, ["k"], hot=hot_keys(orders, ["k"])[0])


@query
def merge_key_intersection(spark, folder):
    """JON2: join on the keys both sides have."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    projects = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "lower(n_name) AS project_code", "n_name AS project_name", "r_name AS disease_name")
    return merge.join_projects(_clean_subjects(spark, folder), projects,
                               hot=_hot(spark, folder, ["project_code"])[0])


@query
def merge_dedup_right(spark, folder):
    """JON3: projects are made unique before the join, the first one is kept."""
    projects = raw_projects(spark, folder)
    samples = raw_subjects(spark, folder).drop(dedup.ROW_POSITION)
    samples = samples.withColumn("project_code", F.trim("project_code"))
    return merge.join_projects(samples, projects,
                               hot=hot_keys(samples, fixed.PROJECT_KEYS)[0])


@query
def merge_union_fallback(spark, folder):
    """SET1: one side has none of the keys."""
    samples = table(spark, folder, "supplier").selectExpr("s_suppkey AS sample_id", "s_name")
    projects = table(spark, folder, "customer").selectExpr(
        "c_name AS project_code", "c_mktsegment AS study_code")
    return merge.join_projects(samples, projects)


@query
def merge_orphans(spark, folder):
    """JON6."""
    nation = table(spark, folder, "nation").filter("n_regionkey <> 0")
    projects = nation.selectExpr("lower(n_name) AS project_code")
    return merge.orphan_counts(projects, _clean_subjects(spark, folder),
                               _clean_results(spark, folder))


@query
def merge_orphan_rows(spark, folder):
    """JON6: the lost rows themselves."""
    orders = table(spark, folder, "orders").drop("o_orderdate")
    lines = table(spark, folder, "lineitem").selectExpr("l_orderkey AS o_orderkey")
    return merge.orphan_rows(orders, lines, ["o_orderkey"])


@query
def summary_by_project(spark, folder):
    """AGG1-AGG6 with other keys, one metric left out, null keys dropped."""
    df = table(spark, folder, "orders").selectExpr(
        "nullif(o_orderpriority, '5-LOW') AS priority", "o_orderstatus AS sample_status",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'none' ELSE cast(o_custkey AS string) END "
        "AS detection_value")
    df = df.withColumn("sample_status", map_values("sample_status", {"F": "Finished"}))
    return summarise(df, ["priority"], ("finished_percentage", "lowest_detection"))


# --- profile and gate -----------------------------------------------------------------------------------------

def _labelled_documents(spark, folder) -> DataFrame:
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")


@query
def null_profile(spark, folder):
    """AGG7."""
    return profile.null_profile(_labelled_documents(spark, folder))


@query
def null_ratio(spark, folder):
    """AGG8."""
    return profile.null_ratio(_labelled_documents(spark, folder))


@query
def value_census(spark, folder):
    """AGG17."""
    return profile.value_census(_labelled_documents(spark, folder),
                                ["lang", "source", "quality", "toxic"])


@query
def sample_values(spark, folder):
    """TOP3."""
    df = table(spark, folder, "events").selectExpr(
        "event_id", "nullif(event_type, 'view') AS event_type", "props",
        "CASE WHEN user_id % 2 = 0 THEN user_id END AS user_id")
    return profile.sample_values(df, ["event_type", "props", "user_id"], ["event_id"])


@query
def table_row_counts(spark, folder):
    """AGG10."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
             "documents", "pages", "labels", "conversations", "benchmark", "embeddings")
    return profile.row_counts({n: table(spark, folder, n) for n in names})


@query
def gate_result(spark, folder):
    """GAT1-GAT5."""
    projects = raw_projects(spark, folder).drop("study_cohort_code").withColumn(
        "study_code", F.expr("nullif(study_code, 'BUILDING')"))
    return gate.quality_gate(projects, raw_subjects(spark, folder), raw_results(spark, folder))


# --- validation -------------------------------------------------------------------------------------------------

def _renamed(df: DataFrame, name: str) -> DataFrame:
    return rename_columns(df, fixed.COLUMN_MAPPINGS[name])


def _raw_validation(spark, folder, name: str):
    raw = {"projects": raw_projects, "subjects": raw_subjects, "results": raw_results}[name]
    return validate(_renamed(raw(spark, folder), name), specs.get_spec(name), "before_cleaning")


@query
def rule_counts(spark, folder):
    """VAL1-VAL8: every rule of every raw table."""
    parts = [_raw_validation(spark, folder, n).rule_counts() for n in ("projects", "subjects", "results")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _result_failures(spark, folder) -> DataFrame:
    raw = spread(table(spark, folder, "lineitem")).select(
        *[F.expr(e).alias(c) for c, e in shapes.RESULTS.items()],
        F.expr(shapes.RESULT_ROW).alias("row_name"))
    spec_columns = _renamed(raw, "results")
    return validate(spec_columns, RESULTS, "before_cleaning").failures("row_name")


@query
def failure_cases(spark, folder):
    """VAL10, VAL11."""
    return _result_failures(spark, folder)


@query
def failure_cases_unique(spark, folder):
    """VAL8, VAL10: every row that repeats an earlier key."""
    spec = TableSpec("lines", (ColumnSpec("l_orderkey", "long"), ColumnSpec("l_linenumber", "long")),
                     unique_key=("l_orderkey",))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    found = validate(lines, spec, "check").failures(F.col("l_linenumber").cast("string"))
    return found.select("row_id", "column_name", "check_name", "error_type", "failure_case")


@query
def first_n_errors(spark, folder):
    """TOP4."""
    return first_errors(_result_failures(spark, folder), 10).select(
        "table_name", "stage", "error_rank", "row_id", "column_name", "check_name", "failure_case")


@query
def first_errors_per_rule(spark, folder):
    """TOP4 per rule."""
    return first_errors(_result_failures(spark, folder), 5, ("column_name", "check_name")).select(
        "column_name", "check_name", "error_rank", "row_id", "failure_case")


@query
def column_status(spark, folder):
    """VAL12, VAL13, SET2."""
    return _raw_validation(spark, folder, "results").column_status().drop("details")


@query
def column_status_strict(spark, folder):
    """VAL1-VAL3 on a strict spec: a column missing, one too many, one of the wrong type."""
    df = raw_projects(spark, folder).drop(dedup.ROW_POSITION, "disease_name").withColumns({
        "budget": F.lit(1), "study_name": F.length("study_name"),
        "project_name": F.expr("nullif(project_name, 'Project  NATION_3')")})
    return validate(df, PROJECTS, "before_cleaning").column_status().drop("details")


@query
def table_score(spark, folder):
    """VAL18, VAL14, VAL15."""
    parts = [_raw_validation(spark, folder, n).score() for n in ("projects", "subjects", "results")]
    check = validate(_clean_results(spark, folder), RESULTS, "after_cleaning")
    _, stats = Staging(spark).put_observed(check.prepared(), "clean_results", check.aggregates(), check.df.columns)
    parts.append(check.score(stats))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def table_checks(spark, folder):
    """VAL8, VAL9: unique key, an aggregate check and a row-valued check."""
    spec = TableSpec(
        "lines",
        (ColumnSpec("l_orderkey", specs.LONG), ColumnSpec("l_quantity", specs.DOUBLE)),
        unique_key=("l_orderkey", "l_linenumber"),
        table_checks=(
            TableCheck("enough rows", lambda df: F.count(F.lit(1)) > 10),
            TableCheck("small total", lambda df: F.sum("l_linenumber") < 10),
            TableCheck("no big orders", lambda df: df.groupBy("l_orderkey").agg(
                F.count(F.lit(1)).alias("n")).filter("n > 6")),
        ))
    return validate(table(spark, folder, "lineitem"), spec, "check").rule_counts()


@query
def merged_validation(spark, folder):
    """VAL16."""
    return validate(_merged(spark, folder), MERGED, "after_cleaning").rule_counts()


@query
def summary_validation(spark, folder):
    """VAL17."""
    return validate(summarise(_merged(spark, folder), ordered=False), SUMMARY).rule_counts()


# --- reports over the validation of the raw tables -----------------------------------------------------------------

_RUN = "run-1"


def _events(spark, folder) -> DataFrame:
    """At most one row per rule, and two per validated table: measured once and held."""
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp")
    out = None
    for name in ("projects", "subjects", "results"):
        e = reports.validation_events(_raw_validation(spark, folder, name), _RUN, event_ts=ts)
        out = e if out is None else out.unionByName(e)
    after = validate(_clean_results(spark, folder), RESULTS, "after_cleaning")
    return measured(out.unionByName(reports.validation_events(after, _RUN, event_ts=ts)))


_STORED_SPECS = (
    TableSpec("orders", (ColumnSpec("o_orderkey", specs.LONG), ColumnSpec("o_totalprice", specs.DOUBLE, checks=(specs.at_least(0),)),
                         ColumnSpec("o_orderstatus", checks=(specs.one_of(["F", "O", "P"]),)))),
    TableSpec("nation", (ColumnSpec("n_nationkey", specs.LONG), ColumnSpec("n_name")), unique_key=("n_nationkey",)),
    TableSpec("events", (ColumnSpec("event_id", specs.LONG), ColumnSpec("event_type"), ColumnSpec("value", specs.DOUBLE, checks=(specs.at_least(0),)))),
    TableSpec("customer", (ColumnSpec("c_custkey", specs.LONG), ColumnSpec("c_acctbal", specs.DOUBLE, checks=(specs.at_least(0),)))),
)


def _stored_events(spark, folder) -> DataFrame:
    """Events of tables that are valid as they are, but for one."""
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp")
    out = None
    for spec in _STORED_SPECS:
        e = reports.validation_events(validate(table(spark, folder, spec.name), spec, "after_cleaning"), _RUN, event_ts=ts)
        out = e if out is None else out.unionByName(e)
    return measured(out)


@query
def error_by_type(spark, folder):
    """AGG12."""
    return reports.errors_by(_events(spark, folder), "error_type")


@query
def error_by_table(spark, folder):
    """AGG13."""
    return reports.errors_by(_events(spark, folder), "table_name")


@query
def top_error_types(spark, folder):
    """TOP1."""
    return reports.top_errors(_events(spark, folder), "error_type")


@query
def top_error_columns(spark, folder):
    """TOP2, by column."""
    return reports.top_errors(_events(spark, folder), "column_name")


@query
def error_details(spark, folder):
    """RPT8, RPT11, RPT12, RPT13."""
    return reports.error_details(_events(spark, folder))


@query
def error_ids(spark, folder):
    """RPT4, WIN1, VAL19."""
    expected = specs.spec_frame(spark)
    return reports.detailed_errors(_events(spark, folder), expected).select(
        "error_id", "table_name", "column_name", "error_type", "check_name", "failed_cells",
        "expected_type")


@query
def data_quality_issues(spark, folder):
    """RPT6, FLT11."""
    return reports.data_quality_issues(_events(spark, folder)).select(
        "issue_id", "table_name", "column_name", "issue_type", "severity", "affected_rows")


@query
def recommendations(spark, folder):
    """RPT14, AGG14, SRT2."""
    out = reports.recommendations(_events(spark, folder))
    return out.withColumn("affected_tables", F.array_join("affected_tables", ","))


@query
def critical_issues(spark, folder):
    """RPT18."""
    return reports.critical_issues(_events(spark, folder))


@query
def table_analysis(spark, folder):
    """RPT5, RPT7."""
    return reports.table_analysis(_events(spark, folder)).drop("event_ts")


@query
def schema_violations(spark, folder):
    """RPT5."""
    out = reports.schema_violations(_events(spark, folder)).drop("event_ts")
    lists = ("missing_columns", "extra_columns", "data_type_violations", "constraint_violations")
    return out.withColumns({c: F.array_join(c, ",") for c in lists})


@query
def success_summary(spark, folder):
    """AGG16."""
    return reports.success_summary(_events(spark, folder).unionByName(_stored_events(spark, folder)))


@query
def quality_highlights(spark, folder):
    """RPT16."""
    return reports.quality_highlights(_events(spark, folder).unionByName(_stored_events(spark, folder)))


@query
def quick_overview(spark, folder):
    """RPT9."""
    return reports.quick_overview(_events(spark, folder))


@query
def next_steps(spark, folder):
    """RPT16."""
    return reports.next_steps(_events(spark, folder))


# --- reports over a log as large as the events table ------------------------------------------------------------------

# fixed values: how the event types of the log read as outcomes
_LOG_TYPES = (("error", "MissingColumn"), ("click", "TypeMismatch"), ("view", "ValueError"),
              ("signup", "DataQualityError"))


def _log(spark, folder) -> DataFrame:
    kind = F.when(F.col("event_type") == "purchase", "success").otherwise("error")
    return table(spark, folder, "events").select(
        "user_id", kind.alias("kind"), F.col("ts").cast("timestamp").alias("event_ts"),
        F.when(kind == "error", first_match(F.col("event_type"), _LOG_TYPES, "Unknown"))
        .alias("error_type"),
        F.concat(F.lit("table_"), (F.col("user_id") % 3).cast("string")).alias("table_name"))


@query
def success_rate_bands(spark, folder):
    """AGG15, RPT9, RPT15: per user."""
    return reports.rate_by(_log(spark, folder), "user_id")


@query
def severity_ladder(spark, folder):
    """RPT11, RPT12."""
    level = severity(F.col("error_type"))
    df = reports.error_events(_log(spark, folder)).select(
        "error_type", level.alias("severity"), severity_priority(level).alias("priority"))
    return _count(df, "error_type", "severity", "priority")


@query
def log_recommendations(spark, folder):
    """RPT14 over a long log."""
    out = reports.recommendations(_log(spark, folder))
    return out.withColumn("affected_tables", F.array_join("affected_tables", ","))


@query
def coarse_recommendations(spark, folder):
    """RPT16."""
    return reports.coarse_recommendations(_log(spark, folder))


@query
def run_summary(spark, folder):
    """RPT2."""
    return reports.run_summary(_log(spark, folder)).select(
        "total_tables", "total_errors", "total_successes",
        F.bround("success_rate", 6).alias("success_rate"),
        F.bround("duration_seconds", 3).alias("duration_seconds"))


@query
def executive_summary(spark, folder):
    """RPT15."""
    return reports.executive_summary(_log(spark, folder))


@query
def top_error_tables(spark, folder):
    """TOP2."""
    return reports.top_errors(_log(spark, folder), "table_name")


@query
def report_retention(spark, folder):
    """SNK7: the newest three per type."""
    return reports.latest_reports(
        table(spark, folder, "events"), "event_type", "ts", tie=["event_id"]
    ).select("event_type", "report_rank", "event_id", "user_id")


@query
def report_latest(spark, folder):
    """LIM1."""
    return reports.latest_reports(
        table(spark, folder, "events"), "event_type", "ts", keep=1, tie=["event_id"]
    ).select("event_type", "event_id", "user_id")


@query
def report_stats(spark, folder):
    """SNK8."""
    return reports.report_stats(table(spark, folder, "events"), "event_type")


# --- metrics ------------------------------------------------------------------------------------------------------------

@query
def table_metrics(spark, folder):
    """RPT19, AGG10: every table is made once; the writes count its rows."""
    staging, tidy, rows_in, rows_out = Staging(spark), {}, {}, {}
    for spec, make in ((PROJECTS, raw_projects), (SUBJECTS, raw_subjects), (RESULTS, raw_results)):
        raw, rows_in[spec.name] = staging.put_counted(make(spark, folder), f"raw_{spec.name}")
        tidy[spec.name], rows_out[spec.name] = staging.put_counted(
            clean(raw, spec, default_config()), f"clean_{spec.name}")
    _, rows_out["merged"] = staging.put_counted(_joined(**tidy), "merged")
    return metrics.counted_metrics(spark, rows_in, rows_out)


@query
def step_metrics(spark, folder):
    """RPT20, AGG18."""
    return metrics.step_metrics(raw_results(spark, folder),
                                generate_recipe(RESULTS, default_config()))


@query
def mapping_effects(spark, folder):
    """RPT17."""
    return metrics.mapping_effects(raw_results(spark, folder),
                                   generate_recipe(RESULTS, default_config()))


@query
def stage_delta(spark, folder):
    """AGG11."""
    staging = Staging(spark)
    raw, rows_in = staging.put_counted(raw_results(spark, folder), "raw_results")
    tidy, rows_out = staging.put_counted(clean(raw, RESULTS, default_config()), "clean_results")
    return metrics.stage_delta(raw.drop(dedup.ROW_POSITION), tidy, "results", (rows_in, rows_out))


# --- sources and sinks -----------------------------------------------------------------------------------------------------

@query
def csv_round_trip(spark, folder):
    """SRC1, SRC4, SRC6, SNK2."""
    path = f"{Staging(spark).folder}/orders_csv"
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "nullif(o_orderpriority, '5-LOW') AS o_orderpriority",
        "'say \"' || o_orderpriority || '\", ' || o_orderstatus AS note")
    write_summary_csv(orders, path)
    return scan_csv(spark, path, with_position=False).selectExpr(
        "cast(o_orderkey AS bigint) AS o_orderkey", "o_orderstatus", "o_orderpriority", "note")


@query
def csv_mixed_encodings(spark, folder):
    """SRC4: one folder with files in two encodings."""
    path = f"{Staging(spark).folder}/customer_csv"
    named = table(spark, folder, "customer").selectExpr("c_custkey", "c_name || ' \u00e9\u00fc' AS c_name")
    for k, encoding in enumerate(("UTF-8", "ISO-8859-1")):
        named.where(f"c_custkey % 2 = {k}").write.option("header", True).option("encoding", encoding).csv(f"{path}/{k}")
    return scan_csv(spark, f"{path}/*", with_position=False).selectExpr("cast(c_custkey AS bigint) AS c_custkey", "c_name")


@query
def na_tokens(spark, folder):
    """SRC6: every token stands in some row."""
    path = f"{Staging(spark).folder}/tokens_csv"
    tokens = [t for t in fixed.NA_TOKENS if t]
    orders = table(spark, folder, "orders").select("o_orderkey", F.get(
        F.lit(tokens), F.pmod("o_orderkey", F.lit(len(tokens) + 1)).cast("int")).alias("token"))
    orders.select("o_orderkey", F.coalesce("token", F.lit("kept")).alias("token")).write.option("header", True).csv(path)
    return scan_csv(spark, path, encoding="UTF-8", with_position=False).selectExpr(
        "cast(o_orderkey AS bigint) AS o_orderkey", "token")


@query
def parquet_round_trip(spark, folder):
    """SNK1."""
    path = f"{Staging(spark).folder}/customer.parquet"
    write_parquet(table(spark, folder, "customer"), path)
    return scan_parquet(spark, path)


@query
def report_round_trip(spark, folder):
    """SNK3, SNK4: a report appended as JSON and read back."""
    path = f"{Staging(spark).folder}/reports"
    census = profile.value_census(table(spark, folder, "orders"), ["o_orderstatus"])
    write_report(census, path, "value_census", _RUN)
    return spark.read.json(path).select(
        "report_type", "run_id", "column_name", "value", F.col("row_count").cast("bigint"))


# the records' faults, by order key, and the number of the field that shows it
_FAULTY_LINES = """CASE WHEN o_orderkey % 13 = 0 THEN concat(line, cast(X'FF' AS string))
  WHEN o_orderkey % 17 = 0 THEN concat(line, ',"open') WHEN o_orderkey % 11 = 0 THEN concat(line, ',more')
  WHEN o_orderkey % 7 = 0 THEN concat(o_orderkey, ',', o_orderstatus) ELSE line END AS value"""


@query
def csv_quarantine(spark, folder):
    """SRC5, SRC7: a folder with short, long, unclosed and undecodable records, parted in one pass."""
    staging = Staging(spark)
    path = f"{staging.folder}/orders_text"
    table(spark, folder, "orders").selectExpr(
        "*", '''concat(o_orderkey, ',', o_orderstatus, ',"', o_orderpriority, ', ""kept"""') AS line''',
    ).selectExpr(_FAULTY_LINES).write.text(path)
    split = scan_csv_split(spark, path, ["o_orderkey", "o_orderstatus", "note"], staging=staging)
    rows = split.rows.selectExpr("cast(o_orderkey AS bigint) AS o_orderkey", "o_orderstatus", "note", "'row' AS outcome")
    return rows.unionByName(split.rejects.selectExpr(
        "cast(substring_index(make_valid_utf8(cast(record AS string)), ',', 1) AS bigint) AS o_orderkey",
        "CAST(NULL AS string) AS o_orderstatus", "CAST(NULL AS string) AS note", "reason AS outcome"))


# --- counts from footers ---------------------------------------------------------------------------------------------------

@query
def footer_null_profile(spark, folder):
    """AGG7: the nulls of whole tables, of which no data page but the vectors' is read."""
    out = None
    for name in ("orders", "lineitem", "events", "documents", "embeddings"):
        part = profile.null_profile(table(spark, folder, name), stored_null_counts(spark, f"{folder}/{name}.parquet"))
        part = part.select(F.lit(name).alias("table_name"), "column_name", "row_count", "null_count", "null_ratio")
        out = part if out is None else out.unionByName(part)
    return out


@query
def footer_gate(spark, folder):
    """GAT1-GAT3, GAT5 over stored tables, by their footers."""
    def stats(name):
        return table(spark, folder, name), name, stored_null_counts(spark, f"{folder}/{name}.parquet")

    df, name, counts = stats("orders")
    out = gate.key_gate(df, name, ["o_orderkey", "o_custkey", "o_batch"], counts)
    for name in ("customer", "conversations", "pages"):
        df, name, counts = stats(name)
        out = out.unionByName(gate.null_ratio_gate(df, name, stats=counts))
    return out


# --- the log of runs -------------------------------------------------------------------------------------------------------

def _runs(spark, folder) -> DataFrame:
    """The events table as events of six runs."""
    return _log(spark, folder).select(
        F.concat(F.lit("run:"), (F.col("user_id") % 6).cast("string")).alias("run_id"), "event_ts", "kind", "error_type", "table_name")


def _kept_log(spark, folder) -> tuple[RunLog, DataFrame, DataFrame]:
    """A log whose runs were written, two thirds of them a second time, and the newest three kept."""
    log, events = RunLog(spark, f"{Staging(spark).folder}/log"), _runs(spark, folder)
    log.append_events(events)
    log.append_events(events.where("run_id > 'run:1'"))
    return log, events, log.retain(3)


@query
def event_log(spark, folder):
    """RPT1, SNK5, SNK7: what the log holds after runs were repeated and old ones removed."""
    log, events, _ = _kept_log(spark, folder)
    return log.events(events.drop("run_id").schema.add("run_id", "string")).groupBy("run_id", "kind", "error_type").agg(
        F.count(F.lit(1)).alias("n_events"))


@query
def event_log_retention(spark, folder):
    """SNK7, SNK8: what retention kept and removed."""
    return _kept_log(spark, folder)[2]


@query
def report_documents(spark, folder):
    """SNK3, SNK4, RPT3: one nested document per run, stored, read back, and two of its sections."""
    events = _runs(spark, folder)
    by_type = reports.error_events(events).groupBy("run_id", "error_type").agg(
        F.count(F.lit(1)).alias("error_count"), F.collect_set("table_name").alias("tables"))
    rates = reports.rate_by(events, "run_id")
    path = f"{Staging(spark).folder}/documents"
    documents.documents("summary_report", {"by_type": by_type, "rates": rates}, ["rates"]).write.parquet(path)
    stored = spark.read.parquet(path)
    types = documents.section(stored, "by_type", "error_type string, error_count bigint, tables array<string>").select(
        "run_id", F.lit("by_type").alias("section"), F.col("error_type").alias("item"),
        F.col("error_count").cast("string").alias("value"), F.array_join(F.array_sort("tables"), ",").alias("detail"))
    bands = documents.section(stored, "rates", "validations bigint, overview_band string", single=True).select(
        "run_id", F.lit("rates").alias("section"), F.lit("validations").alias("item"),
        F.col("validations").cast("string").alias("value"), F.col("overview_band").alias("detail"))
    return types.unionByName(bands)


# --- kept profiles and bitmaps -----------------------------------------------------------------------------------------------

_PROFILED = ["event_type", "user_id", "value"]


def _profiles(spark, folder) -> profile_state.ProfileStore:
    """The events profiled in four parts, of which the last comes later and the second twice."""
    events = table(spark, folder, "events").withColumn("part", F.pmod("event_id", F.lit(4)).cast("string"))
    store = profile_state.ProfileStore(spark, f"{Staging(spark).folder}/profiles")
    store.put(profile_state.profile_state(events.where("part < 3"), _PROFILED, "part"))
    store.put(profile_state.profile_state(events.where("part = 1"), _PROFILED, "part"))
    store.add_new(events, _PROFILED, "part")
    return store


@query
def merged_profile(spark, folder):
    """AGG7, AGG17: rows, nulls and bounds from the merged states of four parts."""
    return profile_state.described(_profiles(spark, folder).merged(), ()).drop("distinct_estimate")


@query
def frequent_values(spark, folder):
    """AGG17, TOP3: every value with a hundredth of the rows: named by merged sketches, counted exactly."""
    merged = _profiles(spark, folder).merged()
    return profile_state.frequent_values(table(spark, folder, "events"), merged, 0.01)


@query
def bitmap_duplicates(spark, folder):
    """AGG9, VAL8 without moving keys."""
    out = None
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_custkey"), ("events", "user_id"), ("conversations", "conv_id")):
        part = bitmaps.bitmap_duplicate_count(table(spark, folder, name), key).select(F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query
def bitmap_orphan_keys(spark, folder):
    """JON6 by keys: customers and orders, orders and their lines."""
    customer, orders, lines = (table(spark, folder, n) for n in ("customer", "orders", "lineitem"))
    return bitmaps.orphan_keys(customer, "c_custkey", orders, "o_custkey").select(F.lit("customer-orders").alias("relation"), "*").unionByName(
        bitmaps.orphan_keys(orders.where("o_orderkey % 3 > 0"), "o_orderkey", lines, "l_orderkey").select(F.lit("orders-lineitem").alias("relation"), "*"))


@query
def bitmap_orphan_rows(spark, folder):
    """JON6 by rows: lines whose order was left out, null keys included."""
    lines = table(spark, folder, "lineitem").selectExpr(
        "nullif(l_orderkey, 7) AS l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return bitmaps.bitmap_orphans(lines, "l_orderkey", table(spark, folder, "orders").where("o_orderkey % 5 > 0"), "o_orderkey")


# --- stored by key -----------------------------------------------------------------------------------------------------------

def _keyed_tables(spark, folder) -> tuple[copartition.KeyedTable, copartition.KeyedTable]:
    """Subjects and results without duplicates, stored by sample; the hot samples of the subjects apart."""
    staging, tidy = Staging(spark), {}
    for spec, make in ((SUBJECTS, raw_subjects), (RESULTS, raw_results)):
        recipe = generate_recipe(spec, default_config()).without("duplicate_removal")
        tidy[spec.name] = apply_recipe(make(spark, folder), recipe, keep_position=True)
    hot = hot_keys(tidy["subjects"].select("sample_id"), ["sample_id"])[0]
    return tuple(
        copartition.stage_by_key(staging, tidy[s.name], s.name, "sample_id", s.dedup_key, hot) for s in (SUBJECTS, RESULTS))


@query
def merge_copartitioned(spark, folder):
    """JON5, JON1, DST1 over tables stored by sample."""
    subjects, results = _keyed_tables(spark, folder)
    return _dates_as_text(copartition.merge_keyed(_clean_projects(spark, folder), subjects, results))


@query
def dedup_copartitioned(spark, folder):
    """DST1, DST2: the cleaned subjects, as stored by sample."""
    return _keyed_tables(spark, folder)[0].whole()


# --- sources of one's own, SQL functions, matched columns ----------------------------------------------------------------------

@query
def arrow_round_trip(spark, folder):
    """SRC8, SNK6: orders written by a custom sink in two writes and read by a custom source in parts."""
    register_sources(spark)
    path = f"{Staging(spark).folder}/orders_arrow"
    orders = table(spark, folder, "orders").repartition(6, "o_orderkey")
    orders.where("o_orderkey % 2 = 0").write.format(FORMAT).mode("append").save(path)
    orders.where("o_orderkey % 2 = 1").write.format(FORMAT).mode("append").save(path)
    return spark.read.format(FORMAT).option("rows_per_partition", 10_000).load(path)


@query
def sql_functions(spark, folder):
    """§2.12, §2.14: the column functions in SQL text over the raw results."""
    register_functions(spark)
    raw_results(spark, folder).createOrReplaceTempView("assay_raw_results")
    return spark.sql("""
      SELECT assay_standardize(sample_id) AS sample_id,
        assay_to_double(assay_map_results_detection_value(` detection_value `)) AS detection_value,
        assay_tidy(assay_map_results_cancer_detected(`cancer_detected_(yes_no)`)) AS cancer_detected,
        assay_tidy(assay_map_results_sample_status(`sample_status(running/finished/failed)`)) AS sample_status,
        CAST(CAST(assay_to_timestamp(`date of run`) AS DATE) AS STRING) AS date_of_run, count(*) AS row_count
      FROM assay_raw_results GROUP BY ALL""")


@query
def column_matching(spark, folder):
    """PRJ3: a table with other column names, matched one to one; two names would like the same column."""
    spec = TableSpec("lines", (ColumnSpec("key", specs.LONG), ColumnSpec("order_key", specs.LONG), ColumnSpec("quantity", specs.DOUBLE),
                               ColumnSpec("returnflag"), ColumnSpec("line_status")))
    renamed = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS `Order Key`", "l_partkey AS `Key Of Part`", "l_quantity AS `Quantity (pieces)`",
        "l_returnflag AS `Return_Flag`", "l_linestatus AS linestat")
    named = with_schema_names(renamed, spec)
    return named.groupBy("returnflag", "line_status").agg(
        F.sum("key").alias("part_keys"), F.sum("order_key").alias("order_keys"), F.sum(F.col("quantity").cast("bigint")).alias("pieces"))


# --- extraction, recipes, specs, reports ----------------------------------------------------------------------------------------

@query
def extract_tables(spark, folder):
    """SRC1-SRC3, SRC5: the three sources as CSV folders, and one that isn't there."""
    staging, out = Staging(spark), None
    for name, make, extract, key in (
            ("projects", raw_projects, extract_projects, "study_code"), ("subjects", raw_subjects, extract_subjects, "sample_id"),
            ("results", raw_results, extract_results, "sample_id")):
        path = f"{staging.folder}/{name}_csv"
        write_summary_csv(make(spark, folder).drop(dedup.ROW_POSITION), path)
        part = extract(spark, path).agg(F.count(F.lit(1)).alias("row_count"), F.count(key).alias("key_count"))
        part = part.select(F.lit(name).alias("source"), "row_count", "key_count", F.lit(None).cast("string").alias("error"))
        out = part if out is None else out.unionByName(part)
    try:
        missing = extract_results(spark, f"{staging.folder}/absent_csv").agg(F.count(F.lit(1)).alias("row_count"))
    except ExtractionError as e:
        missing = spark.range(1).select(
            F.lit("absent").alias("source"), F.lit(None).cast("bigint").alias("row_count"), F.lit(None).cast("bigint").alias("key_count"),
            F.lit(str(e).split(":")[0]).alias("error"))
    return out.unionByName(missing)


@query
def recipe_output(spark, folder):
    """SNK5, PRJ18: the recipes as written, beside the rows that they apply to."""
    path, rows = f"{Staging(spark).folder}/recipes", None
    write_recipes(recipe_frame(spark, *[generate_recipe(s, default_config()) for s in (PROJECTS, SUBJECTS, RESULTS)]), path)
    for name, make in (("projects", raw_projects), ("subjects", raw_subjects), ("results", raw_results)):
        part = make(spark, folder).agg(F.count(F.lit(1)).alias("input_rows")).select(F.lit(name).alias("table_name"), "input_rows")
        rows = part if rows is None else rows.unionByName(part)
    return spark.read.json(path).join(rows, "table_name").select(
        "table_name", F.col("step_number").cast("int"), "step_name", "enabled", "input_rows")


@query
def type_convert_strict(spark, folder):
    """PRJ13: strict conversion of texts that are all readable; one that isn't would end the job."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        convert(F.col("l_quantity").cast("string"), specs.DOUBLE, strict=True).alias("quantity"),
        convert(F.col("l_partkey").cast("string"), specs.LONG, strict=True).alias("part_key"))


def _raw_nulls(spark, folder) -> DataFrame:
    out = None
    for name, make in (("projects", raw_projects), ("subjects", raw_subjects), ("results", raw_results)):
        config = default_config()["data"]["column_mappings"][name]
        part = profile.null_profile(rename_columns(make(spark, folder), config)).select(
            F.lit(name).alias("table_name"), "column_name", "row_count", "null_count")
        out = part if out is None else out.unionByName(part)
    return out


@query
def schema_metadata(spark, folder):
    """VAL20: what the specs say of every column, and what the raw tables hold."""
    return specs.spec_frame(spark).join(_raw_nulls(spark, folder), ["table_name", "column_name"]).select(
        "table_name", "position", "column_name", "data_type", "nullable", "row_count", "null_count")


@query
def rule_lint(spark, folder):
    """PRJ19: required columns without a check, and how many nulls stand in them."""
    return specs.spec_lint(spark, PROJECTS, SUBJECTS, RESULTS).join(_raw_nulls(spark, folder), ["table_name", "column_name"]).select(
        "table_name", "column_name", "rule_type", "null_count")


@query
def all_reports(spark, folder):
    """RPT21, RPT3, RPT10: every report of a run, by its number of rows."""
    built = reports.build_reports(_events(spark, folder), specs.spec_frame(spark))
    out = None
    for name in sorted(built):
        part = built[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("report"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out
