"""Operators on small fixtures, hot keys included."""

from functools import reduce

import pytest
from pyspark.sql import functions as F

from assaymill import PROJECTS, RESULTS, SUBJECTS, default_config
from assaymill.errors import PlanError, ValidationFailed
from assaymill.operators import gate, merge, metrics, profile, reports
from assaymill.operators.constraints import apply_constraints, constraints_for, drop_counts
from assaymill.operators.dedup import ROW_POSITION, drop_duplicates, duplicate_count
from assaymill.operators.skew import hot_keys, join_on_keys
from assaymill.operators.summary import summarise
from assaymill.operators.validate import first_errors, validate
from assaymill.plans import shapes
from assaymill.plans.recipe import (
    apply_recipe, apply_step, clean, generate_recipe, infer_column_mapping, recipe_frame,
)
from assaymill.specs import SPECS, get_spec, spec_frame, spec_lint, spec_metadata

KEYS = ["project_code", "study_code", "study_cohort_code"]


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def project(code="P001", name="Project A"):
    return (code, "S001", "C001", name, "Study", "Cohort", "Manager", "Disease")


def projects(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in PROJECTS.names))


def subjects(spark, *rows):
    return spark.createDataFrame(
        [(p, "S001", "C001", subject, sample, "Blood") for p, subject, sample in rows],
        ", ".join(f"{c} string" for c in SUBJECTS.names))


def results(spark, *rows):
    return spark.createDataFrame(
        list(rows), "sample_id string, detection_value double, sample_status string")


# --- merge ---------------------------------------------------------------------------------------

def test_merge_links_and_loses(spark):
    p = projects(spark, project())
    s = subjects(spark, ("P001", "SUBJ001", "SAMP001"), ("P002", "SUBJ002", "SAMP002"))
    r = results(spark, ("SAMP001", 0.5, "Finished"), ("SAMP002", 0.8, "Running"),
                ("SAMP009", 0.1, "Failed"))
    out = merge.merge_tables(p, s, r).collect()
    assert [(x["sample_id"], x["project_name"], x["subject_id"]) for x in out] == [
        ("SAMP001", "Project A", "SUBJ001")]
    assert dict(map(tuple, merge.orphan_counts(p, s, r).collect())) == {
        "subjects_without_results": 0, "results_without_subjects": 1, "subjects_without_project": 1}
    assert merge.merge_tables(p, s.limit(0), r).count() == 0
    assert merge.merge_tables(projects(spark, project("X")), s, r).count() == 0


def test_merge_keeps_one_of_equal_projects(spark):
    p = projects(spark, project(name="B"), project(name="A"))
    s = subjects(spark, ("P001", "SUBJ001", "SAMP001"))
    out = merge.merge_tables(p, s, results(spark, ("SAMP001", 0.5, "Finished")), order_by=["project_name"])
    assert [x["project_name"] for x in out.collect()] == ["A"]


def test_merge_key_errors(spark):
    left = spark.createDataFrame([("a",)], "project_code string")
    right = spark.createDataFrame([("b",)], "study_code string")
    with pytest.raises(PlanError, match="no common merge key"):
        merge.join_projects(left, right)
    other = spark.createDataFrame([("c",)], "x string")
    assert bag(merge.join_projects(other, right)) == [("c", None), (None, "b")]
    with pytest.raises(PlanError):
        merge.inner_join(left, right, ["project_code"])


def test_null_keys_match_only_on_request(spark):
    a = spark.createDataFrame([(None, 1), ("k", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("k", 4)], "k string, b int")
    assert bag(merge.inner_join(a, b, ["k"])) == [("k", 2, 4)]
    assert bag(merge.inner_join(a, b, ["k"], null_safe=True)) == [("k", 2, 4), (None, 1, 3)]
    assert bag(merge.orphan_rows(a, b, ["k"])) == [(None, 1)]


@pytest.mark.parametrize("null_safe", [False, True])
def test_hot_key_join_gives_the_same_rows(spark, null_safe):
    # one key holds a third of all rows
    left = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 500)
               .cast("string"))).alias("k"), "id")
    right = spark.createDataFrame([("hot", "h"), ("hot", "h2"), *[(f"k{i}", str(i)) for i in range(0, 500, 2)]],
                                  "k string, v string")
    [hot] = hot_keys(left, ["k"], share=0.1)
    assert len(hot) == 1
    plain = join_on_keys(left, right, ["k"], null_safe)
    salted = join_on_keys(left, right, ["k"], null_safe, hot, salts=16)
    assert salted.columns == plain.columns
    assert bag(salted) == bag(plain)
    spread = left.withColumn("salt", F.pmod(F.xxhash64("k", "id"), F.lit(16))).filter("k = 'hot'")
    assert spread.select("salt").distinct().count() == 16


def test_missing_keys_neither_match_nor_collapse_after_cleaning(spark):
    from assaymill.config import default_config
    from assaymill.plans.recipe import clean
    from assaymill.specs import PROJECTS, RESULTS, SUBJECTS

    s = clean(subjects(spark, ("P001", "SUBJ001", None), ("P001", "SUBJ002", None), ("P001", "SUBJ003", "S1")),
              SUBJECTS, default_config())
    r = clean(results(spark, (None, 0.1, "Finished"), (None, 0.9, "Finished"), ("S1", 0.5, "Finished")),
              RESULTS, default_config(), null_in_enum="keep")
    p = clean(projects(spark, project()), PROJECTS, default_config())
    assert (s.count(), r.count()) == (3, 3)
    out = merge.merge_tables(p, s, r).collect()
    assert [x["subject_id"].lower() for x in out] == ["subj003"]
    lost = {x["relation"]: x["lost_rows"] for x in merge.orphan_counts(p, s, r).collect()}
    assert (lost["subjects_without_results"], lost["results_without_subjects"]) == (2, 2)


# --- summary -----------------------------------------------------------------------------------------

def merged(spark, *rows):
    return spark.createDataFrame(
        [("P", "S", "C", st, v) for st, v in rows],
        "project_code string, study_code string, study_cohort_code string, sample_status string, "
        "detection_value double")


@pytest.mark.parametrize("rows,expected", [
    ([("Running", 0.5)], (1, 0.0, 0.5)),
    ([("Finished", 0.5), ("Completed", 0.8)], (2, 100.0, 0.5)),
    ([("Finished", 0.5), ("Running", 0.8), ("Failed", 0.2)], (3, 33.33, 0.2)),
    ([(None, None)], (1, 0.0, None)),
])
def test_summary_values(spark, rows, expected):
    [r] = summarise(merged(spark, *rows)).collect()
    assert (r["Total_Samples"], r["Finished_Percentage"], r["Lowest_Detection"]) == expected
    assert r["Code"] == "P-S-C"


def test_summary_edges(spark):
    df = merged(spark, ("Finished", 0.5))
    assert summarise(df.limit(0)).columns == [*KEYS, "Code", "Total_Samples", "Finished_Percentage",
                                              "Lowest_Detection"]
    [r] = summarise(df.drop("sample_status", "detection_value")).collect()
    assert (r["Finished_Percentage"], r["Lowest_Detection"]) == (0.0, None)
    with pytest.raises(PlanError, match="Missing required columns"):
        summarise(df.drop("study_code"))
    assert summarise(df.withColumn("study_code", F.lit(None).cast("string"))).count() == 0


# --- constraints and cleaning ----------------------------------------------------------------------------

def raw_results(spark, *rows):
    names = ["sample_id", " detection_value ", "cancer_detected_(yes_no)",
             "sample_status(running/finished/failed)", "date of run"]
    return spark.createDataFrame(list(rows), ", ".join(f"`{n}` string" for n in names))


def test_null_in_enum_is_a_choice(spark):
    df = raw_results(spark, ("A", "0.1", None, "Finished", None), ("B", None, "Yes", "error", "x"))
    out = clean(df, RESULTS, default_config())
    assert [r["sample_id"] for r in out.collect()] == ["b"]  # a numeric null passes
    kept = clean(df, RESULTS, default_config(), null_in_enum="keep")
    assert sorted(r["sample_id"] for r in kept.collect()) == ["a", "b"]


def test_cleaning_keeps_the_balance_and_is_idempotent(spark):
    df = raw_results(
        spark, ("A", "0.1", "Y", "finished", "1/2/2023"), ("A ", "0.2", "N", "running", None),
        ("B", "7", "Y", "failed", None), ("C", "0.3", "Maybe", "failed", None),
        ("D", "0.3", "Yes ", " failed ", None), ("E", "bad", "0", "Error", "2023-02-01"))
    config = default_config()
    once = clean(df, RESULTS, config, order_by=["detection_value"])
    assert bag(clean(once, RESULTS, config, order_by=["detection_value"])) == bag(once)
    out = {r["sample_id"]: r for r in once.collect()}
    assert set(out) == {"a", "e"}
    assert out["a"]["detection_value"] == 0.1 and out["e"]["detection_value"] is None
    recipe = generate_recipe(RESULTS, config)
    steps = metrics.step_metrics(df, recipe).collect()
    assert df.count() == once.count() + sum(s["rows_removed"] for s in steps)
    changed = {(s["step_name"], s["column_name"]): s["cells_changed"] for s in steps if s["cells_changed"]}
    assert changed[("value_mapping", "cancer_detected")] == 4
    assert changed[("type_conversion", "detection_value")] == 1
    hits = {(r["column_name"], r["from_value"]): r["rows_affected"]
            for r in metrics.mapping_effects(df, recipe).collect()}
    assert hits[("cancer_detected", "Y")] == 2 and hits[("sample_status", "failed")] == 2
    applied = {r["from_column"]: r["applied"] for r in metrics.column_mapping_effects(df, recipe).collect()}
    assert applied["date of run"] and not applied["fail_reason(technical/quality)"]


def test_config_constraints_override_the_spec(spark):
    rules = constraints_for(RESULTS, {"detection_value": {"max_value": 0.5, "description": "x"},
                                      "extra": {"greater_than": 1}})
    df = spark.createDataFrame([(0.4, 2), (0.6, 2), (None, None), (0.4, 1)], "detection_value double, extra int")
    assert bag(apply_constraints(df, rules)) == [(0.4, 2), (None, None)]
    counts = {(r["column_name"], r["rule"]): r["rows_removed"] for r in drop_counts(df, rules).collect()}
    assert counts == {("detection_value", "min_value"): 0, ("detection_value", "max_value"): 1,
                      ("extra", "greater_than"): 1}
    assert drop_counts(df.select("extra"), constraints_for(SUBJECTS)).count() == 0


def test_recipes(spark):
    recipe = generate_recipe(RESULTS, default_config())
    assert [s.number for s in recipe] == list(range(1, 10))
    assert [s.name for s in generate_recipe(PROJECTS, default_config())] == [
        "pre_validation", "column_mapping", "string_standardization", "missing_value_handling",
        "type_conversion", "duplicate_removal", "post_validation"]
    frame = recipe_frame(spark, recipe)
    assert frame.count() == 9 and '"allowed_values"' in frame.filter("step_number = 7").first()["parameters"]
    df = spark.createDataFrame([("a", "b", "c")], "`Sample ID` string, `x_fail_reason` string, `date of run` string")
    assert infer_column_mapping(df, RESULTS, default_config()) == {
        "sample_id": "Sample ID", "fail_reason": "x_fail_reason", "date_of_run": "date of run"}
    assert "sample_id" not in infer_column_mapping(df, RESULTS, default_config(), fuzzy=False)


# --- duplicates ---------------------------------------------------------------------------------------------

def test_duplicates(spark):
    df = spark.createDataFrame([(1, 5), (1, 3), (None, 2), (None, 1), (2, 9)], "k int, v int")
    assert bag(drop_duplicates(df, ["k"], ["v"])) == [(1, 3), (2, 9), (None, 1)]
    assert bag(drop_duplicates(df, ["k"], ["v"], "last")) == [(1, 5), (2, 9), (None, 2)]
    assert bag(drop_duplicates(df, ["k"], keep=False)) == [(2, 9)]
    assert duplicate_count(df, ["k"]).first()["duplicate_rows"] == 2
    assert drop_duplicates(df, ["absent"]) is df
    plan = drop_duplicates(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one of them in front of the shuffle


def test_cleaning_evaluates_columns_once(spark):
    df = raw_results(spark, ("A", "0.1", "Y", "finished", "1/2/2023"))
    plan = clean(df, RESULTS, default_config())._jdf.queryExecution().optimizedPlan().toString()
    # one conversion of the number, not one per constraint on it
    assert plan.count("try_cast(detection_value") == 1
    assert plan.count("RLIKE(detection_value") == 1


# --- validation, gate, profile ----------------------------------------------------------------------------------

def failed(v):
    return {(r["column_name"], r["check_name"]): r["failed_cells"]
            for r in v.rule_counts().collect() if r["failed_cells"]}


def test_projects_validation(spark):
    assert failed(validate(projects(spark, project()), PROJECTS)) == {}
    assert failed(validate(projects(spark).limit(0), PROJECTS)) == {}
    twice = projects(spark, project(), project(), project(None))
    assert failed(validate(twice, PROJECTS)) == {
        ("project_code", "not_nullable"): 1, (None, f"unique({KEYS})"): 1}
    bad = projects(spark, project()).drop("disease_name").withColumns(
        {"project_code": F.lit(1), "budget": F.lit(2)})
    assert failed(validate(bad, PROJECTS)) == {
        ("disease_name", "column_in_dataframe"): 1, ("budget", "column_in_schema"): 1,
        ("project_code", "dtype('str')"): 1}
    status = {r["column_name"]: r["error_code"] for r in validate(bad, PROJECTS).column_status().collect()}
    assert status["disease_name"] == "COLUMN_MISSING" and status["budget"] == "EXTRA_COLUMN"
    assert status["project_code"] == "VALIDATION_FAILED" and status["study_code"] == "SUCCESS"


def test_results_validation_and_failures(spark):
    df = spark.createDataFrame(
        [(1, "a", "1.5", "Maybe"), (2, None, "-0.5", "Yes"), (3, "c", "x", None), (4, "d", "0.5", "No")],
        "n int, sample_id string, detection_value string, cancer_detected string")
    v = validate(df, RESULTS, "before_cleaning")
    cells = {(r["row_id"], r["column_name"], r["failure_case"]) for r in v.failures("n").collect()
             if r["row_id"] is not None}
    assert cells == {(1, "detection_value", "1.5"), (1, "cancer_detected", "Maybe"), (2, "sample_id", None),
                     (2, "detection_value", "-0.5"), (3, "detection_value", "x")}
    score = v.score().first()
    assert (score["total_rows"], score["invalid_rows"], score["data_quality_score"]) == (4, 4, 0.0)
    # with every column there, only the rows that break a rule are invalid
    whole = df.withColumns({c: F.lit(None).cast("string") for c in RESULTS.names if c not in df.columns})
    score = validate(whole, RESULTS).score().first()
    assert (score["total_rows"], score["invalid_rows"], score["data_quality_score"]) == (4, 3, 25.0)
    assert [r["row_id"] for r in first_errors(v.failures("n").filter("row_id > 0"), 2).orderBy("error_rank").collect()] == [1, 1]
    with pytest.raises(ValidationFailed, match="detection_value"):
        v.raise_if_failed()
    events = reports.validation_events(v, "r")
    assert {r["kind"] for r in events.collect()} == {"error", "table"}
    good = validate(df.filter("n = 4").select("sample_id", F.col("detection_value").cast("double")
                    .alias("detection_value")), SPECS["merged"].__class__("t", RESULTS.columns[:2]))
    assert {r["kind"] for r in reports.validation_events(good, "r").collect()} == {"table", "success"}


def test_gate(spark):
    p = projects(spark, project())
    empty = results(spark).limit(0)
    assert gate.gate_passed(gate.quality_gate(p, subjects(spark, ("P", "S", "X")), empty))
    assert not gate.gate_passed(gate.key_gate(projects(spark, project(None)), "projects", KEYS))
    assert not gate.gate_passed(gate.key_gate(p.drop("study_code"), "projects", KEYS))
    holes = spark.createDataFrame([(None, float("nan")), ("a", 1.0)], "a string, b double")
    [r] = gate.null_ratio_gate(holes, "results").collect()
    assert (r["measured"], r["passed"]) == (0.5, False)
    assert profile.null_ratio(holes).first()["null_cells"] == 2


def test_specs(spark):
    assert spec_metadata("results")["required_fields"] == ["sample_id"]
    with pytest.raises(ValueError, match="no table spec"):
        get_spec("nope")
    assert spec_frame(spark).count() == sum(len(s.columns) for s in SPECS.values())
    lint = {(r["table_name"], r["column_name"]) for r in spec_lint(spark).collect()}
    assert ("projects", "project_name") in lint and ("projects", "project_code") not in lint


def test_duplicates_are_sorted_by_a_number_first(spark):
    """Keys that begin alike are no worse to sort than others."""
    from assaymill.operators.dedup import drop_duplicates

    df = spark.createDataFrame([("a", "x", 2), ("a", "x", 1), ("a", None, 3), (None, None, 4), (None, None, 5)], "k string, l string, n int")
    out = drop_duplicates(df, ["k", "l"], ["n"], null_keys_equal=False)
    assert sorted(r["n"] for r in out.collect()) == [1, 3, 4, 5]
    window = out._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number() windowspecdefinition(_w0" in window and "xxhash64(k" in window


def test_steps_run_where_their_column_is_first_needed(spark):
    """The result of one step after the other; what decides about no row is computed for the rows that stay."""
    folder = "/root/testdata/sf0.001"
    for spec, raw in ((RESULTS, shapes.raw_results), (SUBJECTS, shapes.raw_subjects)):
        recipe = generate_recipe(spec, default_config())
        plainly = reduce(apply_step, recipe, raw(spark, folder)).drop(ROW_POSITION)
        tidy = apply_recipe(raw(spark, folder), recipe)
        assert tidy.dtypes == plainly.dtypes
        assert bag(tidy) == bag(plainly)
    plan = apply_recipe(shapes.raw_results(spark, folder), generate_recipe(RESULTS, default_config()))
    plan = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "timestamp_ntz" in plan[:plan.index("Window [")]
