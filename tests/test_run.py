"""End to end: messy CSV files through the whole run."""

import pytest

from assaymill import GateFailed, ValidationFailed, default_config
from assaymill.errors import ExtractionError
from assaymill.plans.run import Pipeline

PROJECTS = """project_code,study_code,study_cohort_code,project_name,study_name,study_cohort_name,project_manager_name,disease_name
P001,S001,C001,Project A,Study A,Cohort A,Manager A,Disease A
 P002 ,S002,C002,Project  B,Study B,Cohort B,"Manager, B",Disease B
P001,S001,C001,Later,Later,Later,Later,Later
"""
SUBJECTS = """project_code,study_code,study_cohort_code,subject_id,sample_id,type
P001,S001,C001,SUBJ001,SAMP001,Blood
P001,S001,C001,SUBJ002,SAMP002,Blood
P002,S002,C002,SUBJ003,SAMP003,Tissue
P002,S002,C002,SUBJ003,SAMP003,Tissue
P003,S003,C003,SUBJ004,SAMP004,Tissue
P002,S002,C002,SUBJ005,SAMP009,Tissue
"""
RESULTS = """sample_id, detection_value ,cancer_detected_(yes_no),sample_status(running/finished/failed),fail_reason(technical/quality),sample_quality,sample_quality_minimum_threshold,date of run
SAMP001,0.5,Y,finished,,0.9,0.5,5/1/2023
SAMP002,1.5,No,Running,,0.9,0.5,2023-01-06
SAMP002,0.25,false,RUNNING,,0.9,0.5,2023-01-06
SAMP003, ,1,Completed,Technical,0.9,0.5,07-01-2023
SAMP004,0.1,No,Failed,,0.9,0.5,08.01.2023 10:30
SAMP005,0.1,InvalidValue,Failed,,0.9,0.5,09/01/2023
SAMP006,0.1,No,INVALID_STATUS,,0.9,0.5,09/01/2023
SAMP007,NOT_A_NUMBER,No,Error,,0.9,0.5,31/02/2023
"""


def write_inputs(folder, projects=PROJECTS, subjects=SUBJECTS, results=RESULTS):
    config = default_config()
    for name, text in (("projects", projects), ("subjects", subjects), ("results", results)):
        path = folder / f"{name}.csv"
        path.write_text(text)
        config["files"][f"{name}_file"] = str(path)
    config["files"]["output_parquet"] = str(folder / "out" / "merged.parquet")
    config["files"]["summary_csv"] = str(folder / "out" / "summary.csv")
    config["files"]["reports"] = str(folder / "reports")
    config["files"]["recipes"] = str(folder / "recipes")
    return config


def test_full_run(spark, tmp_path):
    config = write_inputs(tmp_path)
    result = Pipeline(spark, config).run(strict=True)
    assert result.succeeded
    assert result.data_summary() == {
        "projects": 2, "subjects": 5, "results": 5, "merged": 3, "summary": 2,
    }
    merged = {r["sample_id"]: r for r in spark.read.parquet(config["files"]["output_parquet"]).collect()}
    assert set(merged) == {"samp001", "samp002", "samp003"}
    assert merged["samp001"]["project_name"] == "project a"
    assert merged["samp001"]["cancer_detected"] == "Yes"
    assert str(merged["samp001"]["date_of_run"]) == "2023-01-05 00:00:00"
    assert merged["samp002"]["detection_value"] == 0.25  # the invalid first one does not shadow it
    assert merged["samp003"]["detection_value"] is None
    assert merged["samp003"]["project_manager_name"] == "manager, b"
    assert merged["samp003"]["sample_type"] == "tissue"
    summary = [
        tuple(r) for r in spark.read.option("header", True).csv(config["files"]["summary_csv"]).collect()
    ]
    assert summary == [
        ("p001", "s001", "c001", "p001-s001-c001", "2", "50.0", "0.25"),
        ("p002", "s002", "c002", "p002-s002-c002", "1", "100.0", None),
    ]

    metrics = {r["table_name"]: r for r in result.reports["table_metrics"].collect()}
    assert (metrics["results"]["input_rows"], metrics["results"]["output_rows"]) == (8, 5)
    assert metrics["results"]["success_rate"] == 62.5
    steps = result.reports["step_metrics"].collect()
    assert {(s["column_name"], s["rule"]): s["rows_removed"] for s in steps
            if s["table_name"] == "results" and s["rows_removed"]} == {
        ("detection_value", "max_value"): 1, ("cancer_detected", "allowed_values"): 1,
        ("sample_status", "allowed_values"): 1,
    }
    removed = {s["table_name"]: s["rows_removed"] for s in steps if s["step_name"] == "duplicate_removal"}
    assert removed == {"projects": 1, "subjects": 1, "results": 0}
    orphans = {r["relation"]: r["lost_rows"] for r in result.reports["orphans"].collect()}
    assert orphans == {
        "subjects_without_results": 1, "results_without_subjects": 1, "subjects_without_project": 1,
    }
    errors = {(r["table_name"], r["stage"], r["column_name"], r["check_name"]): r["failed_cells"]
              for r in result.events.filter("kind = 'error'").collect()}
    assert errors[("projects", "before_cleaning", None,
                   "unique(['project_code', 'study_code', 'study_cohort_code'])")] == 1
    assert errors[("results", "before_cleaning", "detection_value", "less_than_or_equal_to(1.0)")] == 1
    assert not any(stage == "after_cleaning" for _, stage, _, _ in errors)
    overview = result.reports["quick_overview"].first()
    assert (overview["overall_status"], overview["data_quality_status"]) == ("PASSED", "EXCELLENT")
    for name, report in result.reports.items():
        report.collect()
    stored = spark.read.json(config["files"]["reports"])
    assert {"detailed_errors", "table_metrics"} <= {
        r[0] for r in stored.select("report_type").distinct().collect()
    }
    recipes = spark.read.json(config["files"]["recipes"])
    assert recipes.filter("table_name = 'results'").count() == 9


def test_write_false_skips_outputs(spark, tmp_path):
    config = write_inputs(tmp_path)
    assert Pipeline(spark, config).run(write=False).succeeded
    assert not (tmp_path / "out").exists() and not (tmp_path / "reports").exists()


def test_headers_only(spark, tmp_path):
    heads = [t.splitlines()[0] + "\n" for t in (PROJECTS, SUBJECTS, RESULTS)]
    result = Pipeline(spark, write_inputs(tmp_path, *heads)).run(strict=True)
    assert set(result.data_summary().values()) == {0}
    assert "Finished_Percentage" in result.tables["summary"].columns


@pytest.mark.parametrize("projects", [
    "project_code,study_code\nP001,S001\n",
    PROJECTS + ",S009,C009,a,b,c,d,e\n",
])
def test_gate_stops(spark, tmp_path, projects):
    config = write_inputs(tmp_path, projects=projects)
    result = Pipeline(spark, config).run()
    assert not result.succeeded and isinstance(result.error, GateFailed)
    assert not (tmp_path / "out").exists()


def test_missing_file_and_malformed_row_stop(spark, tmp_path):
    config = write_inputs(tmp_path)
    config["files"]["subjects_file"] = str(tmp_path / "absent.csv")
    result = Pipeline(spark, config).run()
    assert isinstance(result.error, ExtractionError)
    config = write_inputs(tmp_path, subjects=SUBJECTS + "a,b,c,d,e,f,g\n")
    result = Pipeline(spark, config).run()
    assert isinstance(result.error, ExtractionError)


def test_invalid_merged_table_stops_before_writing(spark, tmp_path):
    config = write_inputs(tmp_path)
    config["data"]["constraints"] = {}
    bad = RESULTS.replace("SAMP001,0.5", "SAMP001,7.5")

    def only_text(spark, path):
        return spark.read.option("header", True).csv(path)

    pipeline = Pipeline(spark, write_inputs(tmp_path, results=bad), sources={"results": only_text})
    # switch the constraint step off so that the bad value reaches the merged table
    pipeline.recipes["results"] = pipeline.recipes["results"].without("constraint_application")
    result = pipeline.run()
    assert isinstance(result.error, ValidationFailed)
    assert not (tmp_path / "out").exists()
