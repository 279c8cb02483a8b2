"""The log of runs on disk: idempotent writes, retention, documents; counts from footers."""

import os

import pytest
from pyspark.sql import functions as F
from test_run import write_inputs

from assaymill.operators.documents import document_shape, documents, section
from assaymill.operators.gate import key_gate, null_ratio_gate
from assaymill.operators.profile import null_profile, null_ratio
from assaymill.operators.reports import build_reports, run_documents, validation_events
from assaymill.operators.validate import validate
from assaymill.plans.run import Pipeline
from assaymill.sources import RunLog, footer_counts, stored_null_counts
from assaymill.specs import ColumnSpec, TableSpec, at_most

SPEC = TableSpec("t", (ColumnSpec("id", "long", checks=(at_most(5),)), ColumnSpec("name", "string")))


def ts(day):
    return F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp")


def events_of(spark, run_id, day, rows=10):
    df = spark.range(rows).withColumn("name", F.when(F.col("id") > 0, F.lit("x")))
    return validation_events(validate(df, SPEC, "after_cleaning"), run_id, event_ts=ts(day))


def folders(root, *path):
    found = os.path.join(root, *path)
    return sorted(x for x in os.listdir(found) if "=" in x)


def test_running_a_run_twice_leaves_one_copy(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    for rows in (10, 8, 8):
        for run in ("run:1", "run/2"):
            events = events_of(spark, run, 1, rows)
            log.append(run, events, {"by_type": build_reports(events)["error_by_type"]}, run_documents(events, run), ts(1))
    assert log.events().where("kind = 'table'").select("run_id", "total_rows").orderBy("run_id").collect() == [("run/2", 8), ("run:1", 8)]
    assert log.events().count() == 2 * events_of(spark, "x", 1).count()
    assert log.report("by_type").count() == 2
    assert log.documents().count() == 4
    assert log.index().groupBy("report_type").count().orderBy("report_type").collect() == [
        ("by_type", 2), ("summary_report", 2), ("technical_report", 2), ("validation_events", 2)]


def test_a_report_that_finds_nothing_any_more(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    some = spark.createDataFrame([(1, None)], "a long, b string")
    log.append("r", reports={"t": some})
    assert log.report("t").select("a", "b").collect() == [(1, None)]
    log.append("r", reports={"t": some.limit(0)})
    assert log.report("t").count() == 0
    assert [tuple(r) for r in log.index().select("report_type", "rows").collect()] == [("t", 0)]


def test_retention_leaves_three_runs_per_type_on_disk(spark, tmp_path):
    root = str(tmp_path / "log")
    log = RunLog(spark, root)
    assert log.retain().collect() == [] and log.events().count() == 0
    for day in range(1, 7):
        run = f"r{day}"
        events = events_of(spark, run, day)
        reports = {"all": events.select("kind")} | ({"odd": events.select("kind")} if day % 2 else {})
        log.append(run, events, reports, run_documents(events, run), ts(day))
    before = os.path.getmtime(f"{root}/report_type=odd/run_id=r1")
    stats = {r["report_type"]: (r["kept"], r["cleaned"]) for r in log.retain().collect()}
    assert stats == {"all": (3, 3), "odd": (3, 0), "validation_events": (3, 3), "summary_report": (3, 3), "technical_report": (3, 3)}
    last = ["run_id=r4", "run_id=r5", "run_id=r6"]
    assert folders(root, "report_type=all") == folders(root, "_events") == folders(root, "_documents", "report_type=technical_report") == last
    assert folders(root, "report_type=odd") == ["run_id=r1", "run_id=r3", "run_id=r5"]
    assert folders(root, "_index") == ["run_id=r1", "run_id=r3", *last]
    assert os.path.getmtime(f"{root}/report_type=odd/run_id=r1") == before
    assert sorted(r["run_id"] for r in log.events().select("run_id").distinct().collect()) == ["r4", "r5", "r6"]
    assert {(r["report_type"], r["kept"], r["cleaned"]) for r in log.retain(1).collect()} == {
        ("all", 1, 2), ("odd", 1, 2), ("validation_events", 1, 2), ("summary_report", 1, 2), ("technical_report", 1, 2)}
    assert folders(root, "_index") == ["run_id=r5", "run_id=r6"]


def test_events_of_many_runs_in_one_write(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    many = events_of(spark, "a", 1).unionByName(events_of(spark, "b", 2)).unionByName(events_of(spark, "c", 3))
    log.append_events(many)
    log.append_events(many.where("run_id = 'b'"))
    assert log.events().count() == many.count()
    log.retain(2)
    assert {r["run_id"] for r in log.events().collect()} == {"b", "c"}
    plan = log.events().where("run_id = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_pipeline_keeps_a_log(spark, tmp_path):
    config = write_inputs(tmp_path)
    results = [Pipeline(spark, config).run(strict=True) for _ in range(4)]
    log = RunLog(spark, config["files"]["reports"])
    runs = {r["run_id"] for r in log.index().select("run_id").distinct().collect()}
    assert runs == {r.run_id for r in results[1:]}
    assert log.events().where(F.col("run_id") == results[3].run_id).count() == results[3].events.count()
    details = section(log.documents().where("report_type = 'technical_report'"), "table_analysis",
                      "table_name string, stage string, total_rows bigint")
    assert details.where(F.col("run_id") == results[2].run_id).count() == results[2].reports["table_analysis"].count()


def test_documents_with_sections_of_different_shape(spark):
    one = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 3, 'quote " and \\')], "run_id string, n long, s string")
    other = spark.createDataFrame([("a", 1.5, ["p", "q"])], "run_id string, rate double, names array<string>")
    docs = documents("t", {"one": one, "o'ther \"": other}, ["o'ther \""])
    assert docs.count() == 2
    assert {tuple(r) for r in section(docs, "one", "n bigint, s string").collect()} == {("a", 1, "x"), ("a", 2, None), ("b", 3, 'quote " and \\')}
    assert section(docs, "absent", "n bigint").count() == 0
    text = {r["run_id"]: r["t"] for r in docs.select("run_id", F.to_json("document").alias("t")).collect()}
    assert '"names":["p","q"],"rate":1.5' in text["a"] and '"o\'ther \\"":null' in text["b"]
    plain = documents("t", {"one": one, "two": other}, ["two"])
    assert [tuple(r) for r in section(plain, "two", "rate double, names array<string>", single=True).collect()] == [("a", 1.5, ["p", "q"])]
    shape = document_shape(plain).first()["shape"]
    assert "one: ARRAY<OBJECT<n: BIGINT, s: STRING>>" in shape and "rate: DECIMAL(2,1)" in shape


# --- footers ----------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "t.parquet")
    spark.range(1000, numPartitions=3).selectExpr(
        "id", "if(id % 4 = 0, NULL, cast(id AS string)) AS name", "if(id % 5 = 0, NULL, if(id % 5 = 1, double('NaN'), id / 3)) AS x",
        "if(id % 10 = 0, NULL, array(id)) AS list", "cast(NULL AS date) AS day", "id % 2 = 0 AS `odd.name`").write.parquet(path)
    return path


def test_footer_counts_read_no_data_page(spark, stored):
    df = footer_counts(spark, stored)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(id), COUNT(name), COUNT(day), COUNT(`odd.name`)]" in plan or \
        "PushedAggregation: [COUNT(*), COUNT(id), COUNT(name), COUNT(day), COUNT(odd.name)]" in plan
    assert "ReadSchema: struct<count(*)" in plan
    assert tuple(df.first()) == (1000, 1000, 750, 0, 1000)


def test_stored_null_counts_equal_a_scan(spark, stored):
    df = spark.read.parquet(stored)
    stats = stored_null_counts(spark, stored)
    assert sorted(null_profile(df, stats).collect()) == sorted(null_profile(df).collect())
    assert null_ratio(df, stats).collect() == null_ratio(df).collect()
    assert key_gate(df, "t", ["id", "name", "absent"], stats).collect() == key_gate(df, "t", ["id", "name", "absent"]).collect()
    assert null_ratio_gate(df, "t", stats=stats).collect() == null_ratio_gate(df, "t").collect()


def test_footers_without_counts_and_empty_tables(spark, stored, tmp_path):
    bare, none = str(tmp_path / "bare.parquet"), str(tmp_path / "none.parquet")
    spark.read.parquet(stored).write.option("parquet.column.statistics.enabled", "false").parquet(bare)
    assert stored_null_counts(spark, bare).collect() == stored_null_counts(spark, stored).collect()
    spark.read.parquet(stored).limit(0).write.parquet(none)
    assert set(stored_null_counts(spark, none).first()) == {0}


def test_the_callers_session_is_left_alone(spark, stored):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    footer_counts(spark, stored).collect()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert "PushedAggregation" not in spark.read.parquet(stored).agg(F.count("name"))._jdf.queryExecution().executedPlan().toString()
