"""Counts that the staged writes bring: no further scan, exact where tasks are repeated."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from test_run import write_inputs

from assaymill.operators.gate import null_ratio_gate
from assaymill.operators.metrics import counted_metrics, stage_delta, table_metrics
from assaymill.operators.validate import validate
from assaymill.plans.run import Pipeline
from assaymill.sources import Staging
from assaymill.specs import ColumnSpec, TableSpec, at_most


@pytest.fixture(scope="module")
def counts(spark):
    return [F.count(F.lit(1)).alias("n"), F.sum("id").alias("total"), F.expr("count_if(id % 3 = 0) AS thirds"), F.min("name").alias("least")]


def jobs(spark, group, fn):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = fn()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_observed_counts_equal_an_aggregation(spark, counts):
    df = spark.range(10_000, numPartitions=7).withColumn("name", F.concat(F.lit("n"), "id"))
    table, stats = Staging(spark).put_observed(df, "t", counts, ["id"])
    assert table.columns == ["id"] and table.count() == 10_000
    assert stats.schema == df.agg(*counts).schema
    assert stats.collect() == df.agg(*counts).collect()


def test_nothing_more_runs_than_the_write(spark, counts):
    df = spark.range(1000).withColumn("name", F.lit("x")).repartition(4)
    _, plain = jobs(spark, "plain", lambda: Staging(spark).put(df, "t"))
    (_, stats), observed = jobs(spark, "observed", lambda: Staging(spark).put_observed(df, "t", counts))
    assert observed == plain
    rows, read = jobs(spark, "read", stats.collect)
    assert rows[0]["n"] == 1000 and read == 0


def test_stored_names_and_empty_tables(spark, counts):
    df = spark.createDataFrame([], "id long, name string")
    table, stats = Staging(spark).put_observed(df, "t", counts, {"key": "id"})
    assert table.columns == ["key"]
    assert tuple(stats.first()) == (0, None, 0, None)
    filtered = spark.range(10).withColumn("name", F.lit("x")).where("id > 100 AND 1 = 2")
    assert Staging(spark).put_counted(filtered, "t")[1] == 0


REPEATED = """
import sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from assaymill.sources import Staging
spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "3").config("spark.checkpoint.dir", {folder!r}).getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def fails_at_first(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() < 2 and TaskContext.get().partitionId() % 2 == 0:
        raise ValueError("lost")

df = spark.range(9000, numPartitions=6).mapInArrow(fails_at_first, "id long")
counts = [F.count(F.lit(1)).alias("n"), F.sum("id").alias("total")]
for frame in (df, df.groupBy((F.col("id") % 100).alias("id")).count()):
    table, stats = Staging(spark).put_observed(frame, "t", counts)
    assert stats.collect() == table.agg(*counts).collect(), stats.collect()
print("equal", stats.first()["n"])
"""


def test_exact_when_tasks_are_repeated(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = REPEATED.format(root=root, folder=str(tmp_path))
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert "equal 100" in out.stdout, out.stderr[-2000:]


def test_a_run_scans_each_source_once(spark, tmp_path, monkeypatch):
    """Every source is read by the write that stages it, and by no other plan of the run."""
    written, put = {}, Staging.put

    def watched(self, df, name, partition_by=()):
        written[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return put(self, df, name, partition_by)

    monkeypatch.setattr(Staging, "put", watched)
    result = Pipeline(spark, write_inputs(tmp_path)).run(write=False, strict=True)
    for name in ("projects", "subjects", "results"):
        assert written[f"raw_{name}"].count("Relation [") == 1 and "CollectMetrics" in written[f"raw_{name}"]
        assert written[f"clean_{name}"].count("Relation [") == 1 and "CollectMetrics" in written[f"clean_{name}"]
    rows, ran = jobs(spark, "summary", result.data_summary)
    assert ran == 0 and rows["merged"] == result.tables["merged"].count() == 3
    for name, table in result.tables.items():
        assert rows[name] == table.count(), name
    assert {(r["table_name"], r["measured"]) for r in result.gate.filter("rule = 'null_ratio'").collect()} == {
        (n, null_ratio_gate(spark.read.option("header", True).csv(str(tmp_path / f"{n}.csv")), n).first()["measured"])
        for n in ("subjects", "results")}


def test_validation_from_a_write(spark):
    spec = TableSpec("t", (ColumnSpec("id", "long", checks=(at_most(50),)), ColumnSpec("name", "string")),
                     unique_key=("name",))
    df = spark.range(100).withColumn("name", F.when(F.col("id") % 10 > 0, F.col("id") % 7).cast("string"))
    plain, check = validate(df, spec), validate(df, spec)
    table, counts = Staging(spark).put_observed(check.prepared(), "t", check.aggregates(), df.columns)
    staged = validate(table, spec)
    assert staged.rule_counts(staged.completed(counts)).collect() == plain.rule_counts().collect()
    assert staged.score(counts).collect() == plain.score().collect()


def test_metrics_from_counts(spark):
    before, after = spark.range(10).toDF("a"), spark.range(7).select(F.col("id").alias("a"), F.lit(1).alias("b"))
    assert sorted(counted_metrics(spark, {"t": 10}, {"t": 7, "made": 2}).collect(), key=str) == sorted(
        table_metrics({"t": before}, {"t": after, "made": spark.range(2)}).collect(), key=str)
    assert stage_delta(before, after, "t", (10, 7)).collect() == stage_delta(before, after, "t").collect()


def test_summary_comes_sorted(spark):
    """SRT1: the order itself, which comparisons of rows as sets don't see."""
    from assaymill.operators.summary import summarise

    rows = [(p, s, c, "Finished", 0.5) for p in ("b", "a", "c") for s in ("y", "x") for c in ("2", "1")]
    df = spark.createDataFrame(rows * 3, "project_code string, study_code string, study_cohort_code string, sample_status string, "
                               "detection_value double").repartition(6)
    keys = [tuple(r)[:3] for r in summarise(df).collect()]
    assert keys == sorted(keys) and len(keys) == 12
