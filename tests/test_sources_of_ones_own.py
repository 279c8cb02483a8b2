"""The Arrow folder as a data source, functions for SQL, and one-to-one column matching."""

import itertools
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assaymill import default_config
from assaymill.functions import convert, map_values, severity, standardize, to_timestamp
from assaymill.functions.registry import register_functions
from assaymill.operators.matching import best_assignment, match_columns, weight, with_schema_names
from assaymill.plans.recipe import infer_column_mapping
from assaymill.sources import arrow_folder
from assaymill.sources.arrow_folder import FORMAT, read_manifest, register_sources
from assaymill.specs import RESULTS, ColumnSpec, TableSpec


@pytest.fixture(scope="module")
def source(spark):
    register_sources(spark)
    return spark


def save(df, path, mode="append"):
    df.write.format(FORMAT).mode(mode).save(str(path))


def test_round_trip_in_many_partitions(source, tmp_path):
    df = source.range(1000, numPartitions=7).selectExpr(
        "id", "if(id % 5 = 0, NULL, concat('ü', id)) AS name", "array(id, NULL) AS list", "struct(id AS a, DATE'2024-01-01' AS d) AS s",
        "cast(id AS decimal(12,2)) AS price", "timestamp_seconds(id) AS ts")
    save(df, tmp_path / "t")
    back = source.read.format(FORMAT).option("rows_per_partition", 200).load(str(tmp_path / "t"))
    assert back.schema == df.schema and back.rdd.getNumPartitions() >= 4
    assert sorted(back.collect()) == sorted(df.collect())
    save(df.limit(10), tmp_path / "t")
    assert back.count() == 1000  # a plan keeps to the files it was made for
    assert source.read.format(FORMAT).load(str(tmp_path / "t")).count() == 1010
    save(df.limit(3), tmp_path / "t", "overwrite")
    assert source.read.format(FORMAT).load(str(tmp_path / "t")).count() == 3
    files = [f for f in os.listdir(tmp_path / "t") if f.startswith("part-")]
    assert sorted(files) == sorted(f["name"] for f in read_manifest(str(tmp_path / "t"))["files"])


def test_an_aborted_write_leaves_nothing(source, tmp_path):
    bad = source.range(100, numPartitions=4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        save(bad, tmp_path / "t")
    assert [f for f in os.listdir(tmp_path / "t")] == [] and read_manifest(str(tmp_path / "t")) is None
    with pytest.raises(Exception, match="no table at"):
        source.read.format(FORMAT).load(str(tmp_path / "t"))
    save(source.range(5), tmp_path / "t")
    with pytest.raises(Exception, match="no"):
        save(bad, tmp_path / "t", "overwrite")
    assert source.read.format(FORMAT).load(str(tmp_path / "t")).count() == 5


@pytest.mark.parametrize("abort_at", [0, 1])
def test_a_task_that_outlives_its_write_leaves_nothing(source, tmp_path, monkeypatch, abort_at):
    """The driver cleans up before the task opens its file, or between two of its batches."""
    context = type("Context", (), {"partitionId": lambda self: 1, "taskAttemptId": lambda self: 7})()
    monkeypatch.setattr(arrow_folder.TaskContext, "get", classmethod(lambda cls: context))
    writer = arrow_folder.ArrowFolderWriter(str(tmp_path / "t"), source.range(1).schema, False).begin()

    def batches():
        for i in range(2):
            if i == abort_at:
                writer.abort([])
            yield pa.RecordBatch.from_pydict({"id": [i]})

    with pytest.raises(RuntimeError, match="has ended"):
        writer.write(batches())
    assert os.listdir(tmp_path / "t") == []


def test_files_are_skipped_by_their_bounds(source, tmp_path):
    save(source.range(1000).repartitionByRange(5, "id").withColumn("name", F.concat(F.lit("n"), F.lpad("id", 4, "0"))), tmp_path / "t")

    def read():
        return source.read.format(FORMAT).option("rows_per_partition", 1).load(str(tmp_path / "t"))

    assert read().rdd.getNumPartitions() == 5
    for condition, rows in (("id > 950", 49), ("id >= 1000", 0), ("id = 3", 1), ("name < 'n0002'", 2), ("name = 'n0500' AND id <= 500", 1), ("id <> 4", 999)):
        part = read().where(condition)
        assert part.count() == rows, condition
    assert read().where("id > 950").rdd.getNumPartitions() == 1


def test_empty_table(source, tmp_path):
    save(source.range(10).where("id > 10"), tmp_path / "t")
    back = source.read.format(FORMAT).load(str(tmp_path / "t"))
    assert back.columns == ["id"] and back.collect() == []


# --- functions for SQL ----------------------------------------------------------------------------------------

TEXTS = ["  Some   Text ", "It's\t\\odd\"", None, "", "5/1/2023", "2023-01-06 10:20", "07 Jan 2023 1:05 PM", "1e-1", ".5", "3.0", "12", "N/A",
         "completed", "Yes", "MissingColumnError", "TypeMismatch", " x "]


def test_sql_functions_give_what_the_library_gives(spark):
    names = register_functions(spark)
    assert {"assay_standardize", "assay_to_timestamp", "assay_map_results_sample_status", "assay_severity"} <= set(names)
    spark.createDataFrame([(t,) for t in TEXTS], "x string").createOrReplaceTempView("assay_texts")
    got = spark.sql("""SELECT x, assay_standardize(x) AS a, CAST(assay_to_timestamp(x) AS STRING) AS b, assay_to_double(x) AS c, assay_to_long(x) AS d,
        assay_severity(x) AS e, assay_map_results_sample_status(x) AS f, assay_is_finished(x) AS g FROM assay_texts""")
    mapping = default_config()["data"]["value_mappings"]["results"]["sample_status"]
    x = F.col("x")
    expected = spark.table("assay_texts").select(
        "x", standardize(x).alias("a"), to_timestamp(x).cast("string").alias("b"), convert(x, "double").alias("c"), convert(x, "long").alias("d"),
        severity(x).alias("e"), map_values("x", mapping).alias("f"), F.expr("false").alias("g")).drop("g")
    assert sorted(got.drop("g").collect(), key=str) == sorted(expected.collect(), key=str)
    assert got.where("g").select("x").collect() == [("completed",)]


def test_sql_functions_are_inlined(spark):
    register_functions(spark)
    spark.createDataFrame([("a",)], "x string").createOrReplaceTempView("assay_texts")
    plan = spark.sql("SELECT assay_standardize(x) AS y FROM assay_texts WHERE assay_to_long(x) > 3")._jdf.queryExecution()
    for text in (plan.optimizedPlan().toString(), plan.executedPlan().toString()):
        assert "UDF" not in text and "SQLFunction" not in text and "assay_" not in text.replace("assay_texts", "")
    assert "regexp_replace" in plan.optimizedPlan().toString()


# --- column matching -------------------------------------------------------------------------------------------

def total(weights, chosen):
    return sum(weights[i][j] for i, j in enumerate(chosen) if j is not None)


def test_assignment_is_the_best_of_all():
    rng = random.Random(1)
    for _ in range(300):
        rows, columns = rng.randint(1, 5), rng.randint(1, 5)
        weights = [[rng.choice([0, 0, 1, 2.5, 3, 8]) for _ in range(columns)] for _ in range(rows)]
        chosen = best_assignment(weights)
        used = [j for j in chosen if j is not None]
        assert len(used) == len(set(used)) and all(weights[i][j] > 0 for i, j in enumerate(chosen) if j is not None)
        n = max(rows, columns)
        best = max(sum(weights[i][p[i]] for i in range(rows) if p[i] < columns) for p in itertools.permutations(range(n)))
        assert abs(total(weights, chosen) - best) < 1e-9
    assert best_assignment([]) == [] and best_assignment([[]]) == [None]


def test_columns_are_matched_one_to_one(spark):
    spec = TableSpec("lines", (ColumnSpec("key"), ColumnSpec("order_key"), ColumnSpec("quantity"), ColumnSpec("none_such")))
    df = spark.createDataFrame([(1, 2, 3, 4)], "`Order Key` int, `Key Of Part` int, `Quantity (pieces)` int, other int")
    claimed = list(infer_column_mapping(df, spec).values())
    assert len(claimed) > len(set(claimed))  # by rank alone two names claim one column
    assert match_columns(df, spec) == {"key": "Key Of Part", "order_key": "Order Key", "quantity": "Quantity (pieces)"}
    assert with_schema_names(df, spec).columns == ["order_key", "key", "quantity", "other"]
    assert match_columns(df, spec, loose=False) == {}


def test_names_and_configuration_come_first(spark):
    df = spark.createDataFrame([("a",) * 4], "sample_id string, ` detection_value ` string, detection_values string, `date of run` string")
    found = match_columns(df, RESULTS, default_config())
    assert found == {"sample_id": "sample_id", "detection_value": " detection_value ", "date_of_run": "date of run"} | (
        {"sample_status": found["sample_status"]} if "sample_status" in found else {})
    assert weight("a_b", "A B", {}) > 3 and weight("a", "", {}) == 0 and weight("quantity", "quantitiy", {}) > 0.6
