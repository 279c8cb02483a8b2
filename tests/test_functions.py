"""Column functions on hand-written values."""

import datetime as dt
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from assaymill.functions import (
    compile_mapping, composite_code, convert, is_finished, map_values, standardize, to_double,
    to_long, to_timestamp,
)
from assaymill.fixed_values import VALUE_MAPPINGS
from assaymill.functions.convert import _in_iso_order, _on_full_clock
from assaymill.functions.scores import band, executive_status, severity
from assaymill.specs import RESULTS


def apply(spark, values, column):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "i int, s string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("s"))).collect()]


def test_numbers(spark):
    texts = ["1", " 2.5 ", "-.5", "5.", "1e3", "inf", "0.5d", "1f", "0x1p3", "nan", "1,000", "", None]
    assert apply(spark, texts, to_double) == [
        1.0, 2.5, -0.5, 5.0, 1000.0, float("inf"), None, None, None, None, None, None, None]
    assert apply(spark, ["3.0", "3.5", "9007199254740993", "x"], to_long) == [
        3, None, 9007199254740993, None]


def test_dates_each_in_its_own_format(spark):
    texts = ["5/1/2023", "2023-01-05", "05-01-2023 10:20:30", "5.1.2023 7:05", "2023/01/05",
             "05/1/2023", "5-01-2023", "2023-1-5", "31/02/2023", "abc", None]
    day = dt.datetime(2023, 1, 5)
    assert apply(spark, texts, to_timestamp) == [
        day, day, day.replace(hour=10, minute=20, second=30), day.replace(hour=7, minute=5), day,
        day, day, day, None, None, None]
    given = lambda c: to_timestamp(c, ["MM/dd/yyyy", "dd-MMM-yyyy"])
    assert apply(spark, ["01/05/2023", "05-Jan-2023", "5/1/2023"], given) == [day, day, None]


def test_strict_conversion_raises(spark):
    with pytest.raises(PySparkException, match="cannot convert to double: abc"):
        apply(spark, ["1", "abc"], lambda c: convert(c, "double", strict=True))
    assert apply(spark, ["1", None], lambda c: convert(c, "double", strict=True)) == [1.0, None]


def test_text(spark):
    texts = ["  A \t b  C ", "　x", "a\x1cb", "", None]
    assert apply(spark, texts, standardize) == ["a b c", "x", "a b", "", None]
    assert apply(spark, ["Finished", "COMPLETED now", "Unfinished", "Failed", None], is_finished) == [
        True, True, True, False, False]
    assert apply(spark, ["x"], lambda c: composite_code(c, F.lit(1), F.lit("z"))) == ["x-1-z"]


def test_value_mapping(spark):
    mapping = VALUE_MAPPINGS["results"]["cancer_detected"]
    texts = ["Yes", "No", "Y", "N", "True", "False", "1", "0", "yes", "no", "NA", "nan",
             "InvalidValue", " Yes", None]
    assert apply(spark, texts, lambda c: map_values("s", mapping)) == [
        "Yes", "No", "Yes", "No", "Yes", "No", "Yes", "No", "Yes", "No", None, None,
        "InvalidValue", " Yes", None]


def test_value_mapping_chains_and_nulls(spark):
    assert compile_mapping({"a": "b", "B": "c", "x": None, "c": "d"}) == {
        "a": "d", "b": "d", "x": None, "c": "d"}
    # an entry never reaches back to an earlier one
    assert compile_mapping({"b": "c", "a": "b"}) == {"b": "c", "a": "b"}
    assert apply(spark, [None, "NaN", "z"], lambda c: map_values("s", {"nan": "none"})) == [
        "none", "none", "z"]


def test_ladders(spark):
    kinds = ["MissingColumn", "SchemaErrors", "ValueError", "ConstraintError", "Other"]
    assert apply(spark, kinds, severity) == ["CRITICAL", "CRITICAL", "HIGH", "MEDIUM", "LOW"]
    rates = ["95", "94.9", "80", "50", "49.9"]
    assert apply(spark, rates, lambda c: band(c.cast("double"))) == [
        "EXCELLENT", "GOOD", "GOOD", "POOR", "CRITICAL"]
    assert apply(spark, ["90", "89.9", "69.9"], lambda c: executive_status(c.cast("double"))) == [
        "PASSED", "WARNING", "FAILED"]


def test_cleaning_generates_methods_that_the_jvm_compiles(spark):
    """HotSpot interprets methods of more than 8000 bytes of byte code."""
    from assaymill.config import default_config
    from assaymill.plans.recipe import apply_recipe, generate_recipe
    from assaymill.plans.shapes import raw_results

    recipe = generate_recipe(RESULTS, default_config()).without("duplicate_removal")
    tidy = apply_recipe(raw_results(spark, "/root/testdata/sf0.001"), recipe, keep_position=True)
    shown = spark._jvm.PythonSQLUtils.explainString(tidy._jdf.queryExecution(), "codegen")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", shown)]
    assert sizes and max(sizes) <= 8000


def test_plain_texts_are_standardised_as_others(spark):
    texts = ["", " ", "  A b ", "a  b", "a\tb", "\u00a0 a", "\u00e9  x ", "one two three", "x\n", "~ !", "a\u3000", "\x1c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(standardize(F.col("t"))).collect()]
    assert got == [" ".join(re.split(r"[ \t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+", t)).strip(" ").lower()
                   for t in texts]


def test_dates_are_read_alike_with_and_without_the_held_text(spark):
    texts = ["1/2/2023", "01-02-2023", "31.12.2023", "31/02/2023", "1/2-2023", "  11-12-2023", "1-12-2023 ", "1/2/2023\n", "1/2/23",
             "5 May 2023 1:05 PM", "2023/1/2", "20230102", "1/2/2023 1:05 pm", "2023-01-02", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", to_timestamp(F.col("t")).alias("a"), to_timestamp(F.col("t"), held=False).alias("b"),
                     _in_iso_order(_on_full_clock(F.col("t"))).try_cast("timestamp_ntz").alias("c")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows] == [r["c"] for r in rows]
