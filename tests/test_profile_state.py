"""Kept profiles that merge, and keys counted by bitmaps."""

import pytest
from pyspark.sql import functions as F

from assaymill.errors import PlanError
from assaymill.operators import bitmaps
from assaymill.operators.dedup import duplicate_count
from assaymill.operators.merge import orphan_rows
from assaymill.operators.profile import null_profile, value_census
from assaymill.operators.profile_state import (
    ProfileStore, candidates, described, exact_counts, frequent_values, merged_state, profile_state,
)


@pytest.fixture(scope="module")
def data(spark):
    return spark.range(12_000, numPartitions=6).selectExpr(
        "id", "if(id % 6 = 0, NULL, if(id % 3 = 1, 'hot', concat('v', id % 40))) AS word",
        "if(id % 7 = 0, double('NaN'), id / 10) AS number", "id % 3 AS part").cache()


def test_merged_states_equal_the_state_of_the_union(spark, data):
    columns = ["word", "number", "id"]
    parts = merged_state(profile_state(data, columns, "part"))
    whole = merged_state(profile_state(data, columns, F.lit("all")))
    a = {r["column_name"]: r for r in described(parts).collect()}
    b = {r["column_name"]: r for r in described(whole).collect()}
    for c in columns:
        for field in ("row_count", "null_count", "least", "greatest", "distinct_estimate"):
            assert a[c][field] == b[c][field], (c, field)
    assert sorted(candidates(parts, 50).where("column_name = 'word'").collect()) == sorted(candidates(whole, 50).where("column_name = 'word'").collect())
    nulls = {r["column_name"]: r["null_ratio"] for r in null_profile(data.drop("part")).collect()}
    assert {c: a[c]["null_ratio"] for c in columns} == nulls
    assert a["word"]["q50"] is None and abs(a["id"]["q50"] - 6000) < 300 and abs(a["number"]["q25"] - 300) < 30
    assert abs(a["id"]["distinct_estimate"] - 12_000) < 600


def test_frequent_values_are_counted_exactly(spark, data):
    merged = merged_state(profile_state(data, ["word", "id"], "part"))
    census = {(r["column_name"], r["value"]): r["row_count"] for r in value_census(data, ["word", "id"]).collect()}
    for share in (0.02, 0.3, 0.9):
        expected = {k: n for k, n in census.items() if k[1] is not None and n >= share * 12_000}
        assert {(r["column_name"], r["value"]): r["row_count"] for r in frequent_values(data, merged, share).collect()} == expected
    with pytest.raises(ValueError):
        frequent_values(data, merged, 1e-5)
    asked = [("word", "hot"), ("word", "v1"), ("word", "absent"), ("id", "7")]
    assert {(r["column_name"], r["value"]): r["row_count"] for r in exact_counts(data, asked).collect()} == {
        k: census.get(k, 0) for k in asked}
    assert exact_counts(data, []).count() == 0


def test_new_parts_alone_are_read(spark, data, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "profiles"))
    assert store.parts() == [] and store.merged().count() == 0
    store.add_new(data.where("part < 2"), ["word", "id"], "part")
    before = {r["part"]: r["greatest"] for r in store.states().where("column_name = 'id'").collect()}
    # rows of known parts would fail if anything were computed from them
    poisoned = data.withColumn("word", F.when(F.col("part") < 2, F.raise_error(F.lit("read again"))).otherwise(F.col("word")))
    store.add_new(poisoned, ["word", "id"], "part")
    assert store.parts() == ["0", "1", "2"]
    assert {p: g for p, g in ((r["part"], r["greatest"]) for r in store.states().where("column_name = 'id'").collect()) if p in before} == before
    whole = merged_state(profile_state(data, ["word", "id"], "part"))
    assert sorted(described(store.merged(), ()).collect()) == sorted(described(whole, ()).collect())
    store.put(profile_state(data.where("part = 1"), ["word", "id"], "part"))
    assert store.states().count() == 6


def test_states_of_empty_and_all_null_columns(spark):
    empty = spark.createDataFrame([], "a string, b double, p string")
    assert profile_state(empty, ["a", "b"], "p").count() == 0
    nothing = spark.createDataFrame([(None, None, "p"), (None, float("nan"), "q")], "a string, b double, p string")
    rows = {r["column_name"]: r for r in described(merged_state(profile_state(nothing, ["a", "b"], "p"))).collect()}
    assert [(r["row_count"], r["null_count"], r["distinct_estimate"], r["q50"]) for r in (rows["a"], rows["b"])] == [(2, 2, 0, None)] * 2


# --- bitmaps ------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def keys(spark):
    left = spark.range(60_000, numPartitions=4).selectExpr(
        "CASE WHEN id % 50 = 0 THEN NULL WHEN id % 3 = 0 THEN 7 ELSE id - 5000 END AS k", "id AS v")
    right = spark.range(30_000, numPartitions=4).selectExpr("if(id % 10 = 0, NULL, id * 2 - 5000) AS k")
    return left, right


def test_bitmap_counts_equal_the_plans_that_move_keys(spark, keys):
    for df in (*keys, keys[0].limit(0), keys[0].where("k IS NULL")):
        assert bitmaps.bitmap_duplicate_count(df, "k").collect() == duplicate_count(df, ["k"]).collect()
    with pytest.raises(PlanError):
        bitmaps.bitmap_duplicate_count(spark.range(1).selectExpr("cast(id AS string) AS k"), "k")


def test_bitmap_orphans_equal_an_anti_join(spark, keys, monkeypatch):
    left, right = keys
    expected = sorted(orphan_rows(left, right, ["k"]).collect(), key=str)
    found = bitmaps.bitmap_orphans(left, "k", right, "k")
    assert sorted(found.collect(), key=str) == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan and "BroadcastExchange" in plan
    monkeypatch.setattr(bitmaps, "BROADCAST_BYTES", 0)
    assert sorted(bitmaps.bitmap_orphans(left, "k", right, "k").collect(), key=str) == expected
    assert bitmaps.bitmap_orphans(left, "k", right.limit(0), "k").count() == left.count()


def test_orphan_keys(spark, keys):
    left, right = ({r["k"] for r in df.collect()} - {None} for df in keys)
    assert tuple(bitmaps.orphan_keys(keys[0], "k", keys[1], "k").first()) == (
        len(left), len(right), len(left & right), len(left - right), len(right - left))
    assert tuple(bitmaps.orphan_keys(keys[0].limit(0), "k", keys[1].limit(0), "k").first()) == (0, 0, 0, 0, 0)


def shuffled(spark, df):
    """Bytes that a query writes for its shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def total():
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = total()
    df.collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return total() - before


def test_bitmaps_shuffle_less_than_keys(spark):
    dense = spark.range(400_000, numPartitions=4).selectExpr("(id * 48271) % 400000 AS k")
    small, large = shuffled(spark, bitmaps.bitmap_duplicate_count(dense, "k")), shuffled(spark, duplicate_count(dense, ["k"]))
    assert 0 < small < large / 4, (small, large)
