"""Tables stored by key: one exchange per table, hot and missing keys apart."""

import pytest

from assaymill.errors import PlanError
from assaymill.operators.copartition import join_keyed, merge_keyed, stage_by_key
from assaymill.operators.dedup import drop_duplicates
from assaymill.operators.merge import inner_join, merge_tables
from assaymill.operators.skew import hot_keys
from assaymill.sources import Staging

BUCKETS = 5


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(4000, numPartitions=4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 's7' WHEN id % 11 = 0 THEN NULL ELSE concat('s', id % 900) END AS k", "id % 50 AS sub", "id AS v")
    right = spark.range(3000, numPartitions=3).selectExpr("if(id % 13 = 0, NULL, concat('s', id % 1000)) AS k", "id AS w")
    return left, right


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("with_hot", [True, False])
def test_join_of_stored_tables(spark, sides, no_broadcast, with_hot):
    left, right = sides
    hot = hot_keys(left, ["k"], share=0.05)[0] if with_hot else []
    assert len(hot) == with_hot
    staging = Staging(spark)
    a = stage_by_key(staging, left, "left", "k", ["k", "sub"], hot, BUCKETS, ["v"])
    b = stage_by_key(staging, right, "right", "k", ["k"], hot, BUCKETS, ["w"])
    alone = [drop_duplicates(left, ["k", "sub"], ["v"], null_keys_equal=False), drop_duplicates(right, ["k"], ["w"], null_keys_equal=False)]
    for stored, plain in zip((a, b), alone):
        assert sorted(stored.whole().collect(), key=str) == sorted(plain.collect(), key=str)
    joined = join_keyed(a, b)
    assert sorted(joined.collect(), key=str) == sorted(inner_join(*alone, ["k"]).collect(), key=str)
    assert "hashpartitioning(k" not in plan_of(joined)
    assert (a.apart.where("k = 's7'").count() > 0) == with_hot and a.keyed.where("k IS NULL").count() == 0


def test_one_exchange_in_all(spark, sides, no_broadcast, monkeypatch):
    """The write of a stored table moves its rows once, for the duplicates and the join together."""
    plans, put = [], Staging.put_bucketed

    def watched(self, df, name, keys, buckets):
        plans.append(plan_of(df))
        return put(self, df, name, keys, buckets)

    monkeypatch.setattr(Staging, "put_bucketed", watched)
    stored = stage_by_key(Staging(spark), sides[0], "left", "k", ["k", "sub"], buckets=BUCKETS, order_by=["v"])
    assert plans[0].count("Exchange") == 1 and "REPARTITION_BY_NUM" in plans[0] and "Window" in plans[0]
    assert len(stored.keyed.inputFiles()) <= BUCKETS


def test_merge_of_stored_tables(spark, sides, no_broadcast):
    subjects = sides[0].selectExpr("concat('p', sub % 5) AS project_code", "'st' AS study_code", "'c' AS study_cohort_code",
                                   "concat('x', sub) AS subject_id", "k AS sample_id", "v")
    results = sides[1].selectExpr("k AS sample_id", "w AS detection_value")
    projects = spark.range(4).selectExpr("concat('p', id) AS project_code", "'st' AS study_code", "'c' AS study_cohort_code", "id AS project_name")
    keys = ["project_code", "study_code", "study_cohort_code", "subject_id", "sample_id"]
    hot = hot_keys(subjects, ["sample_id"], share=0.05)[0]
    staging = Staging(spark)
    merged = merge_keyed(projects, stage_by_key(staging, subjects, "s", "sample_id", keys, hot, BUCKETS, ["v"]),
                         stage_by_key(staging, results, "r", "sample_id", ["sample_id"], hot, BUCKETS, ["detection_value"]))
    plain = merge_tables(projects, drop_duplicates(subjects, keys, ["v"], null_keys_equal=False),
                         drop_duplicates(results, ["sample_id"], ["detection_value"], null_keys_equal=False))
    assert merged.columns == plain.columns
    assert sorted(merged.collect(), key=str) == sorted(plain.collect(), key=str) and merged.count() > 100
    assert "hashpartitioning(sample_id" not in plan_of(merged)


def test_wrong_keys_are_refused(spark, sides):
    with pytest.raises(PlanError):
        stage_by_key(Staging(spark), sides[0], "t", "k", ["sub"])
    staging = Staging(spark)
    a, b = (stage_by_key(staging, s.limit(0), n, "k", ["k"], h, BUCKETS, o) for s, n, h, o in (
        (sides[0], "a", [], ["v"]), (sides[1], "b", [1], ["w"])))
    with pytest.raises(PlanError):
        join_keyed(a, b)
    assert a.whole().count() == 0
