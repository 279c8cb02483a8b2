"""Joins that survive a hot key.

A key that holds a large share of the rows would send them all to one task. The rows of such keys
are spread over ``SALTS`` buckets, and only the other side's rows of the same keys are repeated
per bucket. Which keys count as hot never changes the result, only the spread of the work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import sqltext as sql

# A key is hot from this share of the rows on; so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 0.005
SALTS = 64
_TRACKED = 10_000
_COMBINERS = 64


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(
    df: DataFrame, *key_sets: Sequence[str], share: float = HOT_SHARE, null_safe: bool = False,
) -> list[list[int]]:
    """For each set of key columns, the hashes of the keys that hold at least ``share`` of the rows.

    One pass over the key columns with a heavy-hitter sketch per set: nothing is shuffled by key.
    The tasks' sketches are combined in ``_COMBINERS`` groups first, so that no task takes in all of
    them. What reaches the driver is one row with at most ``1 / share`` hashes per set. Null keys
    count only if ``null_safe``, as otherwise they match nothing.
    """
    most = max(1, int(1 / share))
    tracked = max(_TRACKED, most)
    sketches = []
    for i, keys in enumerate(key_sets):
        there = " AND ".join(f"{sql.name(k)} IS NOT NULL" for k in keys)
        key_of = f"xxhash64({', '.join(sql.name(k) for k in keys)})"
        kept = "" if null_safe else f" FILTER (WHERE {there})"
        sketches.append(F.expr(f"approx_top_k_accumulate({key_of}, {tracked}){kept} AS top_{i}"))
    in_groups = df.groupBy(F.expr(f"pmod(spark_partition_id(), {_COMBINERS})").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), *sketches)
    # a grouped aggregate, as one without groups would combine nothing at all for an empty table
    row = in_groups.groupBy(F.pmod("part", F.lit(1)).alias("all")).agg(F.sum("n").alias("n"), *[
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(top_{i}, {tracked}), {most}) AS top_{i}")
        for i in range(len(key_sets))]).first()
    if row is None:
        return [[] for _ in key_sets]
    return [
        sorted(t["item"] for t in row[f"top_{i}"] or [] if t["count"] >= share * row["n"])
        for i in range(len(key_sets))
    ]


def join_on_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False,
    hot: Sequence[int] = (), salts: int = SALTS,
) -> DataFrame:
    """Inner equi-join whose output has the key columns once; ``left`` is the side with hot keys.

    Column names other than the keys must differ between the sides.
    """
    if hot:
        others = [F.col(f"`{c}`") for c in left.columns]
        is_hot = key_hash(keys).isin(*hot)
        left = left.withColumn(
            "_salt", F.when(is_hot, F.pmod(F.xxhash64(*others), F.lit(salts))).otherwise(F.lit(0))
            .cast("int"),
        )
        buckets = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
            F.array(F.lit(0))
        )
        right = right.withColumn("_salt", F.explode(buckets))
    if not null_safe:
        # inner joins drop null keys anyway; the optimizer puts this below the shuffle
        on = list(keys) + (["_salt"] if hot else [])
        return left.join(right, on, "inner").drop("_salt")
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in [*keys, "_salt"]})
    condition = None
    for k in [*keys, *(["_salt"] if hot else [])]:
        same = left[k].eqNullSafe(renamed[f"_right_{k}"])
        condition = same if condition is None else condition & same
    joined = left.join(renamed, condition, "inner")
    return joined.drop("_salt", *[f"_right_{k}" for k in [*keys, "_salt"]])
