"""Distinct keys, duplicates and orphans of dense whole-number keys by bitmaps (AGG9, VAL8, JON6).

A bucket of 32,768 neighbouring keys is one bitmap of 4 KB. Tasks build the bitmaps of the buckets they
meet and send those instead of keys; where keys lie densely, a bitmap stands for thousands of rows. Bits
can't repeat, so a key that a third of the rows share is one bit per task. Results equal those of
the plans that move keys (:func:`~assaymill.operators.dedup.duplicate_count`,
:func:`~assaymill.operators.merge.orphan_counts`); for keys that are scattered over a wide range those
plans move less, and :func:`density` tells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import sqltext as sql
from ..errors import PlanError

BUCKET = 32_768
#: Bytes of bitmaps that are broadcast at most; beyond that keys are joined.
BROADCAST_BYTES = 64 << 20
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _key(df: DataFrame, key: str) -> str:
    if dict(df.dtypes).get(key) not in _WHOLE:
        raise PlanError(f"not a whole-number column: {key}")
    return f"CAST({sql.name(key)} AS BIGINT)"


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """(bucket, bits, n): the bitmap of each bucket's keys and how many rows it stands for. Null keys
    are in no bitmap: their row has neither bucket nor bits."""
    k = _key(df, key)
    return df.groupBy(F.expr(f"bitmap_bucket_number({k})").alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position({k})) AS bits"), F.count(F.lit(1)).alias("n")).select(
        "bucket", F.when(F.col("bucket").isNotNull(), F.col("bits")).alias("bits"), "n")


def bitmap_duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """AGG9, VAL8: one row with rows_in, distinct_keys and duplicate_rows; nulls are one key."""
    distinct = F.coalesce(F.sum(F.when(F.col("bits").isNull(), F.lit(1)).otherwise(F.bitmap_count("bits"))), F.lit(0))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return key_bitmaps(df, key).agg(rows.alias("rows_in"), distinct.alias("distinct_keys")).select(
        F.col("rows_in").cast("bigint").alias("rows_in"), F.col("distinct_keys").cast("bigint").alias("distinct_keys"),
        (F.col("rows_in") - F.col("distinct_keys")).cast("bigint").alias("duplicate_rows"))


def density(df: DataFrame, key: str) -> DataFrame:
    """(buckets, rows, rows_per_bucket): bitmaps pay where a bucket stands for many rows of each task."""
    return key_bitmaps(df, key).where("bucket IS NOT NULL").agg(
        F.count(F.lit(1)).alias("buckets"), F.sum("n").alias("rows"), F.avg("n").alias("rows_per_bucket"))


def orphan_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """One row: distinct keys of the left side, of the right, of both, and those that only one side has
    (``left_only``, ``right_only``). Null keys are no keys. Only bitmaps are shuffled."""
    tagged = key_bitmaps(left, left_key).select("bucket", F.col("bits").alias("l"), F.lit(None).cast("binary").alias("r")).unionByName(
        key_bitmaps(right, right_key).select("bucket", F.lit(None).cast("binary").alias("l"), F.col("bits").alias("r")))
    # one bitmap per side and bucket is left by now
    buckets = tagged.where("bucket IS NOT NULL").groupBy("bucket").agg(
        F.expr("coalesce(bitmap_count(first(l, true)), 0) AS l"), F.expr("coalesce(bitmap_count(first(r, true)), 0) AS r"),
        F.expr("bitmap_count(bitmap_or_agg(coalesce(l, r))) AS e"))
    total = {n: F.coalesce(F.sum(n), F.lit(0)) for n in ("l", "r", "e")}
    return buckets.agg(
        total["l"].alias("left_keys"), total["r"].alias("right_keys"), (total["l"] + total["r"] - total["e"]).alias("common"),
        (total["e"] - total["r"]).alias("left_only"), (total["e"] - total["l"]).alias("right_only"))


def bitmap_orphans(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """JON6: rows of ``left`` whose key ``right`` lacks; a null key matches nothing.

    The bitmaps of the right side are measured first; if they are small enough to be broadcast, no row
    of either side is moved. Otherwise the keys are joined.
    """
    k = _key(left, left_key)
    there = key_bitmaps(right, right_key).where("bucket IS NOT NULL").select("bucket", "bits")
    if there.count() * (BUCKET // 8) > BROADCAST_BYTES:
        keys = right.select(F.expr(f"{_key(right, right_key)} AS _key")).where("_key IS NOT NULL").distinct()
        return left.join(keys, F.expr(k) == F.col("_key"), "left_anti")
    met = left.withColumn("_bucket", F.expr(f"bitmap_bucket_number({k})")).withColumn("_bit", F.expr(f"bitmap_bit_position({k})"))
    marked = met.join(F.broadcast(there), F.col("_bucket") == F.col("bucket"), "left")
    byte = "conv(hex(substring(bits, CAST(_bit DIV 8 AS INT) + 1, 1)), 16, 10)"
    is_there = f"coalesce(getbit(CAST({byte} AS BIGINT), CAST(_bit % 8 AS INT)) = 1, false)"
    return marked.where(f"NOT {is_there}").select(*[F.col(f"`{c}`") for c in left.columns])
