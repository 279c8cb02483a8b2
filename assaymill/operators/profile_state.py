"""Profiles that are kept and merged (AGG7, AGG17, TOP3).

A *state* has one row per part of the data (a file, a day, a run) and column: counts, and sketches of
the distinct values, the frequent values and, for numbers, the distribution. It is made in one pass
in which each task sends one row per part; no cell and no value moves. States of parts merge into the
state of their union, so a grown table is profiled by its new parts alone: what was profiled before
is never read again.

What a sketch names is only a candidate. :func:`frequent_values` counts the candidates exactly, in a
second pass that moves one row per task and candidate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sqltext as sql
from ..local import local_table
from .profile import is_missing

#: Values that a frequency sketch can track. It names every value with more than a few times 1 / TRACKED
#: of the rows.
TRACKED = 10_000
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
#: States are merged in so many groups first, so that no task takes in the sketches of all parts.
_COMBINERS = 64
STATE = (
    "part string, column_name string, row_count bigint, null_count bigint, least string, greatest string, "
    "distinct_values binary, frequent struct<sketch:binary,maxItemsTracked:int,itemDataType:string,itemDataTypeDDL:string>, "
    "distribution binary"
)
_FIELDS = ("part", "column_name", "row_count", "null_count", "least", "greatest", "distinct_values", "frequent", "distribution")


def profile_state(df: DataFrame, columns: Sequence[str], part: Column | str) -> DataFrame:
    """The state of every part of ``df``. Values are compared by their text; NaN counts as missing."""
    types, aggregates = dict(df.dtypes), [F.count(F.lit(1)).alias("row_count")]
    for i, c in enumerate(columns):
        missing = is_missing(c, types[c])
        text = f"CASE WHEN NOT ({missing}) THEN CAST({sql.name(c)} AS STRING) END"
        aggregates += [F.expr(f"{e} AS {n}_{i}") for n, e in (
            ("nulls", f"count_if({missing})"), ("least", f"min({text})"), ("greatest", f"max({text})"),
            ("distinct", f"hll_sketch_agg({text})"), ("frequent", f"approx_top_k_accumulate({text}, {TRACKED})"))]
        if types[c] in _NUMBERS:
            number = f"CASE WHEN NOT ({missing}) THEN CAST({sql.name(c)} AS DOUBLE) END"
            aggregates.append(F.expr(f"kll_sketch_agg_double({number}) AS distribution_{i}"))
    stats = df.withColumn("_part", (F.col(part) if isinstance(part, str) else part).cast("string")).groupBy("_part").agg(*aggregates)
    return stats.selectExpr("_part AS part", "row_count", sql.rows([
        {"column_name": sql.literal(c), "null_count": f"nulls_{i}", "least": f"least_{i}", "greatest": f"greatest_{i}",
         "distinct_values": f"distinct_{i}", "frequent": f"frequent_{i}",
         "distribution": f"distribution_{i}" if types[c] in _NUMBERS else "CAST(NULL AS BINARY)"}
        for i, c in enumerate(columns)])).select(*_FIELDS)


_MERGES = (
    "sum(row_count) AS row_count", "sum(null_count) AS null_count", "min(least) AS least", "max(greatest) AS greatest",
    "hll_union_agg(distinct_values, true) AS distinct_values", f"approx_top_k_combine(frequent, {TRACKED}) AS frequent",
    "kll_merge_agg_double(distribution) AS distribution",
)


def merged_state(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per column (and ``by``): the state of all parts together."""
    merges = [F.expr(m) for m in _MERGES]
    keys = [*by, "column_name"]
    grouped = state.withColumn("_group", F.pmod(F.xxhash64("part"), F.lit(_COMBINERS))).groupBy(*keys, "_group").agg(*merges)
    return grouped.groupBy(*keys).agg(*merges)


def described(merged: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """AGG7 and more from a merged state: exact counts and bounds, estimated numbers of distinct values
    and quantiles (null for columns that hold no numbers)."""
    share = F.coalesce(F.try_divide("null_count", "row_count"), F.lit(0.0))
    quantile = [
        F.expr(f"CASE WHEN distribution IS NOT NULL AND kll_sketch_get_n_double(distribution) > 0 "
               f"THEN kll_sketch_get_quantile_double(distribution, {float(q)!r}D) END").alias(f"q{round(q * 100)}")
        for q in quantiles]
    return merged.select(
        "column_name", "row_count", "null_count", share.alias("null_ratio"), "least", "greatest",
        F.hll_sketch_estimate("distinct_values").alias("distinct_estimate"), *quantile)


def candidates(merged: DataFrame, most: int) -> DataFrame:
    """(column_name, value, estimate): the values that the sketches name, at most ``most`` per column."""
    named = F.expr(f"approx_top_k_estimate(frequent, {int(most)})")
    return merged.select("column_name", F.inline(named)).toDF("column_name", "value", "estimate").where("value IS NOT NULL")


def exact_counts(df: DataFrame, values: Sequence[tuple[str, str]]) -> DataFrame:
    """AGG17 for given (column_name, value) pairs: the exact number of rows of each, 0 included. One
    pass; each task sends at most one row per pair."""
    spark = df.sparkSession
    known = local_table(spark, values, "column_name string, value string")
    asked: dict[str, list[str]] = {}
    for c, v in values:
        asked.setdefault(c, []).append(v)
    if not asked:
        return known.withColumn("row_count", F.lit(0).cast("bigint"))
    cells = []
    for c, texts in asked.items():
        text = f"CAST({sql.name(c)} AS STRING)"
        cells.append({"column_name": sql.literal(c), "value": f"CASE WHEN {sql.in_list(text, texts)} THEN {text} END"})
    hits = df.selectExpr(sql.rows(cells)).where("value IS NOT NULL").groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("row_count"))
    return known.join(hits, ["column_name", "value"], "left").select(
        "column_name", "value", F.coalesce("row_count", F.lit(0)).alias("row_count"))


def frequent_values(df: DataFrame, merged: DataFrame, share: float) -> DataFrame:
    """Every value with at least ``share`` of its column's rows, and its exact number of rows.

    ``share`` must be well over the sketches' error; at most 1 / ``share`` values of a column qualify,
    and a few times as many candidates reach the driver.
    """
    if share < 20 / TRACKED:
        raise ValueError(f"a share under {20 / TRACKED} is beyond the sketches")
    most = int(2 / share) + 1
    found = candidates(merged, most).collect()
    totals = {r["column_name"]: r["row_count"] for r in merged.select("column_name", "row_count").collect()}
    likely = [(r["column_name"], r["value"]) for r in found if r["estimate"] >= share / 2 * totals[r["column_name"]]]
    counts = exact_counts(df, likely)
    rows = local_table(df.sparkSession, list(totals.items()), "column_name string, total bigint")
    return counts.join(rows, "column_name").where(F.col("row_count") >= F.lit(share) * F.col("total")).drop("total")


class ProfileStore:
    """States on disk, one partition per part: profiling a part again replaces its state alone."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, state: DataFrame) -> None:
        (
            state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("part").parquet(self.path)
        )

    def states(self) -> DataFrame:
        try:
            return self.spark.read.schema(STATE).parquet(self.path)
        except AnalysisException:  # nothing was profiled yet
            return self.spark.createDataFrame([], STATE)

    def parts(self) -> list[str]:
        return sorted(r["part"] for r in self.states().select("part").distinct().collect())

    def add_new(self, df: DataFrame, columns: Sequence[str], part: Column | str) -> None:
        """Profile the parts of ``df`` that have no state yet. The list of parts is the driver's, as a
        list of files is; rows of known parts are filtered before anything is computed."""
        column = (F.col(part) if isinstance(part, str) else part).cast("string")
        known = self.parts()
        fresh = df.where(~column.isin(known)) if known else df
        self.put(profile_state(fresh, columns, column))

    def merged(self) -> DataFrame:
        return merged_state(self.states())
