"""Suffix ranks by distributed prefix doubling.

A sequence table has one row per symbol: the columns that identify the sequence, ``pos`` (from 0,
without gaps) and ``sym``. The rank of a suffix at depth h orders all suffixes by their first h
symbols; suffixes of equal rank agree on them, so they form one interval of the suffix array
whose longest common prefixes are h or more. Ranks at depth 2h come from the pairs
(rank of i, rank of i + h) at depth h, as in prefix doubling.

Per round the suffixes move twice: by sequence (to see rank i + h) and by pair (to take the new
rank). The distinct pairs are counted with partial aggregation before they move, so a pair that
holds a third of all suffixes is one row per task; only pairs that occur twice or more are sorted
for their rank, each once, so a hot pair never fills a range of the sort. Suffixes whose rank is
theirs alone repeat nowhere and are discarded, with everything that would have to contain them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import staged


def _repeated(pairs: DataFrame, owner: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The keys ``by`` that stand at two places or more. A place is told by its hash, so that the
    partial aggregates are two numbers."""
    place = F.xxhash64(*owner, "pos")
    return (
        pairs.groupBy(*by).agg(F.min(place).alias("_a"), F.max(place).alias("_b"))
        .where(F.col("_a") != F.col("_b")).select(*by)
    )


def suffix_ranks(sequences: DataFrame, owner: Sequence[str], depth: int) -> DataFrame:
    """(owner..., pos, rank) of all suffixes that agree with another one in their first ``depth``
    symbols; equal ranks are one interval of the suffix array, and ranks grow along it.

    The depths 1, 2, 4, ... and ``depth`` are passed through. Sequences are told apart by ``owner``;
    rows that repeat one (owner, pos) count as the same suffix. An empty table gives an empty one.
    """
    return suffix_levels(sequences, owner, depth)[depth]


def suffix_levels(sequences: DataFrame, owner: Sequence[str], depth: int) -> dict[int, DataFrame]:
    """The ranks at depths 1, 2, 4, ... and ``depth``. Keys that repeat are staged before rows meet them, so
    that both sides of the join come from a shuffle and a hot key's rows can be divided."""
    # at depth 1 a symbol is its own rank
    repeated = staged(_repeated(sequences, owner, ["sym"]), "repeated")
    level = staged(sequences.join(repeated, "sym").select(
        *owner, "pos", F.col("sym").alias("rank")), "suffixes")
    h, levels = 1, {1: level}
    while h < depth:
        ahead = min(h, depth - h)
        there = Window.partitionBy(*owner).orderBy("pos").rangeBetween(ahead, ahead)
        pairs = (
            level.select(*owner, "pos", F.col("rank").alias("head"), F.first("rank").over(there).alias("tail"))
            .where(F.col("tail").isNotNull())
        )
        # ranges of a sorted table are numbered in order, so the row numbers grow with the key
        ranks = staged(_repeated(pairs, owner, ["head", "tail"]).orderBy("head", "tail").withColumn(
            "rank", F.monotonically_increasing_id()), "ranks")
        level = staged(pairs.join(ranks, ["head", "tail"]).select(*owner, "pos", "rank"), "suffixes")
        h += ahead
        levels[h] = level
    return levels


def null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null ids equal each other; the columns ``on`` stand once."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return left.join(renamed, same, how).drop(*[f"_right_{c}" for c in on])


def repeated_windows(levels: dict[int, DataFrame], owner: Sequence[str], windows: DataFrame) -> DataFrame:
    """(owner..., pos, length, rank) of the windows (owner..., pos, length) whose symbols stand elsewhere as
    well; windows of equal length and rank are equal. ``levels`` are the ranks of :func:`suffix_levels`, up
    to the greatest power of two that is no longer than the longest window.

    A window of any length is told by two ranks: that of its first 2^k symbols and that of its last, 2^k
    being the greatest power not over the length.
    """
    out = None
    for h in sorted(levels):
        mine = windows.where((F.col("length") >= h) & (F.col("length") < 2 * h))
        head = levels[h].dropDuplicates([*owner, "pos"]).withColumnRenamed("rank", "head")
        tail = head.select(*owner, F.col("pos").alias("_end"), F.col("head").alias("tail"))
        met = null_safe(mine, head, [*owner, "pos"]).withColumn("_end", F.col("pos") + F.col("length") - h)
        met = null_safe(met, tail, [*owner, "_end"])
        pairs = met.select(*owner, "pos", "length", "head", "tail")
        out = pairs if out is None else out.unionByName(pairs)
    found = staged(out, "windows")
    twice = staged(_repeated(found, owner, ["length", "head", "tail"]).withColumn(
        "rank", F.monotonically_increasing_id()), "ranks")
    return found.join(twice, ["length", "head", "tail"]).select(*owner, "pos", "length", "rank")


def later_windows(windows: DataFrame, owner: Sequence[str]) -> DataFrame:
    """The maximal runs covered by windows (see :func:`repeated_windows`) that also start earlier: (owner...,
    runs array<struct<start, end>>), end exclusive; windows that overlap or touch join into one run."""
    place = F.struct(*owner, "pos")
    first = staged(windows.groupBy("rank").agg(F.min(place).alias("first")), "first")
    later = windows.join(first, "rank").where(place != F.col("first")).select(
        *owner, F.col("pos").alias("start"), (F.col("pos") + F.col("length")).alias("end"))
    # a run begins where all windows before it have ended
    order = Window.partitionBy(*owner).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = later.withColumn("new", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    run = begun.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy(*owner, "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).groupBy(*owner).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))


def later_runs(level: DataFrame, owner: Sequence[str], depth: int) -> DataFrame:
    """Maximal runs of positions covered by windows of ``depth`` symbols that also start earlier.

    One row per sequence: (owner..., runs array<struct<start, end>>), end exclusive. The windows
    of an interval other than its first are the later copies; windows that overlap or touch join
    into one run.
    """
    last = F.size("at") - 1
    place = F.struct(*owner, "pos")
    first = staged(level.groupBy("rank").agg(F.min(place).alias("first")), "first")
    return (
        level.join(first, "rank").where(place != F.col("first"))
        .groupBy(*owner).agg(F.array_sort(F.collect_set("pos")).alias("at"))
        # a run begins where the window before it ends earlier, and ends where the next begins later
        .select(
            *owner,
            F.filter("at", lambda p, i: (i == 0) | (F.get("at", i - 1) + depth < p)).alias("start"),
            F.transform(
                F.filter("at", lambda p, i: (i == last) | (F.get("at", i + 1) > p + depth)),
                lambda p: p + depth).alias("end"),
        )
        .select(*owner, F.arrays_zip("start", "end").alias("runs"))
    )
