"""Mixing sources to target weights by hierarchical budgeting.

A tree of domains, languages and sources carries integer weights. The token budget goes down the
tree: at each node it is split by weight among the children, and a child that can't use its share
(its subtree holds fewer tokens, over all allowed epochs) passes the rest to its siblings; only
what a whole family can't use reaches the parent's siblings. Filling a node's children in the
order of capacity per weight does exactly that, in integers, so nothing depends on rounding.

A leaf takes its budget as a prefix of its token stream: epoch after epoch, each in an order of its
own seeded by (seed, epoch, id). Whole documents are taken, up to the one in which the budget ends.
To find that prefix, a leaf's tokens are counted per slice of the order; only the one slice in which
the budget ends is walked document by document, so a leaf with a third of all rows needs no single
task to hold it.

Weights: children not listed have weight 1; weight 0 takes nothing. The tables of weights are
small by declaration; everything else is a DataFrame.

Defined results: null text has no tokens; documents without tokens cost nothing and are taken with
the leaf's prefix; null domain, language or source is a child of its own; rows that repeat id and
tokens stand side by side in the order, and share their fate unless the budget ends between them; a
budget beyond all capacity takes everything; an empty table gives an empty table. Other columns of
the documents pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import staged, word_count

LEVELS = ("domain", "language", "source")
#: Slices of a leaf's order: the first four hex digits of a hash.
SLICE_DIGITS = 4


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    cases = [x for name, w in weights.items() for x in (F.lit(name), F.lit(int(w)))]
    known = F.create_map(*cases)[F.col(level)] if cases else F.lit(None).cast("int")
    return F.coalesce(known, F.lit(1)).cast("bigint")


def _split(children: DataFrame, parents: list[str], level: str) -> DataFrame:
    """Adds ``budget`` of each child to (parents..., level, weight, capacity, family_budget).

    Children are filled in the order of capacity per weight. Before child i the filled ones used
    ``used`` and weights ``open`` are left; it is filled too if its capacity is at most its share
    of what is left. From the first that is not, all get their share of the same rest.
    """
    # parts of a family are ordered by capacity/weight as a decimal with twelve places; ties by name
    ratio = F.col("capacity").cast("decimal(38,12)") / F.col("weight")
    order = Window.partitionBy(*parents).orderBy(ratio.asc_nulls_last(), F.col(level).asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    state = children.where(F.col("weight") > 0).select(
        "*", F.coalesce(F.sum("capacity").over(before), F.lit(0)).alias("used"), F.sum("weight").over(after).alias("open"),
        F.row_number().over(order).alias("place"))
    fits = F.col("capacity") * F.col("open") <= F.col("weight") * (F.col("family_budget") - F.col("used"))
    state = state.withColumn("short", F.min(F.when(~fits, F.col("place"))).over(Window.partitionBy(*parents)))
    family = Window.partitionBy(*parents)
    at_short = F.col("place") == F.col("short")
    state = state.select(
        "*", F.max(F.when(at_short, F.col("family_budget") - F.col("used"))).over(family).alias("rest"),
        F.max(F.when(at_short, F.col("open"))).over(family).alias("shares"))
    filled = F.col("short").isNull() | (F.col("place") < F.col("short"))
    return state.withColumn("budget", F.when(filled, F.col("capacity")).otherwise(F.expr("(weight * rest) div shares"))).drop(
        "used", "open", "place", "short", "rest", "shares", "family_budget")


def leaf_budgets(leaves: DataFrame, budget: int | Column, max_epochs: int, weights: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """(domain, language, source, tokens, budget) from (domain, language, source, tokens); ``budget``
    is a number, or a column over the tree's ``tokens`` per domain."""
    sized = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    tree = None
    for depth, level in enumerate(LEVELS):
        path, parents = list(LEVELS[: depth + 1]), list(LEVELS[:depth])
        nodes = sized.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", _weight(level, weights.get(level, {})))
        if tree is None:
            nodes = nodes.withColumn("family_budget", (budget if isinstance(budget, Column) else F.lit(int(budget))).cast("bigint"))
        else:
            above = tree.select(*[F.col(p).alias(f"_{p}") for p in parents], F.col("budget").alias("family_budget"))
            same = F.lit(True)
            for p in parents:
                same = same & F.col(p).eqNullSafe(F.col(f"_{p}"))
            nodes = nodes.join(above, same).drop(*[f"_{p}" for p in parents])
        tree = _split(nodes, parents or [F.lit(0)], level)
    return tree.select(*LEVELS, "tokens", "budget")


def place_in_epoch(seed: int, epoch: Column, key: Column) -> Column:
    """A document's place in the order of an epoch: a hash of seed, epoch and id, as hex."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key))


def share_of_corpus(percent: int) -> Column:
    """A budget: this part of all tokens. There are as many rows here as domains."""
    return F.expr(f"sum(tokens) OVER () * {int(percent)} div 100")


def mix(docs: DataFrame, budget: int | Column, domain: Column, weights: Mapping[str, Mapping[str, int]], max_epochs: int = 1,
        seed: int = 1, tokens: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        language_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(row, domain, language, source, tokens, epoch): the documents that make up the mixture, one row
    for each epoch they are taken in; ``row`` holds all columns of ``docs``."""
    tokens = word_count(F.col(text_col)) if tokens is None else tokens
    listed = docs.select(
        domain.cast("string").alias("domain"), F.col(language_col).cast("string").alias("language"),
        F.col(source_col).cast("string").alias("source"), tokens.cast("bigint").alias("tokens"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    counts = listed.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    leaves = staged(leaf_budgets(counts, budget, max_epochs, weights).select(
        *LEVELS, F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).cast("int").alias("full_epochs"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).alias("rest")), "leaves")

    def of_leaf(df: DataFrame, other: DataFrame) -> DataFrame:
        same = F.lit(True)
        for level in LEVELS:
            same = same & F.col(level).eqNullSafe(F.col(f"_{level}"))
        return df.join(other.withColumnsRenamed({x: f"_{x}" for x in LEVELS}), same).drop(*[f"_{x}" for x in LEVELS])

    # leaves are as many as the tree declares: Spark broadcasts them once it has measured that
    mine = of_leaf(listed, leaves)
    whole = mine.where(F.col("full_epochs") > 0).select(
        "row", *LEVELS, "tokens", F.explode(F.sequence(F.lit(0), F.col("full_epochs") - 1)).alias("epoch"))
    last = mine.where(F.col("rest") > 0).withColumn(
        "place", place_in_epoch(seed, F.col("full_epochs"), F.col("key"))).withColumn("slice", F.substring("place", 1, SLICE_DIGITS))
    slices = last.groupBy(*LEVELS, "slice").agg(F.sum("tokens").alias("in_slice"), F.first("rest").alias("rest"))
    before = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begun = slices.withColumn("begin", F.coalesce(F.sum("in_slice").over(before), F.lit(0)))
    # per leaf the slice in which its rest ends: the last one that begins before it
    ends = staged(begun.where(F.col("begin") < F.col("rest")).groupBy(*LEVELS).agg(
        F.max("slice").alias("end_slice"), F.max_by("begin", "slice").alias("begin"), F.first("rest").alias("rest")), "ends")
    cut = of_leaf(last.drop("rest"), ends)
    inside = cut.where(F.col("slice") < F.col("end_slice"))
    walk = Window.partitionBy(*LEVELS).orderBy("place", "key", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    edge = cut.where(F.col("slice") == F.col("end_slice")).withColumn(
        "start", F.col("begin") + F.coalesce(F.sum("tokens").over(walk), F.lit(0))).where(F.col("start") < F.col("rest"))
    columns = ["row", *LEVELS, "tokens", F.col("full_epochs").alias("epoch")]
    return whole.unionByName(inside.select(*columns)).unionByName(edge.select(*columns))

