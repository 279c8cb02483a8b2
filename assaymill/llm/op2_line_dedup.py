"""Line dedup: repeated runs of lines, found in the suffix array over line-id sequences.

Texts are split at ``\\n``. Lines without a word take no part: they are never deleted and don't
interrupt a run. Every other line becomes its 64-bit hash, and a document the sequence of these.
:mod:`suffixes` ranks the suffixes by prefix doubling; suffixes of equal rank at depth
``min_lines`` are the intervals whose longest common prefixes reach that depth, which is all that
decides what is deleted (deeper intervals lie inside them). In each interval the least
(doc_id, text hash, position) stays; the other windows are later copies, and overlapping copies
join into maximal runs. A single line of ``long_line`` words or more is a run by itself.

Or a run is told by its words: with ``min_words`` any number of lines that repeat go, if they have so many
words together. From every line on, and up to every line, the fewest lines with ``min_words`` are a window;
the ranks at depths 1, 2, 4, ... tell which windows repeat, and a maximal repeated run is the union of its windows. A window
has at most ``min_words`` lines, as every line has a word.

Defined results: null text gives no lines and stays null; an empty text stays empty; rows that
repeat doc_id and text are one document, kept as many times as they were given; null doc_id sorts
first; an empty table gives an empty table. Very long texts are split into lines whole; one document's
lines are walked in one task. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import staged
from .suffixes import later_runs, later_windows, null_safe, repeated_windows, suffix_levels, suffix_ranks

OWNER = ["doc", "copy"]
_WORD = re.compile(r"[^\x20\x09-\x0D]")


def _key(id_col: str, text_col: str):
    """What tells documents apart: the id, and the text's hash for ids that are not unique."""
    return (F.col(id_col).alias("doc"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.col(text_col).isNull()).alias("copy"))


def line_sequences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, copy, pos, sym, n_words) of every line with a word; ``pos`` counts such lines only."""
    lines = F.filter(F.split(F.col(text_col), "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    return (
        docs.select(*_key(id_col, text_col), F.posexplode(lines).alias("pos", "line"))
        .select(*OWNER, "pos", F.xxhash64("line").alias("sym"),
                F.size(F.split(F.trim(F.regexp_replace("line", r"[\x20\x09-\x0D]+", " ")), " "))
                .alias("n_words"))
    )


def repeated_runs(
    docs: DataFrame, min_lines: int = 3, long_line: int = 20,
    id_col: str = "doc_id", text_col: str = "text", min_words: int | None = None,
) -> DataFrame:
    """(doc, copy, runs): per document the maximal runs [start, end) of lines to delete, counted
    over its lines with a word. Documents without such a run are not listed."""
    lines = staged(line_sequences(docs, id_col, text_col), "lines")
    if min_words:
        levels = suffix_levels(lines.drop("n_words"), OWNER, 1 << (min_words.bit_length() - 1))
        # a window that repeats consists of lines that do
        able = null_safe(lines, levels[1].select(*OWNER, "pos").distinct(), [*OWNER, "pos"], "left_semi").dropDuplicates([*OWNER, "pos"])
        return later_windows(repeated_windows(levels, OWNER, worded_windows(able, min_words)), OWNER)
    runs = later_runs(suffix_ranks(lines.drop("n_words"), OWNER, min_lines), OWNER, min_lines)
    if long_line and min_lines > 1:
        long_lines = suffix_ranks(
            lines.where(F.col("n_words") >= long_line).drop("n_words"), OWNER, 1)
        runs = runs.unionByName(later_runs(long_lines, OWNER, 1))
    return runs.groupBy(*OWNER).agg(F.flatten(F.collect_list("runs")).alias("runs"))


def worded_windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc, copy, pos, length): from each of the given lines on, and up to each, the fewest lines with
    ``min_words`` words together; none where the lines that follow one another have no more. Every
    repeated run of so many words is the union of those inside it: what no window from a line on
    covers, the one up to the run's last line does."""
    of_text = Window.partitionBy(*OWNER).orderBy("pos")
    # lines that follow one another have the same difference of place and number
    numbered = lines.withColumn("island", F.col("pos") - F.row_number().over(of_text))
    order = Window.partitionBy(*OWNER, "island").orderBy("pos")
    # every line has a word, so a window has at most ``min_words`` lines
    total = F.sum("n_words").over(order.rowsBetween(Window.unboundedPreceding, 0))
    summed = numbered.select(*OWNER, "island", "pos", "n_words", total.alias("total"))
    around = summed.select(
        *OWNER, "pos", "total", (F.col("total") - F.col("n_words")).alias("before"),
        F.collect_list("total").over(order.rowsBetween(0, min_words - 1)).alias("ahead"),
        F.collect_list(F.col("total") - F.col("n_words")).over(order.rowsBetween(1 - min_words, 0)).alias("back"))
    both = around.select(
        *OWNER, "pos", F.size("ahead").alias("n_ahead"), F.size("back").alias("n_back"),
        (F.size(F.filter("ahead", lambda t: t - F.col("before") < min_words)) + 1).alias("ahead"),
        (F.size(F.filter("back", lambda t: F.col("total") - t < min_words)) + 1).alias("back"))
    return both.where("ahead <= n_ahead").select(*OWNER, "pos", F.col("ahead").alias("length")).unionByName(
        both.where("back <= n_back").select(*OWNER, (F.col("pos") - F.col("back") + 1).alias("pos"), F.col("back").alias("length"))).distinct()


def dedup_lines(
    docs: DataFrame, min_lines: int = 3, long_line: int = 20,
    id_col: str = "doc_id", text_col: str = "text", min_words: int | None = None,
) -> DataFrame:
    """Every row of ``docs`` as ``row``, with the text that is left as ``text``, how many lines
    with a word it had as ``n_lines``, and how many were deleted as ``n_removed``. ``min_words``, if given,
    stands for ``min_lines`` and ``long_line``."""
    runs = staged(repeated_runs(docs, min_lines, long_line, id_col, text_col, min_words), "runs")
    keyed = docs.select(*_key(id_col, text_col),
                        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # a sort-merge join at every size: the runs grow with the corpus, and so does what they meet
    joined = keyed.join(
        runs.select(F.col("doc").alias("_doc"), F.col("copy").alias("_copy"), "runs").hint("merge"),
        F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("copy") == F.col("_copy")), "left",
    )
    # a filter on the counts would else run the step twice, the second time in a worker of its own
    without = F.pandas_udf(_without_runs, "text string, n_lines long, n_removed long").asNondeterministic()
    cut = joined.select("row", without(F.col(f"row.`{text_col}`"), "runs").alias("cut"))
    return cut.select("row", "cut.*")


def _without_runs(text: pd.Series, runs: pd.Series) -> pd.DataFrame:
    out = []
    for whole, parts in zip(text, runs):
        if whole is None:
            out.append((None, 0, 0))
            continue
        lines = whole.split("\n")
        worded = [i for i, line in enumerate(lines) if _WORD.search(line)]
        gone = set()
        for run in parts if parts is not None else ():
            gone.update(worded[run["start"]:run["end"]])
        kept = whole if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((kept, len(worded), len(gone)))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_removed"])
