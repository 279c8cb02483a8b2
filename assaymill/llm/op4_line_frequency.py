"""Quality rules by cross-document line frequency, in built-in functions only.

A line's normal form is lower case, digits as 0, runs of white space as one space, trimmed. A
line that stands in more than ``max_percent`` per cent of a host's documents, and in ``min_docs``
or more, is template text and is removed. A document is rejected if fewer than ``min_words`` words
are left, or less than ``min_left`` per cent of its words. Exact copies of a text count as one
document, else a much copied text would turn into its own template.

One pass over the texts makes a narrow staged row per document: its counts, and per line a 64-bit
key and a word count. Everything later reads only that: distinct (host, line, text) triples are
pre-aggregated before they move, and the lines found frequent come back to the documents by an
equi-join whose hot keys Spark can split.

Defined results: null text has no words and no lines; null host is a host of its own; equal rows
are judged alike and all returned; an empty table gives an empty table; only the named columns are
read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BLANKS, staged

_BLANK_CHARS = " \t\n\x0b\f\r"
WINDOW = 5


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(_BLANK_CHARS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"[{BLANKS}]+"))


def _window_hashes(words: Column) -> Column:
    return F.when(F.size(words) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        # single elements are read in place, where slice() would copy the whole array for each window
        F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW),
                    lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])))


def _covered_words(windows: Column) -> Column:
    """Words in windows whose hash occurs twice or more: each window adds what the next leaves it."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # a lambda's variable holds the sorted array: an expression inside would be computed per element
    flagged = F.flatten(F.transform(F.array(placed), lambda p: F.filter(p, lambda x, i: (
        (F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"])))))
    starts = F.sort_array(F.transform(flagged, lambda x: x["i"]))
    gains = F.flatten(F.transform(F.array(starts), lambda s: F.transform(
        s, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - x, F.lit(WINDOW))))))
    return F.aggregate(gains, F.lit(0), lambda a, x: a + x)


def _normal_lines(text: Column) -> Column:
    """The lines with a word in normal form; blanks that are single spaces already are not touched."""
    digits = F.regexp_replace(F.lower(text), "[0-9]", "0")
    spaced = F.regexp_replace(digits, r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]", " ")
    return F.filter(F.transform(F.split(spaced, "\n", -1), lambda s: F.trim(s)), lambda s: s != "")


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    host_col: str = "source") -> DataFrame:
    """One row per document: its counts, and its lines as array<struct<key, n>>."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(id_col).alias("doc_id"),
        F.xxhash64(F.col(host_col)).alias("host"), F.xxhash64(text).alias("copy"), text.alias("text"),
        _words(text).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda s: F.btrim(s, F.lit(_BLANK_CHARS)) != "").alias("lines"),
        _normal_lines(text).alias("normal"))
    hashed = read.withColumn("windows", _window_hashes(F.col("words")))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    return hashed.select(
        "row_no", "doc_id", "host", "copy",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(repeats, _covered_words(F.col("windows"))).otherwise(0).cast("bigint").alias("n_repeat_words"),
        F.transform("normal", lambda s: F.struct(
            F.xxhash64(s).alias("key"),
            (F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))) + 1).alias("n"))).alias("lines"),
    )


def frequent_lines(counts: DataFrame, min_docs: int, max_percent: float) -> DataFrame:
    """(host, key, n_docs) of the lines in more documents of their host than the limits allow."""
    once = counts.select("host", "copy", F.explode(F.array_distinct("lines.key")).alias("key")).distinct()
    n_docs = once.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= min_docs)
    size = counts.select("host", "copy").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    return (
        n_docs.join(size, "host").where(F.col("n_docs") * 100 > F.col("host_docs") * max_percent)
        .select("host", "key", "n_docs")
    )


def line_frequency_rules(
    docs: DataFrame, min_docs: int = 10, max_percent: float = 1.0, min_left: int = 50, min_words: int = 10,
    id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
) -> DataFrame:
    """Per document the counts, the base rules' verdict, what line removal leaves, and ``kept``."""
    counts = staged(document_counts(docs, id_col, text_col, host_col), "counts")
    frequent = frequent_lines(counts, min_docs, max_percent)
    lines = counts.select("row_no", "host", F.explode("lines").alias("line")).select(
        "row_no", "host", F.col("line.key").alias("key"), F.col("line.n").alias("n"))
    removed = (
        lines.join(frequent.select("host", "key"), ["host", "key"])
        .groupBy("row_no").agg(F.sum("n").alias("n_removed"), F.count(F.lit(1)).alias("n_lines_removed"))
    )
    n_left = F.col("n_words") - F.coalesce("n_removed", F.lit(0))
    base_failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    depleted = (n_left < min_words) | (n_left * 100 < F.col("n_words") * min_left)
    return counts.drop("lines").join(removed, "row_no", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & ~depleted).alias("kept"),
        F.coalesce("n_lines_removed", F.lit(0)).alias("n_lines_removed"), n_left.alias("n_words_left"))
