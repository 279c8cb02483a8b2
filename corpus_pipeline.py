"""A corpus from documents in five stages: each reads what the one before kept and wrote.

1. toxicity: documents that the classifier rejects go; 2. lines: later copies of repeated line runs
go, and documents of which nothing is left; 3. copies: one document of each component of near copies (five words, 0.8) stays;
4. mixture: the documents that fill the target weights of the tree of domains, languages and
sources, each at most once; 5. packing: the tokens of what is left, in sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.llm import op1_ngram_join, op2_line_dedup, op6_mixing, op7_toxicity, op9_packing
from assaymill.llm.queries import DOMAIN, WEIGHTS, tokenizer_path
from assaymill.llm.shared import ship, table
from assaymill.sources.staging import staging_root

#: No SQL for a trained classifier and a tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents with a score under 0.7; learns from no held-out label."""
    ship(spark)
    classifier = op7_toxicity.train(docs, table(spark, sf_dir, "labels"), ~op7_toxicity.held_out(F.col("doc_id")))
    return op7_toxicity.score(docs, classifier).where(F.col("score") < 0.7).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs of 20 words and more, of any number of lines. A document all of whose lines went goes too; one that
    had no line with a word stays as it is. ``n_chars`` follows the text."""
    ship(spark)
    left = op2_line_dedup.dedup_lines(docs, min_words=20).where((F.col("n_removed") < F.col("n_lines")) | (F.col("n_lines") == 0))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars"))}
    return left.select(*[
        changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed else F.col(f"row.`{c}`") for c in docs.columns])


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of least doc_id. Near copies share
    four fifths of their five-word sequences; op1's query has contracted values of its own."""
    ship(spark)
    return op1_ngram_join.keep_one(docs, n=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Nine tenths of the tokens, divided by weight; one epoch, so that no document is repeated."""
    ship(spark)
    mixed = op6_mixing.mix(docs, op6_mixing.share_of_corpus(90), F.expr(DOMAIN), WEIGHTS, max_epochs=1)
    return mixed.select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their places in sequences of 4096 tokens."""
    ship(spark)
    return op9_packing.tokenize_and_pack(docs, tokenizer_path(), 4096)


STAGES = [("toxicity", toxicity), ("lines", lines), ("copies", copies), ("mixture", mixture), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    folder = f"{staging_root(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}.parquet"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
