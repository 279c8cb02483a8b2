"""Scans (SRC1-SRC8): CSV and Parquet into all-text or typed tables with a row position."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fixed
from .. import sqltext as sql
from ..errors import ExtractionError
from ..operators.dedup import ROW_POSITION

_BROKEN = "_broken_record"
_QUOTED = r'"[^"]*"'


def with_na_tokens_as_null(df: DataFrame, tokens: Sequence[str] = fixed.NA_TOKENS) -> DataFrame:
    """SRC6: texts that mean "no value" become null in every text column, in one projection."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({
        c: F.expr(f"CASE WHEN NOT {sql.in_list(sql.name(c), tokens)} THEN {sql.name(c)} END")
        for c in texts
    }) if texts and tokens else df


def _position() -> Column:
    """Where a row stands in its source: a total order that does not depend on the partitioning.

    File and block come from the scan; within a block the rows of a task are numbered in order.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(ROW_POSITION)


#: Bytes of a split where the session has Spark's default: that many packed numbers become ten million wide
#: rows of texts, which no task sorts in memory.
SPLIT_BYTES, _SPLIT_KEY, _SPLIT_DEFAULT = "16m", "spark.sql.files.maxPartitionBytes", "134217728b"


def spread(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Share the rows of a scan over ``tasks`` tasks, if the caller asks for it.

    Meant for inputs that cannot be split (one row group, a multi-line file) in front of heavy
    per-row work. Without ``tasks`` the session's ``assaymill.scan.tasks`` decides; unset, nothing is
    shuffled, and large inputs come in splits of ``SPLIT_BYTES``, which bounds a task's rows whatever the
    input; sessions that set ``spark.sql.files.maxPartitionBytes`` keep their own.
    """
    session = df.sparkSession
    if session.conf.get(_SPLIT_KEY) == _SPLIT_DEFAULT:
        session.conf.set(_SPLIT_KEY, SPLIT_BYTES)
    tasks = tasks or int(session.conf.get("assaymill.scan.tasks", "0"))
    return df.repartition(tasks) if tasks else df


def _missing(path: str, error: Exception) -> ExtractionError:
    return ExtractionError(f"File not found or unreadable: {path} ({str(error).splitlines()[0]})")


def _files_by_encoding(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Encoding -> files: Latin-1 for the files that are not valid UTF-8, from one aggregate over the
    raw lines. One row per file reaches the driver, which has listed the files already."""
    per_file = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count_if(~F.is_valid_utf8("value")).alias("bad"))
    found: dict[str, list[str]] = {}
    for row in sorted(per_file.collect()):
        found.setdefault("ISO-8859-1" if row["bad"] else "UTF-8", []).append(row["file"])
    return found or {"UTF-8": [path]}


def scan_csv(
    spark: SparkSession, path: str, encoding: str | None = None, multiline: bool = False,
    na_tokens: Sequence[str] = fixed.NA_TOKENS, with_position: bool = True,
) -> DataFrame:
    """SRC1-SRC7: a CSV file or directory with a header; every column is text.

    * Encoding (SRC4): told per file, UTF-8, or Latin-1 if its bytes are not valid UTF-8. That reads
      the lines once; give ``encoding`` to skip it on large inputs.
    * ``multiline`` for records over several lines: such a file cannot be split.
    * Rows with too few fields are padded with null; a row with too many fails the job (SRC7).
    """
    try:
        files = {encoding: [path]} if encoding else _files_by_encoding(spark, path)
    except AnalysisException as e:
        raise _missing(path, e) from e
    parts = [_scan_files(spark, names, path, e, multiline, with_position) for e, names in files.items()]
    if not parts:
        raise ExtractionError(f"No columns to read: {path}")
    return with_na_tokens_as_null(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), na_tokens)


def _scan_files(
    spark: SparkSession, files: Sequence[str], path: str, encoding: str, multiline: bool, with_position: bool,
) -> DataFrame:
    try:
        reader = (
            spark.read.option("header", True).option("escape", '"')
            .option("encoding", encoding).option("multiLine", multiline)
        )
        names = reader.csv(list(files)).columns
    except AnalysisException as e:
        raise _missing(path, e) from e
    if not names:
        raise ExtractionError(f"No columns to read: {path}")
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in [*names, _BROKEN]]
    )
    raw = (
        reader.schema(schema).option("enforceSchema", False).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BROKEN)
        # a pruned parse does not count the fields of a record
        .option("columnPruning", False).csv(list(files))
    )
    # Separators outside quotes; only evaluated for records whose field count is off.
    bare = F.regexp_replace(_BROKEN, _QUOTED, "")
    too_long = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) >= len(names)
    message = F.concat(
        F.lit(f"{path}: more than {len(names)} fields in record: "), F.col(_BROKEN),
        # names a data column, as Spark does not scan for the broken record alone
        F.coalesce(F.substring(F.col(f"`{names[0]}`"), 1, 0), F.lit("")),
    )
    checked = raw.filter(
        F.when(F.col(_BROKEN).isNotNull() & too_long, F.raise_error(message).cast("boolean"))
        .otherwise(F.lit(True))
    )
    columns = [F.col(f"`{c}`") for c in names] + ([_position()] if with_position else [])
    return checked.select(*columns)


def scan_parquet(
    spark: SparkSession, path: str, na_tokens: Sequence[str] = (), with_position: bool = False,
) -> DataFrame:
    """A typed table; pushdown and pruning work as usual. NaN is left to the operators."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        raise _missing(path, e) from e
    if with_position:
        df = df.select(*[F.col(f"`{c}`") for c in df.columns], _position())
    return with_na_tokens_as_null(df, na_tokens)


def scan(spark: SparkSession, path: str, **options) -> DataFrame:
    """By file ending: Parquet, else CSV."""
    if path.rstrip("/").endswith(".parquet"):
        return scan_parquet(spark, path, with_position=True, **options)
    return scan_csv(spark, path, **options)


def _extract(kind: str):
    def extract(spark: SparkSession, path: str, **options) -> DataFrame:
        try:
            return scan(spark, path, **options)
        except ExtractionError as e:
            raise ExtractionError(f"Failed to extract {kind}: {e}") from e

    extract.__name__ = f"extract_{kind}"
    extract.__doc__ = f"Scan the {kind} source."
    return extract


# Any callable (spark, path) -> DataFrame can stand in for these (SRC8).
extract_projects = _extract("projects")
extract_subjects = _extract("subjects")
extract_results = _extract("results")
