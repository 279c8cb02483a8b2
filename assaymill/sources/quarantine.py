"""A CSV scan that parts its records into rows and rejects, in one pass (SRC5, SRC7).

Records are taken as raw lines, so the ones that no parser reads stay whole: what is wrong with a
record, where it stands and its bytes go to a table of their own, and the others are parsed. Nothing
is shuffled, and both sides come from the one write that stages them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..errors import ExtractionError
from ..operators.dedup import ROW_POSITION
from .scan import with_na_tokens_as_null
from .staging import Staging

_QUOTED = r'"(?:[^"]|"")*"'
_BETWEEN = "\x1f"
UNDECODABLE, UNCLOSED, LONG, SHORT = "undecodable", "unclosed quote", "too many fields", "too few fields"


@dataclass
class SplitScan:
    """``rows`` has the columns as text, with the row position; ``rejects`` has file, position, reason
    and record (the bytes as they stand in the file)."""

    rows: DataFrame
    rejects: DataFrame
    accepted: int
    rejected: int


def scan_csv_split(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, on_bad: str = "keep",
    pad_short: bool = False, na_tokens: Sequence[str] = fixed.NA_TOKENS, staging: Staging | None = None,
) -> SplitScan:
    """UTF-8 files of one record per line, parted into rows and rejects.

    ``columns`` names the fields of files without a header; else the header of the first file does, and
    every record equal to it is left out. Blank lines are no records. A record is rejected, for the
    first of these, if it is not valid UTF-8, if a quote stays open, if it has too many fields, or too
    few (``pad_short`` fills them with null instead). ``on_bad="fail"`` raises if any is; the staged
    rejects stay for inspection.
    """
    if on_bad not in ("keep", "fail"):
        raise ValueError(f"on_bad: {on_bad}")
    try:
        lines = spark.read.text(path)
        names = list(columns) if columns is not None else spark.read.option("header", True).option("escape", '"').csv(path).columns
    except AnalysisException as e:
        raise ExtractionError(f"File not found or unreadable: {path} ({str(e).splitlines()[0]})") from e
    if not names:
        raise ExtractionError(f"No columns to read: {path}")
    n = len(names)
    record = F.col("value")
    bare = F.regexp_replace(record, _QUOTED, "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    reason = (
        F.when(~F.is_valid_utf8(record), UNDECODABLE).when(F.contains(bare, F.lit('"')), UNCLOSED)
        .when(fields > n, LONG).when((fields < n) & F.lit(not pad_short), SHORT)
    )
    schema = ", ".join(f"c{i} string" for i in range(n))
    parsed = F.from_csv(F.regexp_replace(record, "^﻿", ""), F.lit(schema), {"escape": '"', "mode": "PERMISSIVE"})
    position = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("row"))
    told = lines.select(position.alias("position"), record, reason.alias("reason")).where(F.trim("value") != "").select(
        "position", "reason", F.when(F.col("reason").isNotNull(), F.col("value").cast("binary")).alias("record"),
        F.when(F.col("reason").isNull(), parsed).alias("fields"))
    if columns is None:
        same = F.concat_ws(_BETWEEN, *[F.coalesce(f"fields.c{i}", F.lit("")) for i in range(n)]) == _BETWEEN.join(names)
        told = told.where(F.col("reason").isNotNull() | ~same)
    staged, counts = (staging or Staging(spark)).put_observed(
        told.withColumn("rejected", F.col("reason").isNotNull()), "records",
        [F.count_if(F.col("reason").isNull()).alias("accepted"), F.count_if(F.col("reason").isNotNull()).alias("rejected"),
         F.min(F.when(F.col("reason").isNotNull(), F.concat_ws(": ", "position.file", "reason"))).alias("first")],
        partition_by=["rejected"])
    found = counts.first()
    if on_bad == "fail" and found["rejected"]:
        raise ExtractionError(f"{path}: {found['rejected']} records cannot be read, the first in {found['first']}")
    rows = staged.where("NOT rejected").select(
        *[F.col(f"fields.c{i}").alias(c) for i, c in enumerate(names)], F.col("position").alias(ROW_POSITION))
    rejects = staged.where("rejected").select(F.col("position.file").alias("file"), "position", "reason", "record")
    return SplitScan(with_na_tokens_as_null(rows, na_tokens), rejects, found["accepted"], found["rejected"])
