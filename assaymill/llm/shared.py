"""What the operators of this folder share: table access, staged tables, word handling.

Words are maximal runs of characters other than blank and 0x09-0x0D. ``bytes.split()`` and
``bytes.lower()`` follow exactly that definition (ASCII only), whatever the text's language.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import Staging

#: The separators of words, inside a character class of a regular expression.
BLANKS = r"\x20\x09-\x0D"


#: Rows of an Arrow batch where the session has Spark's default: ten thousand texts are too many to hold.
BATCH_ROWS, _BATCH_KEY, _BATCH_DEFAULT = 2000, "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their Python need not have it. Sessions
    that leave Arrow's batches at Spark's default get smaller ones, as rows are whole texts here."""
    if spark.conf.get(_BATCH_KEY) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, BATCH_ROWS)
    context = spark.sparkContext
    if getattr(context, "_assaymill_sent", False):
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="assaymill-")) / "assaymill.zip"  # read by the driver's own file server
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(path))
    context._assaymill_sent = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, losing executors
    recomputes nothing, and what was not deterministic (row numbers) is fixed from then on."""
    return Staging(df.sparkSession).put(df, name)


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``fn`` over every Arrow batch of ``df``: a narrow step, one batch in memory at a time."""

    def batches(it):
        for batch in it:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(batches, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null gives b''."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def partitions(spark: SparkSession) -> int:
    """How many parts a shuffle is dealt to; set by the user for the size of the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
