"""Staged tables: lineage is cut by writing Parquet to the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..local import local_rows

_SETTING = "spark.checkpoint.dir"


def staging_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, one under the warehouse,
    which executors share as well."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging").rstrip("/")


class Staging:
    """Tables of one run. A staged table survives the loss of executors and is scanned, not
    recomputed, by everything that reads it: with column pruning, pushdown and its row count in
    the file footers."""

    def __init__(self, spark: SparkSession, run_id: str | None = None, root: str | None = None):
        self.spark = spark
        self.run_id = run_id or uuid.uuid4().hex
        self.folder = f"{(root or staging_root(spark)).rstrip('/')}/assaymill-{self.run_id}"

    def put(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def put_bucketed(self, df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
        """Stage ``df`` in buckets of ``keys``, one file each if it is already dealt to them. Buckets are
        known to the session's catalog alone, so the table gets a name there; the files lie with the
        other staged ones."""
        table = f"assaymill_{self.run_id}_{name}"
        (
            df.write.mode("overwrite").option("path", f"{self.folder}/{name}.parquet")
            .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
        )
        return self.spark.table(table)

    def put_observed(
        self, df: DataFrame, name: str, aggregates: Sequence[Column],
        columns: Mapping[str, str] | Sequence[str] | None = None, partition_by: Sequence[str] = (),
    ) -> tuple[DataFrame, DataFrame]:
        """Stage ``df`` and measure it while it is written: the staged table, and one row of
        ``aggregates`` over ``df``. Nothing is scanned for the counts.

        ``columns`` are those to store (all, if not given), or stored names and the columns they are
        made from; the aggregates may read others as well. They stand right under the write, in its
        last stage. There each partition counts once, with the attempt that was the first to succeed:
        attempts that failed, were repeated or ran twice add nothing.
        """
        observation = Observation(f"{name}-{self.run_id}")
        kept = list(df.columns) if columns is None else columns
        pairs = kept.items() if isinstance(kept, Mapping) else [(c, c) for c in kept]
        stored = df.observe(observation, *aggregates).select(*[F.col(f"`{c}`").alias(n) for n, c in pairs])
        staged = self.put(stored, name, partition_by)
        schema = df.limit(0).agg(*aggregates).schema
        return staged, local_rows(self.spark, [[observation.get[f.name] for f in schema]], schema)

    def put_counted(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """Stage ``df``; the staged table and its number of rows, as the write saw them."""
        staged, counts = self.put_observed(df, name, [F.count(F.lit(1)).alias("row_count")])
        return staged, counts.first()["row_count"]
