"""What is kept of runs: validation events, reports and documents, and their retention (SNK3-SNK7, RPT1).

Below one folder::

    report_type=T/run_id=R/              one report of one run, JSON (see ``write_report``)
    _events/run_id=R/                    a run's validation events, Parquet
    _documents/report_type=T/run_id=R/   a run's nested document, Parquet with a VARIANT column
    _index/run_id=R/                     what a run has in the log, and since when; written last

Whatever a run writes lies in partitions of its own, by dynamic partition overwrite: a run that is
written again replaces itself and nothing else, and runs may be written side by side. A run is in the
log once it is in the index. Readers that list the folder skip names that start with an underscore.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..local import local_table
from ..operators.reports import EVENT_SCHEMA, latest_reports
from .sinks import write_report

#: ``folder`` is where entries of a type lie, below the log's own.
_INDEX = "folder string, report_type string, generated_at timestamp, rows bigint, run_id string"
_DOCUMENTS = "generated_at timestamp, document variant, report_type string, run_id string"
EVENTS_TYPE = "validation_events"


class RunLog:
    """The log below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- writing ----------------------------------------------------------------------------------------

    def _put(self, df: DataFrame, table: str, *by: str) -> int:
        observation = Observation(table)
        (
            df.observe(observation, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by).parquet(f"{self.root}/{table}")
        )
        return observation.get["rows"]

    def append(
        self, run_id: str, events: DataFrame | None = None, reports: Mapping[str, DataFrame] | None = None,
        documents: DataFrame | None = None, generated_at: Column | None = None,
    ) -> None:
        """Write one run: its events, its reports, its documents (run_id, report_type, document)."""
        ts = (F.current_timestamp() if generated_at is None else generated_at).cast("timestamp")
        when = self.spark.range(1).select(ts.alias("t")).first()["t"]
        entries = []
        if events is not None:
            rows = self._put(events.withColumn("run_id", F.lit(run_id)), "_events", "run_id")
            entries.append(("_events", EVENTS_TYPE, when, rows, run_id))
        if documents is not None:
            own = documents.where(F.col("run_id") == run_id)
            types = [r["report_type"] for r in own.select("report_type").distinct().collect()]  # one per kind of document
            self._put(own.select(F.lit(when).alias("generated_at"), "document", "report_type", "run_id"),
                      "_documents", "report_type", "run_id")
            entries += [(_part(self.spark, "_documents/report_type", t), t, when, 1, run_id) for t in sorted(types)]
        for t, df in (reports or {}).items():
            rows = write_report(df, self.root, t, run_id)
            entries.append((_part(self.spark, "report_type", t), t, when, rows, run_id))
        self._put(local_table(self.spark, entries, _INDEX), "_index", "run_id")

    def append_events(self, events: DataFrame, at: str = "event_ts") -> None:
        """Events of any number of runs in one write; a run's newest one dates its entry."""
        self._put(events, "_events", "run_id")
        runs = events.groupBy("run_id").agg(F.max(at).cast("timestamp").alias("generated_at"), F.count(F.lit(1)).alias("rows"))
        self._put(runs.select(F.lit("_events").alias("folder"), F.lit(EVENTS_TYPE).alias("report_type"),
                              "generated_at", "rows", "run_id"), "_index", "run_id")

    # --- reading ----------------------------------------------------------------------------------------

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        except AnalysisException:  # nothing was written yet
            return self.spark.createDataFrame([], schema)

    def index(self) -> DataFrame:
        return self._read("_index", _INDEX)

    def events(self, schema: str = EVENT_SCHEMA) -> DataFrame:
        """Events of the runs in the index; a filter on ``run_id`` reads those partitions alone."""
        known = self.index().where(F.col("report_type") == EVENTS_TYPE).select("run_id")
        return self._read("_events", schema).join(known, "run_id", "left_semi")

    def documents(self) -> DataFrame:
        known = self.index().select("report_type", "run_id")
        return self._read("_documents", _DOCUMENTS).join(known, ["report_type", "run_id"], "left_semi")

    def report(self, report_type: str) -> DataFrame:
        """One report of all runs, without those that found nothing."""
        folder = _part(self.spark, "report_type", report_type)
        return self.spark.read.option("basePath", self.root).json(f"{self.root}/{folder}").where("NOT is_empty").drop("is_empty")

    # --- retention --------------------------------------------------------------------------------------

    def retain(self, keep: int = fixed.REPORTS_KEPT_PER_TYPE) -> DataFrame:
        """SNK7: of each type (reports, documents, events) the newest ``keep`` runs stay, ties by run id;
        the others leave the disk. Only the partitions concerned are touched: their folders go, and
        the index of runs that keep a part of theirs is written anew. The index goes first, so that a
        retention that breaks off leaves folders nobody reads, which the run's next write replaces.

        Gives (report_type, kept, cleaned). The driver walks one line per entry beyond ``keep``.
        """
        index = self.index()
        ranked = latest_reports(index, "report_type", "generated_at", keep, ["run_id"]).select("report_type", "run_id")
        stays = index.join(ranked.withColumn("stays", F.lit(True)), ["report_type", "run_id"], "left").select(
            *index.columns, F.coalesce("stays", F.lit(False)).alias("stays"))
        stats = stays.groupBy("report_type").agg(
            F.count_if("stays").alias("kept"), F.count_if(~F.col("stays")).alias("cleaned")).orderBy("report_type").collect()
        gone = stays.where("NOT stays").select("folder", "run_id").collect()
        touched = sorted({r["run_id"] for r in gone})
        if gone:
            left = stays.where(F.col("stays") & F.col("run_id").isin(touched)).select(*index.columns).collect()
            ended = sorted(set(touched) - {r["run_id"] for r in left})
            if left:
                self._put(local_table(self.spark, left, _INDEX), "_index", "run_id")
            self._remove(("_index", r) for r in ended)
            self._remove((r["folder"], r["run_id"]) for r in gone)
        return local_table(self.spark, stats, "report_type string, kept bigint, cleaned bigint")

    def _remove(self, partitions: Iterable[tuple[str, str]]) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for folder, run_id in partitions:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}/{_part(self.spark, 'run_id', run_id)}")
            path.getFileSystem(conf).delete(path, True)


def _part(spark: SparkSession, column: str, value: str) -> str:
    """The folder of a partition, with the escapes of Spark's writers."""
    return f"{column}={spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)}"
