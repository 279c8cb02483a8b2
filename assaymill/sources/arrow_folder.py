"""Sources and sinks of one's own, as Spark data sources (SRC8, SNK6): a folder of Arrow files.

``assaymill_arrow`` shows what a custom source and sink need, and is one. A write leaves one Arrow file
per task under names that nobody reads yet; when all tasks are done, the driver writes a manifest that
names the files of the table. So readers see all of a write or nothing of it, repeated and failed
tasks leave no rows, and an aborted write removes its files. A write lasts as long as its mark stands in the
folder: tasks that Spark is still ending when the driver has cleaned up leave no file. Reads are planned from the manifest:
files become partitions of about ``rows_per_partition`` rows, and filters on columns whose least and
greatest values the manifest keeps skip whole files.

    register_sources(spark)
    df.write.format("assaymill_arrow").mode("append").save(folder)
    spark.read.format("assaymill_arrow").load(folder)

Folders are reached through Arrow's file systems (local, HDFS, S3, GCS), from the driver and from the
executors.
"""

from __future__ import annotations

import contextlib
import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual,
    InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "assaymill_arrow"
_MANIFEST = "_manifest.json"
_ROWS = 500_000


def _located(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def read_manifest(path: str) -> dict | None:
    """{"schema": ..., "files": [{"name", "rows", "least", "greatest"}]}; None where no write was committed."""
    system, root = _located(path)
    name = f"{root.rstrip('/')}/{_MANIFEST}"
    if system.get_file_info(name).type == fs.FileType.NotFound:
        return None
    with system.open_input_stream(name) as stream:
        return json.loads(stream.read())


def _write_manifest(path: str, manifest: dict) -> None:
    """Replaces the manifest in one step, by a rename where the file system has one."""
    system, root = _located(path)
    new = f"{root.rstrip('/')}/{_MANIFEST}.{uuid.uuid4().hex}"
    with system.open_output_stream(new) as stream:
        stream.write(json.dumps(manifest).encode())
    system.move(new, f"{root.rstrip('/')}/{_MANIFEST}")


def _remove(path: str, names: Sequence[str]) -> None:
    system, root = _located(path)
    for name in names:
        if system.get_file_info(f"{root.rstrip('/')}/{name}").type != fs.FileType.NotFound:
            with contextlib.suppress(FileNotFoundError):  # a task and the driver may remove the same file
                system.delete_file(f"{root.rstrip('/')}/{name}")


@dataclass
class WrittenFile(WriterCommitMessage):
    name: str
    rows: int
    least: dict
    greatest: dict


@dataclass
class Files(InputPartition):
    names: list[str]


def _bounds(table: pa.Table) -> tuple[dict, dict]:
    """Least and greatest values of the whole-number and text columns that have any."""
    least, greatest = {}, {}
    for field in table.schema:
        if pa.types.is_integer(field.type) or pa.types.is_string(field.type):
            low, high = pc.min_max(table.column(field.name)).as_py().values()
            if low is not None:
                least[field.name], greatest[field.name] = low, high
    return least, greatest


class ArrowFolderWriter(DataSourceArrowWriter):
    """One file per task that has rows, of record batches as they come. Bounds are kept per file."""

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite
        self.write_id = uuid.uuid4().hex
        self.mark = f"_open-{self.write_id}"

    def begin(self) -> ArrowFolderWriter:
        system, root = _located(self.path)
        system.create_dir(root, recursive=True)
        system.open_output_stream(f"{root.rstrip('/')}/{self.mark}").close()
        return self

    def _drop_if_ended(self, name: str) -> None:
        """A write that has ended takes no more files."""
        system, root = _located(self.path)
        if system.get_file_info(f"{root.rstrip('/')}/{self.mark}").type == fs.FileType.NotFound:
            _remove(self.path, [name])
            raise RuntimeError(f"the write {self.write_id} has ended")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        task = TaskContext.get()
        name = f"part-{self.write_id}-{task.partitionId():05d}-{task.taskAttemptId()}.arrow"
        system, root = _located(self.path)
        system.create_dir(root, recursive=True)
        rows, least, greatest, sink, writer = 0, {}, {}, None, None
        try:
            for batch in iterator:
                if writer is None:
                    self._drop_if_ended(name)
                    sink = system.open_output_stream(f"{root.rstrip('/')}/{name}")
                    writer = pa.ipc.new_file(sink, batch.schema)
                    self._drop_if_ended(name)
                writer.write_batch(batch)
                rows += batch.num_rows
                low, high = _bounds(pa.Table.from_batches([batch]))
                for c in low:
                    least[c] = min(low[c], least.get(c, low[c]))
                    greatest[c] = max(high[c], greatest.get(c, high[c]))
        finally:
            if writer is not None:
                writer.close()
                sink.close()
                self._drop_if_ended(name)  # some stores show a file only once it is closed
        return WrittenFile(name if writer is not None else "", rows, least, greatest)

    def commit(self, messages: list[WrittenFile | None]) -> None:
        new = [{"name": m.name, "rows": m.rows, "least": m.least, "greatest": m.greatest} for m in messages if m and m.name]
        before = read_manifest(self.path) or {"files": []}
        system, root = _located(self.path)
        system.create_dir(root, recursive=True)
        old = [] if self.overwrite else before["files"]
        _write_manifest(self.path, {"schema": self.schema.jsonValue(), "files": old + new})
        self._clean(keep={f["name"] for f in old + new}, drop=[f["name"] for f in before["files"]] if self.overwrite else [])

    def abort(self, messages: list[WrittenFile | None]) -> None:
        self._clean(keep=set(), drop=[])

    def _clean(self, keep: set[str], drop: list[str]) -> None:
        """End the write; remove what attempts of it left and nobody committed, and what an overwrite replaced."""
        system, root = _located(self.path)
        if system.get_file_info(root).type == fs.FileType.NotFound:
            return
        _remove(self.path, [self.mark])
        left = [f.base_name for f in system.get_file_info(fs.FileSelector(root))
                if f.base_name.startswith(f"part-{self.write_id}-") and f.base_name not in keep]
        _remove(self.path, left + drop)


_KEPT = {
    EqualTo: lambda low, high, v: low <= v <= high,
    GreaterThan: lambda low, high, v: high > v,
    GreaterThanOrEqual: lambda low, high, v: high >= v,
    LessThan: lambda low, high, v: low < v,
    LessThanOrEqual: lambda low, high, v: low <= v,
}


class ArrowFolderReader(DataSourceReader):
    def __init__(self, path: str, rows: int):
        self.path, self.rows, self.filters = path, rows, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters skip files by their bounds; Spark still applies each to the rows."""
        self.filters = [f for f in filters if type(f) in _KEPT]
        yield from filters

    def _may_hold(self, file: dict) -> bool:
        for f in self.filters:
            column = ".".join(f.attribute)
            if column in file["least"] and type(f.value) is type(file["least"][column]):
                if not _KEPT[type(f)](file["least"][column], file["greatest"][column], f.value):
                    return False
        return True

    def partitions(self) -> list[Files]:
        out, rows = [[]], 0
        for file in (read_manifest(self.path) or {"files": []})["files"]:
            if not self._may_hold(file):
                continue
            if out[-1] and rows + file["rows"] > self.rows:
                out.append([])
                rows = 0
            out[-1].append(file["name"])
            rows += file["rows"]
        return [Files(names) for names in out]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, root = _located(self.path)
        for name in partition.names:
            with system.open_input_file(f"{root.rstrip('/')}/{name}") as source:
                reader = pa.ipc.open_file(source)
                for k in range(reader.num_record_batches):
                    yield reader.get_batch(k)


class ArrowFolder(DataSource):
    """Options: ``path``, and ``rows_per_partition`` for reads."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _path(self) -> str:
        path = self.options.get("path")
        if not path:
            raise ValueError(f"{FORMAT} needs a path")
        return path

    def schema(self) -> StructType:
        manifest = read_manifest(self._path())
        if manifest is None:
            raise FileNotFoundError(f"no table at {self._path()}")
        return StructType.fromJson(manifest["schema"])

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArrowFolderReader(self._path(), int(self.options.get("rows_per_partition", _ROWS)))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArrowFolderWriter(self._path(), schema, overwrite).begin()


def register_sources(spark: SparkSession) -> None:
    """Make the format known to the session, which is told to offer its filters to such sources."""
    # the classes travel whole: planning and task workers need not have this package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    spark.dataSource.register(ArrowFolder)
