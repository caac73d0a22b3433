"""A folder of Parquet files as a stream whose micro-batches hold at most so many rows.

Spark's file source counts files or bytes and never divides a file between two batches. Here a
place in the stream is one number, the rows before it. A log beside the query's checkpoint keeps
the order in which files were met, with the rows of their row groups, so that a number means the
same rows after a restart and files that appear late simply come last. A batch is a range of
numbers and its tasks are the row groups that the range meets.

Spark asks a source of this kind for its latest place without telling where the last batch ended.
The reader remembers it, and after a restart Spark first plans the last batch again, which tells it.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator, Sequence
from typing import Any, NamedTuple

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "cyclerlake_rows"
# names that Arrow has for file systems Hadoop names otherwise
SCHEMES = {"s3a": "s3", "s3n": "s3"}
# every so many entries one repeats all before it, which bounds what a restart reads
WHOLE = 100
READ_ROWS = 65_536


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path there."""
    if folder.startswith("/"):
        return fs.LocalFileSystem(), folder.rstrip("/")
    scheme, mark, rest = folder.partition(":")
    # a local place may be told with one slash
    rest = f"///{rest.lstrip('/')}" if scheme == "file" else rest
    files, path = fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}{mark}{rest}")
    return files, path.rstrip("/")


class Known(NamedTuple):
    """A file, the rows before it in the stream, and the rows of its row groups."""

    path: str
    at: int
    groups: list[int]

    @property
    def end(self) -> int:
        return self.at + sum(self.groups)


class FileLog:
    """Files in the order in which they were met. One query writes a log at a time."""

    def __init__(self, folder: str) -> None:
        self.files, self.base = file_system(folder)
        self.files.create_dir(self.base, recursive=True)
        numbers = sorted(int(i.base_name[:-5]) for i in self.files.get_file_info(fs.FileSelector(self.base)) if i.base_name.endswith(".json"))
        self.entries = numbers[-1] + 1 if numbers else 0
        self.known: list[Known] = []
        for number in range((self.entries - 1) // WHOLE * WHOLE if numbers else 0, self.entries):
            with self.files.open_input_file(self._name(number)) as source:
                self._take(json.loads(source.read()))
        self.paths = {k.path for k in self.known}

    def _name(self, number: int) -> str:
        return f"{self.base}/{number:012d}.json"

    def _take(self, met: Sequence[Sequence[Any]]) -> None:
        for path, groups in met:
            self.known.append(Known(path, self.rows, groups))

    @property
    def rows(self) -> int:
        return self.known[-1].end if self.known else 0

    def add(self, met: list[tuple[str, list[int]]]) -> None:
        self._take(met)
        self.paths.update(path for path, _ in met)
        told = [(k.path, k.groups) for k in self.known] if self.entries % WHOLE == 0 else met
        # a reader sees whole entries only
        draft = f"{self.base}/_{self.entries}"
        with self.files.open_output_stream(draft) as out:
            out.write(json.dumps(told).encode())
        self.files.move(draft, self._name(self.entries))
        self.entries += 1


class Piece(InputPartition):
    """Rows ``low`` to ``high`` of one row group."""

    def __init__(self, path: str, group: int, low: int, high: int) -> None:
        self.path, self.group, self.low, self.high = path, group, low, high


class RowReader(DataSourceStreamReader):
    def __init__(self, folder: str, log: str, rows: int, schema: T.StructType) -> None:
        self.folder, self.log_folder, self.rows, self.schema = folder, log, rows, schema
        self.at: int | None = None
        self.log: FileLog | None = None

    def __getstate__(self) -> dict[str, Any]:
        # tasks need neither the log nor the place
        return {**self.__dict__, "at": None, "log": None}

    def _opened(self) -> FileLog:
        self.log = self.log or FileLog(self.log_folder)
        return self.log

    def _new_files(self, log: FileLog) -> list[str]:
        files, base = file_system(self.folder)
        if files.get_file_info(base).type == fs.FileType.File:
            return [] if base in log.paths else [base]
        found = []
        for info in files.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True)):
            parts = posixpath.relpath(info.path, base).split("/")
            if parts[0] == "_spark_metadata":
                raise ValueError(f"{self.folder} was written by a stream, whose log of files is not read here")
            if info.type == fs.FileType.File and not any(part[0] in "._" for part in parts) and info.path not in log.paths:
                if any("=" in part for part in parts[:-1]):
                    raise ValueError(f"{self.folder} is partitioned; columns in names of folders are not read")
                found.append((info.mtime_ns, info.path))
        return [path for _, path in sorted(found)]

    def _reach(self, log: FileLog, rows: int) -> None:
        """Log new files until so many rows are known; no footer beyond is read."""
        if log.rows >= rows:
            return
        files, _ = file_system(self.folder)
        met, total = [], log.rows
        for path in self._new_files(log):
            if total >= rows:
                break
            with files.open_input_file(path) as source:
                footer = pq.read_metadata(source)
            met.append((path, [footer.row_group(i).num_rows for i in range(footer.num_row_groups)]))
            total += sum(met[-1][1])
        if met:
            log.add(met)

    def initialOffset(self) -> dict:
        return {"rows": 0}

    def latestOffset(self) -> dict:
        at = self.at or 0
        log = self._opened()
        self._reach(log, at + self.rows)
        if log.rows < at:
            raise ValueError(f"{self.log_folder} knows {log.rows} rows, but {at} were read: log and checkpoint belong together")
        self.at = min(at + self.rows, log.rows)
        return {"rows": self.at}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if self.at is None:
            self.at = end["rows"]
        first, last = start["rows"], end["rows"]
        log = self._opened()
        if log.rows < last:
            raise ValueError(f"{self.log_folder} knows {log.rows} rows, but {last} were planned: log and checkpoint belong together")
        pieces = []
        for known in log.known:
            if known.end <= first or known.at >= last:
                continue
            at = known.at
            for group, rows in enumerate(known.groups):
                low, high = max(first, at), min(last, at + rows)
                if low < high:
                    pieces.append(Piece(known.path, group, low - at, high - at))
                at += rows
        return pieces

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        files, _ = file_system(self.folder)
        with files.open_input_file(partition.path) as source:
            parquet = pq.ParquetFile(source)
            names = [name for name in schema.names if name in parquet.schema_arrow.names]
            at = 0
            for batch in parquet.iter_batches(READ_ROWS, row_groups=[partition.group], columns=names):
                low, high = max(partition.low - at, 0), min(partition.high - at, batch.num_rows)
                at += batch.num_rows
                if low < high:
                    yield conformed(batch.slice(low, high - low), schema)
                if at >= partition.high:
                    return


def conformed(batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    """The columns of a schema; those that a file lacks are null."""
    columns = [batch.column(f.name).cast(f.type) if f.name in batch.schema.names else pa.nulls(batch.num_rows, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


class RowSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        raise ValueError("give the schema")

    def streamReader(self, schema: T.StructType) -> RowReader:
        return RowReader(self.options["path"], self.options["log"], int(self.options["rows"]), schema)


def stream_rows(spark: SparkSession, folder: str, schema: T.StructType, rows: int, log: str) -> DataFrame:
    """A folder of Parquet files, to which files are only added, or one file, in micro-batches of at most ``rows`` rows.

    Files come in the order in which they were met, those met together by time of writing, then name;
    rows as they lie. A batch is shorter only where no more rows are there. ``log`` is a folder that
    executors need not reach; it belongs to one query and is kept as long as its checkpoint. Empty
    files and an empty or absent folder give no rows. The driver lists the folder per batch
    and reads the footers of the files that the batch meets. Spark takes one batch of such a source
    under ``availableNow``: use the trigger ``processingTime`` with it, see ``read_up``.
    """
    if rows < 1:
        raise ValueError("rows must be positive")
    spark.dataSource.register(RowSource)
    return spark.readStream.format(FORMAT).schema(schema).options(path=folder, log=log, rows=rows).load()
