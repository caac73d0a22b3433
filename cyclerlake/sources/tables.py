"""A collection of named tables behind one small interface.

The same reading code serves parquet/csv/json/orc exports, a Spark catalog database, a JDBC
database and frames that are already at hand. Every read is lazy; filters and projections are
part of the plan and reach the scan.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclerlake.functions.predicates import column_list, pick
from cyclerlake.sources.row_stream import stream_rows
from cyclerlake.sources.schemas import impose, python_schema

STREAM_CHUNK = 100_000
# column of ``together`` that names the table
TABLE = "_table"


def side_by_side(
    spark: SparkSession, paths: Mapping[str, str], fmt: str, schema: T.StructType, options: Mapping[str, str] | None = None
) -> DataFrame | None:
    """One scan of tables that lie in one folder under their names, whatever their number; ``None`` if they do not."""
    parents = set()
    for name, path in paths.items():
        parent, _, last = path.rstrip("/").rpartition("/")
        if last not in (name, f"{name}.{fmt}") or not re.fullmatch(r"[\w-]+", name):
            return None
        parents.add(f"{parent}/")
    # paths that read the same in the names of files
    root = parents.pop()
    if parents or not re.fullmatch(r"([\w+-]+:/)?(/[\w.-]+)+/", root):
        return None
    below = F.split_part(F.col("_metadata.file_path"), F.lit(root), F.lit(2))
    reader = spark.read.format(fmt).options(**(options or {})).schema(schema)
    return reader.load(list(paths.values())).select("*", F.regexp_extract(below, r"^[\w-]+", 0).alias(TABLE))


class Tables:
    """Base: subclasses provide ``names`` and ``frame``."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def names(self) -> list[str]:
        raise NotImplementedError

    def frame(self, name: str) -> DataFrame:
        raise NotImplementedError

    def together(self, names: Sequence[str]) -> DataFrame | None:
        """Several tables as one source, their names in column ``TABLE``; ``None`` if they cannot be read so."""
        return None

    def stream(self, name: str) -> DataFrame:
        raise NotImplementedError(f"{type(self).__name__} cannot be read as a stream")

    def table_schema(self, name: str) -> dict[str, type]:
        """Column names and the Python types of their values."""
        return python_schema(self.frame(name).schema)

    def get_table(
        self,
        name: str,
        columns: str | Sequence[str] | None = None,
        where: Mapping[str, Any] | None = None,
    ) -> DataFrame:
        return pick(self.frame(name), columns, where)

    def stream_table(
        self,
        name: str,
        columns: str | Sequence[str] | None = None,
        where: Mapping[str, Any] | None = None,
    ) -> DataFrame:
        """The same read as an unbounded frame, to be consumed by ``writeStream``."""
        return pick(self.stream(name), columns, where)

    def query(self, text: str, schema: T.StructType | None = None) -> DataFrame:
        """Run SQL over the tables, each visible under its own name while the text is analysed.

        Temporary views that the session has under such names are back afterwards.
        """
        used = [name for name in self.names() if re.search(rf"(?<!\w){re.escape(name)}(?!\w)", text)]
        before = {name: self.spark.table(name) for name in used if self._is_view(name)}
        try:
            for name in used:
                self.frame(name).createOrReplaceTempView(name)
            found = self.spark.sql(text)
        finally:
            for name in used:
                if name in before:
                    before[name].createOrReplaceTempView(name)
                else:
                    self.spark.catalog.dropTempView(name)
        return self._typed(found, schema)

    def _is_view(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name) and self.spark.catalog.getTable(name).isTemporary

    @staticmethod
    def _typed(df: DataFrame, schema: T.StructType | None) -> DataFrame:
        return df if schema is None else impose(df, schema)


class FrameTables(Tables):
    """Frames given by name."""

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
        super().__init__(spark)
        self.frames = dict(frames)

    def names(self) -> list[str]:
        return sorted(self.frames)

    def frame(self, name: str) -> DataFrame:
        return self.frames[name]


class FileTables(Tables):
    """One path per table. ``schemas`` avoids inference, which csv and json need at scale.

    Tables of one given schema that lie side by side, each in a folder or file of its name, can be
    read as one source. Streams take ``files_per_batch`` files at a time or, of Parquet folders, at most
    ``rows_per_batch`` rows; the latter need ``stream_log``, a folder that is kept with the query's checkpoint.
    """

    def __init__(
        self,
        spark: SparkSession,
        paths: Mapping[str, str],
        fmt: str = "parquet",
        options: Mapping[str, str] | None = None,
        schemas: Mapping[str, T.StructType] | None = None,
        files_per_batch: int = 64,
        rows_per_batch: int | None = None,
        stream_log: str | None = None,
    ) -> None:
        super().__init__(spark)
        if rows_per_batch is not None and (fmt != "parquet" or stream_log is None):
            raise ValueError("rows_per_batch needs Parquet files and a stream_log")
        self.rows_per_batch, self.stream_log = rows_per_batch, stream_log
        self.paths = dict(paths)
        self.fmt = fmt
        self.options = dict(options or {})
        self.schemas = dict(schemas or {})
        self.files_per_batch = files_per_batch

    def names(self) -> list[str]:
        return sorted(self.paths)

    def frame(self, name: str) -> DataFrame:
        reader = self.spark.read.format(self.fmt).options(**self.options)
        if name in self.schemas:
            reader = reader.schema(self.schemas[name])
        return reader.load(self.paths[name])

    def together(self, names: Sequence[str]) -> DataFrame | None:
        schemas = [self.schemas.get(name) for name in names]
        if schemas[0] is None or any(schema != schemas[0] for schema in schemas):
            return None
        return side_by_side(self.spark, {name: self.paths[name] for name in names}, self.fmt, schemas[0], self.options)

    def stream(self, name: str) -> DataFrame:
        return self._stream(name, None)

    def stream_table(
        self,
        name: str,
        columns: str | Sequence[str] | None = None,
        where: Mapping[str, Any] | None = None,
    ) -> DataFrame:
        # the source that counts rows is not told which columns are used
        used = None if columns is None else {*column_list(columns), *(where or {})}
        return pick(self._stream(name, used), columns, where)

    def _stream(self, name: str, used: set[str] | None) -> DataFrame:
        schema = self.schemas[name] if name in self.schemas else self.frame(name).schema
        if self.rows_per_batch is not None:
            kept = T.StructType([field for field in schema if used is None or field.name in used])
            return stream_rows(self.spark, self.paths[name], kept, self.rows_per_batch, f"{self.stream_log}/{name}")
        reader = self.spark.readStream.format(self.fmt).options(**self.options).schema(schema)
        return reader.option("maxFilesPerTrigger", self.files_per_batch).load(self.paths[name])


class CatalogTables(Tables):
    """Tables of a database in the session catalog."""

    def __init__(self, spark: SparkSession, database: str | None = None) -> None:
        super().__init__(spark)
        self.database = database or spark.catalog.currentDatabase()

    def names(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.database))

    def _qualified(self, name: str) -> str:
        # temporary views are listed with the database's tables but have no database
        temporary = any(t.name == name and t.isTemporary for t in self.spark.catalog.listTables(self.database))
        return f"`{name}`" if temporary else f"`{self.database}`.`{name}`"

    def frame(self, name: str) -> DataFrame:
        return self.spark.table(self._qualified(name))

    def together(self, names: Sequence[str]) -> DataFrame | None:
        """Tables of one format and schema that are not partitioned, in the database's folder: one look at the catalog, one scan."""
        listed = self.spark.sql(f"SHOW TABLE EXTENDED IN `{self.database}` LIKE '*'").where(F.col("tableName").isin(list(names)))
        # what the catalog tells of a table; a temporary view has no place
        told = {row["tableName"]: row["information"] for row in listed.where("NOT isTemporary").collect()}
        facts = {}
        for name in names:
            text = told.get(name, "")
            found = [re.search(rf"^{key}: (.*)$", text, re.M) for key in ("Provider", "Location")]
            if not all(found) or "\nPartition Columns: " in text or "\nView Text: " in text:
                return None
            # a local place is told with fewer slashes than the names of files have
            facts[name] = (found[0][1].lower(), re.sub(r"^file:/+", "/", found[1][1]), text.partition("\nSchema: ")[2])
        if len({(provider, columns) for provider, _, columns in facts.values()}) != 1:
            return None
        provider = facts[names[0]][0]
        if provider not in ("parquet", "orc", "json", "csv"):
            return None
        # text formats may carry options of their own
        if provider in ("json", "csv") and any("\nStorage Properties: " in told[name] for name in names):
            return None
        return side_by_side(self.spark, {name: place for name, (_, place, _) in facts.items()}, provider, self.frame(names[0]).schema)

    def stream(self, name: str) -> DataFrame:
        return self.spark.readStream.table(self._qualified(name))

    def query(self, text: str, schema: T.StructType | None = None) -> DataFrame:
        return self._typed(self.spark.sql(text), schema)


class JdbcTables(Tables):
    """Tables of a database server.

    ``split`` maps a table to ``(column, lower, upper, parts)``; such a table is read by
    ``parts`` parallel range queries instead of one connection. Another table with the column
    ``split_by`` is read by up to ``parts`` ranges between its ends, for which the server is asked.
    Filters and projections are pushed to the server; joins are not, they run in Spark.
    """

    def __init__(
        self,
        spark: SparkSession,
        options: Mapping[str, str],
        names: Sequence[str] | None = None,
        split: Mapping[str, tuple[str, int, int, int]] | None = None,
        fetch_rows: int = STREAM_CHUNK,
        split_by: str = "seq_id",
        parts: int = 16,
    ) -> None:
        super().__init__(spark)
        self.split_by, self.parts = split_by, parts
        self.base = {"preferTimestampNTZ": "true", "fetchsize": str(fetch_rows), **options}
        self.known = None if names is None else sorted(names)
        self.split = dict(split or {})

    def names(self) -> list[str]:
        if self.known is None:
            text = "SELECT table_name AS name FROM information_schema.tables WHERE table_schema = DATABASE()"
            self.known = sorted(row[0] for row in self.query(text).collect())
        return self.known

    def read_options(self, name: str) -> dict[str, str]:
        options = {**self.base, "dbtable": name}
        if name in self.split:
            column, lower, upper, parts = self.split[name]
            options |= {
                "partitionColumn": column,
                "lowerBound": str(lower),
                "upperBound": str(upper),
                "numPartitions": str(parts),
            }
        return options

    def ends(self, name: str) -> tuple[int | None, int | None]:
        return tuple(self.query(f"SELECT MIN({self.split_by}) AS lo, MAX({self.split_by}) AS hi FROM {name}").first())

    def split_evenly(self, name: str) -> None:
        """Split a table between its ends; one with few ids stays whole."""
        lo, hi = self.ends(name)
        parts = 1 if lo is None else min(self.parts, (hi - lo) // STREAM_CHUNK + 1)
        if parts > 1:
            self.split[name] = (self.split_by, lo, hi + 1, parts)

    def _load(self, name: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.read_options(name)).load()

    def frame(self, name: str) -> DataFrame:
        whole = self._load(name)
        if name in self.split or self.parts < 2 or self.split_by not in whole.columns:
            return whole
        self.split_evenly(name)
        return self._load(name) if name in self.split else whole

    def query(self, text: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read.format("jdbc").options(**self.base)
        return self._typed(reader.option("query", text).load(), schema)
