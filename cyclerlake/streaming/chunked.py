"""Work through a bounded read in chunks, where the data lies."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclerlake.operators.places import with_places
from cyclerlake.session import landed
from cyclerlake.sources.tables import STREAM_CHUNK, Tables


def map_chunks(
    df: DataFrame,
    work: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    chunksize: int = STREAM_CHUNK,
) -> DataFrame:
    """Apply ``work`` to frames of at most ``chunksize`` rows.

    The chunks of a partition are handled one after the other in its task, so memory is bounded
    by one chunk and all partitions run in parallel.
    """
    if chunksize < 1:
        raise ValueError("chunksize must be positive")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0
        for batch in batches:
            while len(batch):
                piece, batch = batch.iloc[: chunksize - rows], batch.iloc[chunksize - rows :]
                held.append(piece)
                rows += len(piece)
                if rows == chunksize:
                    yield work(pd.concat(held, ignore_index=True))
                    held, rows = [], 0
        if rows:
            yield work(pd.concat(held, ignore_index=True))

    return df.mapInPandas(run, schema)


AT, CHUNK = "_at", "_number"


def _in_chunks(df: DataFrame, chunksize: int, order: Sequence[str]) -> DataFrame:
    if chunksize < 1:
        raise ValueError("chunksize must be positive")
    return with_places(df, order, AT).withColumn(CHUNK, F.expr(f"{AT} div {chunksize}"))


def map_exact_chunks(
    df: DataFrame,
    work: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    chunksize: int = STREAM_CHUNK,
    order: Sequence[str] = (),
) -> DataFrame:
    """Apply ``work`` to frames of exactly ``chunksize`` consecutive rows of the whole result; only the last is shorter.

    Rows follow each other in ``order``, or as they lie. ``map_chunks`` needs no shuffle, but ends a chunk with every partition.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return work(frame.sort_values(AT, ignore_index=True).drop(columns=[AT, CHUNK]))

    return _in_chunks(df, chunksize, order).groupBy(CHUNK).applyInPandas(run, schema)


def iter_chunks(df: DataFrame, chunksize: int = STREAM_CHUNK, order: Sequence[str] = ()) -> Iterator[pd.DataFrame]:
    """The same chunks one after the other, for the caller; the driver holds some at a time.

    Tasks put chunks together and hand each over as a single value. What a job hands over is a chunk, or as many small
    ones as have the rows of a chunk of default size: a job per chunk would cost more than its rows.
    """
    names = df.columns

    def packed(table: pa.Table) -> pa.Table:
        rows = table.sort_by(AT).select(names).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as writer:
            writer.write_table(rows)
        return pa.table({CHUNK: table.column(CHUNK).slice(0, 1), "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    numbered = _in_chunks(df, chunksize, order)
    chunks = (numbered.agg(F.max(CHUNK)).first()[0] or 0) + 1
    jobs = -(-chunks // max(1, STREAM_CHUNK // chunksize))
    # landed: the ranges are drawn from a sample, which would put the chunks together a second time
    values = landed(numbered.groupBy(CHUNK).applyInArrow(packed, f"{CHUNK} long, rows binary"), "chunks")
    ordered = values.repartitionByRange(jobs, CHUNK).sortWithinPartitions(CHUNK)
    for row in ordered.toLocalIterator():
        yield pa.ipc.open_stream(row["rows"]).read_pandas()


def query_chunks(
    tables: Tables,
    text: str,
    work: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    chunksize: int = STREAM_CHUNK,
) -> DataFrame:
    """``map_chunks`` over the result of an SQL text."""
    return map_chunks(tables.query(text), work, schema, chunksize)


def table_chunks(
    tables: Tables,
    name: str,
    work: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    columns: str | Sequence[str] | None = None,
    where: Mapping[str, Any] | None = None,
    chunksize: int = STREAM_CHUNK,
) -> DataFrame:
    """``map_chunks`` over a filtered and projected table."""
    return map_chunks(tables.get_table(name, columns, where), work, schema, chunksize)
