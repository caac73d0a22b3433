"""Running a stream into files."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# takes what is there and ends
READ_UP = {"availableNow": True}
# goes on until it is stopped; sources that count rows per batch need it
GO_ON = {"processingTime": "0 seconds"}


def write_stream(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: Mapping[str, Any] = READ_UP
) -> StreamingQuery:
    """Append every micro-batch to files, each exactly once; stops when the source is read up."""
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**trigger).start()


def read_up(query: StreamingQuery) -> None:
    """Wait until a query that goes on has read what its sources hold, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
