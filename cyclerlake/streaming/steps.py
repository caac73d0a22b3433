"""Step features over a stream of records.

Per test the stream remembers: step starts so far, where the last step began, the first
``seq_id``, the first second, and ``seq_id`` and channel of the last record. A micro-batch is numbered with the batch operator
starting from those numbers, so a long test is spread over tasks here too.

The numbers live in a table beside the output, in two slots used in turn: batch N reads slot
N-1 and writes slot N. Output and slot are overwritten per batch, which makes a repeated batch
harmless.

Records of a test must arrive in the order of ``seq_id`` and channel from batch to batch; a batch
may end between channels of a record. Null ids come first, as in a batch. A late record, and one
equal in both to the last, would change numbers already written, so it is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cyclerlake.operators.chunks import Layout
from cyclerlake.operators.features import CARRY, add_step_features, summarise
from cyclerlake.session import landed
from cyclerlake.streaming.sinks import READ_UP

SEEN = T.StructType([T.StructField("seq_id", T.LongType()), T.StructField("channel", T.LongType())])


class LateRecordsError(ValueError):
    """A record arrived after one that it does not follow in order."""


def _slot(folder: str, batch_id: int) -> str:
    return f"{folder}/slot={batch_id % 2}"


def _state_before(spark: SparkSession, folder: str, batch_id: int, keys: T.StructType) -> DataFrame:
    numbers = [T.StructField(name, T.LongType()) for name in [*CARRY, "_batch"]]
    schema = T.StructType([*keys, *numbers, T.StructField("_last", SEEN)])
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    kept = spark.read.schema(schema).parquet(_slot(folder, batch_id - 1))
    return kept.where(F.col("_batch") == batch_id - 1)


def _merge(state: DataFrame, batch: DataFrame, by: Sequence[str]) -> DataFrame:
    return (
        state.select(*by, *CARRY, "_last")
        .unionByName(batch.select(*by, *CARRY, "_last"))
        .groupBy(*by)
        .agg(
            F.sum("_zeros").alias("_zeros"),
            *(F.max(c).alias(c) for c in ("_start", "_last")),
            *(F.min(c).alias(c) for c in ("_first", "_t0")),
        )
    )


def step_batch(by: Sequence[str], folder: str, layout: Layout = Layout()) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: numbers a batch, writes it and the new state."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keys = T.StructType([batch.schema[key] for key in by])
        state = _state_before(spark, f"{folder}/state", batch_id, keys)

        channel = "CAST(auxchl_id AS bigint)" if "auxchl_id" in batch.columns else "CAST(NULL AS bigint)"
        order = F.expr(f"struct(CAST(seq_id AS bigint) AS seq_id, {channel} AS channel)")
        ends = batch.select(*by, order.alias("_at")).groupBy(*by).agg(F.min("_at").alias("_from"), F.max("_at").alias("_last"))
        ends = ends.withColumnsRenamed({k: f"_e_{k}" for k in by})
        numbers = summarise(batch, by).drop("_last")
        same = [F.col(k).eqNullSafe(F.col(f"_e_{k}")) for k in by] or [F.lit(True)]
        summary = landed(numbers.join(ends, same).select(*by, *CARRY, "_from", "_last"), "batch-summary")
        known = state.select(*(F.col(k).alias(f"_k_{k}") for k in by), F.col("_last").alias("_seen"))
        late = (
            summary.select(*by, "_from")
            .join(known, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by] or [F.lit(True)])
            .where(F.col("_from") <= F.col("_seen"))
            .select(*by)
            .limit(1)
            .collect()
        )
        if late:
            raise LateRecordsError(f"records out of order for {late[0].asDict()}")

        numbered = add_step_features(batch, by, layout, carry=state)
        numbered.write.mode("overwrite").parquet(f"{folder}/data/batch={batch_id}")
        merged = _merge(state, summary, by).withColumn("_batch", F.lit(batch_id).cast("bigint"))
        merged.write.mode("overwrite").parquet(_slot(f"{folder}/state", batch_id))

    return run


def stream_steps(
    records: DataFrame, by: Sequence[str], folder: str, layout: Layout = Layout(), trigger: Mapping[str, Any] = READ_UP
) -> StreamingQuery:
    """Number the steps of a stream of converted records into ``folder``."""
    writer = records.writeStream.foreachBatch(step_batch(by, folder, layout))
    return writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(**trigger).start()


def read_steps(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/data").drop("batch")
