"""Main records and auxiliary channels of streams, joined and numbered although they arrive out of order.

A test's records have numbers, and a record arrives at most ``bound`` numbers after a later one of its
side. So what has been seen of a test says up to where it is complete: below the smaller of the largest
numbers seen of its two sides, less ``bound``. This horizon is a watermark of the test's own; an
event-time watermark would be one instant for all tests.

Each micro-batch adds its records to those held back, releases what lies below the horizons, joins
and numbers that with the batch operators, and holds the rest. Held records are a table, not
the state of a key: one test may be a third of all records, and its held ones are spread over tasks like any
others. State and held records live in two slots used in turn, and output is overwritten per batch,
so a repeated batch is harmless.

A record below a horizon that has been released is an error, as it would change numbers already
written. Null numbers come first: they are released with the first records of a test and late after
that. A test with channels whose main records or channels stop is held from there on; ``finish`` releases what is held when tests
have ended.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cyclerlake.functions.predicates import quoted
from cyclerlake.operators.chunks import SIDE, Layout
from cyclerlake.operators.features import CARRY, add_step_features, summarise
from cyclerlake.operators.joins import join_aux
from cyclerlake.session import landed
from cyclerlake.streaming.sinks import READ_UP
from cyclerlake.streaming.steps import LateRecordsError

AUX = "_aux_"
SEEN = ["_seen_main", "_seen_aux"]
BROADCAST_TESTS = 100_000
FINISHED = -1


def _one_stream(main: DataFrame, aux: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """Both sides in one stream; auxiliary columns other than the keys carry a prefix."""
    main = main.withColumn(SIDE, F.lit("main"))
    if aux is None:
        return main
    keys = [*by, "seq_id"]
    named = {c: f"{AUX}{c}" for c in aux.columns if c not in keys}
    return main.unionByName(aux.withColumnsRenamed(named).withColumn(SIDE, F.lit("aux")), allowMissingColumns=True)


def _sides(rows: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    named = [c for c in rows.columns if c.startswith(AUX)]
    main = rows.where(F.col(SIDE) == "main").drop(SIDE, *named)
    if not named:
        return main, None
    keys = [F.col(quoted(c)) for c in (*by, "seq_id")]
    return main, rows.where(F.col(SIDE) == "aux").select(*keys, *(F.col(quoted(c)).alias(c.removeprefix(AUX)) for c in named))


def _same(by: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(quoted(k)).eqNullSafe(F.col(f"{prefix}{k}")) for k in by] or [F.lit(True)]


def _keyed(df: DataFrame, by: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: f"{prefix}{k}" for k in by})


class _Slots:
    """What a batch leaves to the next one: numbers per test, and held records."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _path(self, kind: str, batch_id: int) -> str:
        return f"{self.folder}/{kind}/slot={batch_id % 2}"

    def read(self, kind: str, batch_id: int, schema: T.StructType) -> DataFrame:
        schema = T.StructType([*schema, T.StructField("_batch", T.LongType())])
        if batch_id < 0:
            return self.spark.createDataFrame([], schema).drop("_batch")
        return self.spark.read.schema(schema).parquet(self._path(kind, batch_id)).where(F.col("_batch") == batch_id).drop("_batch")

    def write(self, kind: str, batch_id: int, df: DataFrame) -> None:
        df.withColumn("_batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(self._path(kind, batch_id))

    def last(self) -> tuple[int, T.StructType]:
        """Number of the last batch, and the columns of held records."""
        found = self.spark.read.parquet(f"{self.folder}/state").agg(F.max("_batch")).first()[0]
        held = self.spark.read.parquet(self._path("held", found)).drop("_batch")
        return found, held.schema


def _state_schema(records: T.StructType, by: Sequence[str]) -> T.StructType:
    return T.StructType([*(records[k] for k in by), *(T.StructField(c, T.LongType()) for c in [*CARRY, *SEEN, "_released"])])


def _numbered(released: DataFrame, state: DataFrame, by: Sequence[str], layout: Layout, scope: str) -> tuple[DataFrame, DataFrame]:
    """Released records joined and numbered, and what they add to the numbers per test."""
    main, aux = _sides(released, by)
    if scope == "record" or aux is None:
        done = add_step_features(main, by, layout, carry=state)
        return (done if aux is None else join_aux(done, aux, by, layout)), summarise(main, by)
    joined = landed(join_aux(main, aux, by, layout), "stream-joined")
    return add_step_features(joined, by, layout, carry=state), summarise(joined, by)


def ordered_batch(by: Sequence[str], folder: str, bound: int, layout: Layout = Layout(), scope: str = "row") -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function over the two sides in one stream."""
    if bound < 0:
        raise ValueError("bound must not be negative")

    def run(batch: DataFrame, batch_id: int) -> None:
        slots = _Slots(batch.sparkSession, folder)
        state = slots.read("state", batch_id - 1, _state_schema(batch.schema, by))
        held = slots.read("held", batch_id - 1, batch.schema)
        has_aux = any(c.startswith(AUX) for c in batch.columns)

        def largest(side: str) -> Column:
            return F.max(F.when(F.col(SIDE) == side, F.col("seq_id").cast("bigint"))).alias(f"_seen_{side}")

        lowest = F.min(F.coalesce(F.col("seq_id").cast("bigint"), F.lit(-(2**63)))).alias("_lowest")
        arrived = landed(batch.groupBy(*by).agg(largest("main"), largest("aux"), lowest), "stream-arrived")
        late = arrived.join(_keyed(state.select(*by, "_released"), by, "_k_"), _same(by, "_k_")).where("_lowest < _released")
        if found := late.select(*by).limit(1).collect():
            raise LateRecordsError(f"records out of order by more than {bound} for {found[0].asDict()}")

        seen = state.select(*by, *SEEN).unionByName(arrived.select(*by, *SEEN)).groupBy(*by).agg(*(F.max(c).alias(c) for c in SEEN))
        both = "CASE WHEN _seen_main < _seen_aux THEN _seen_main WHEN _seen_main >= _seen_aux THEN _seen_aux END"
        seen = landed(seen.withColumn("_horizon", F.expr(f"{both if has_aux else '_seen_main'} - {bound}")), "stream-seen")
        ends = _keyed(seen.select(*by, "_horizon"), by, "_k_")
        if seen.count() <= BROADCAST_TESTS:
            ends = F.broadcast(ends)
        columns = [F.col(quoted(c)) for c in batch.columns]
        rows = held.unionByName(batch).join(ends, _same(by, "_k_"), "left")
        below = F.coalesce(F.expr("CASE WHEN seq_id IS NULL THEN _horizon IS NOT NULL ELSE seq_id < _horizon END"), F.lit(False))
        rows = landed(rows.select(*columns, below.alias("_below")), "stream-rows")
        done, added = _numbered(rows.where("_below").drop("_below"), state.select(*by, *CARRY), by, layout, scope)
        done.write.mode("overwrite").parquet(f"{folder}/data/batch={batch_id}")
        numbers = state.select(*by, *CARRY).unionByName(added.select(*by, *CARRY)).groupBy(*by)
        numbers = numbers.agg(F.sum("_zeros").alias("_zeros"), F.max("_start").alias("_start"), *(F.min(c).alias(c) for c in ("_first", "_t0")))
        told = _keyed(numbers, by, "_k_")
        marks = seen.join(told, _same(by, "_k_"), "left").select(*by, *CARRY, *SEEN, F.col("_horizon").alias("_released"))
        slots.write("held", batch_id, rows.where("NOT _below").drop("_below"))
        slots.write("state", batch_id, marks)

    return run


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stream_ordered(
    main: DataFrame,
    aux: DataFrame | None,
    by: Sequence[str],
    folder: str,
    bound: int,
    layout: Layout = Layout(),
    scope: str = "row",
    trigger: Mapping[str, Any] = READ_UP,
) -> StreamingQuery:
    """Join and number streams of converted records into ``folder``; goes on where it stopped."""
    # what ``finish`` released is still held and comes again
    _remove(main.sparkSession, f"{folder}/data/batch={FINISHED}")
    writer = _one_stream(main, aux, by).writeStream.foreachBatch(ordered_batch(by, folder, bound, layout, scope))
    return writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(**trigger).start()


def finish(spark: SparkSession, by: Sequence[str], folder: str, layout: Layout = Layout(), scope: str = "row") -> None:
    """Number what is still held, as nothing more will come. A stream that goes on after all takes it back."""
    slots = _Slots(spark, folder)
    batch_id, records = slots.last()
    state = slots.read("state", batch_id, _state_schema(records, by))
    done, _ = _numbered(slots.read("held", batch_id, records), state.select(*by, *CARRY), by, layout, scope)
    done.write.mode("overwrite").parquet(f"{folder}/data/batch={FINISHED}")


def read_ordered(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/data").drop("batch")
