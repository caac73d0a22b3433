"""Step counter, index within the step and elapsed time.

``step_count`` is the running number of records with ``test_time`` = 0, ``step_index`` counts
from the first ``seq_id`` of the step, ``test_totaltime`` counts from the test's first second.

All three are running aggregates over a whole test. They are computed per chunk: a narrow
first read summarises each chunk, a window over those few summaries gives what every chunk
starts from, and that start enters the chunk as one extra row ahead of its records. One window
over the chunk then yields all three, with one shuffle of the full rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclerlake.functions.predicates import quoted
from cyclerlake.operators.chunks import (
    CHUNK,
    COPIES,
    Layout,
    collapse_copies,
    expand_copies,
    Measured,
    measure,
    split_hot,
    with_chunk,
)
from cyclerlake.operators.snapshot import frozen, frozen_hot, last_place
from cyclerlake.session import landed

PART = "_part"
BLOCK = "_block"
# what records contribute to later ones, and what a chunk starts from
CARRY = ["_zeros", "_start", "_first", "_t0"]
RUNNING = ["_zeros", "_start", "_t0"]
IS_START = "coalesce(test_time = 0, false)"
# groups with their first value: some longs each, below 10 MB
BROADCAST_GROUPS = 100_000


def _weight(df: DataFrame) -> str:
    return COPIES if COPIES in df.columns else "1L"


def summarise(df: DataFrame, keys: Sequence[str], total_time: bool = True, more: Sequence[Column] = ()) -> DataFrame:
    """What a set of records contributes to the records after it."""
    weight = _weight(df)
    # the clock is a wide column to read, so only when elapsed time is asked for
    seconds = "unix_time" if total_time and "unix_time" in df.columns else "CAST(NULL AS bigint)"
    return df.groupBy(*keys).agg(
        F.expr(f"sum({weight}) AS _rows"),
        F.expr(f"sum(CASE WHEN {IS_START} THEN {weight} ELSE 0L END) AS _zeros"),
        F.expr(f"max(CASE WHEN {IS_START} THEN seq_id END) AS _start"),
        F.expr("min(seq_id) AS _first"),
        F.expr("max(seq_id) AS _last"),
        F.expr(f"min({seconds}) AS _t0"),
        *more,
    )


def _over(by: Sequence[str], order: Sequence[str] = (), frame: str = "") -> str:
    partition = f"PARTITION BY {', '.join(by)}" if by else ""
    return f"OVER ({partition} {'ORDER BY ' + ', '.join(order) if order else ''} {frame})"


def _running(summary: DataFrame, by: Sequence[str], place: Sequence[str], carry: DataFrame | None) -> DataFrame:
    """For each place in a test what lies before it: step starts, the last one's id, first second of the test.

    ``carry`` holds one row per test with the same columns from records seen earlier.
    """
    summary = summary.selectExpr(*by, *place, *CARRY, "1 AS _rank")
    if carry is not None:
        earlier = carry.selectExpr(*by, *CARRY, "0 AS _rank")
        summary = summary.unionByName(earlier, allowMissingColumns=True)
    test = _over(by)
    before = _over(by, ["_rank", *place], "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    starts = summary.selectExpr(
        *by,
        *place,
        f"coalesce(sum(_zeros) {before}, 0L) AS _zeros",
        # before the first start, the step begins with the test
        f"coalesce(max(_start) {before}, min(_first) {test}) AS _start",
        f"min(_t0) {test} AS _t0",
        "_rank",
    )
    return starts.where("_rank = 1").drop("_rank")


def _chunk_starts(
    summary: DataFrame, by: Sequence[str], carry: DataFrame | None, layout: Layout, chunks: int
) -> DataFrame:
    """What each chunk (and part of a hot chunk) starts from.

    Many chunks are summed in two steps, blocks of chunks before chunks of a block, so that no
    window holds more than some thousand rows of a test, however long it is.
    """
    place = [CHUNK, PART]
    if chunks <= layout.block_chunks:
        return _running(summary, by, place, carry).selectExpr(*by, *place, *RUNNING, "true AS _is_chunk_start")
    width = layout.chunk_records * layout.block_chunks
    summary = summary.withColumn(BLOCK, F.expr(f"{CHUNK} - pmod({CHUNK}, {width}L)"))
    totals = summary.groupBy(*by, BLOCK).agg(F.sum("_zeros").alias("_zeros"), F.max("_start").alias("_start"), *(F.min(c).alias(c) for c in ("_first", "_t0")))
    blocks = _running(totals, by, [BLOCK], carry)
    blocks = blocks.selectExpr(*(f"{c} AS _of_{c}" for c in [*by, BLOCK, *RUNNING]))
    match = F.expr(" AND ".join(f"{c} <=> _of_{c}" for c in [*by, BLOCK]))
    before = _over([*by, BLOCK], place, "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    return summary.join(blocks, match).selectExpr(
        *by,
        *place,
        f"_of__zeros + coalesce(sum(_zeros) {before}, 0L) AS _zeros",
        f"coalesce(max(_start) {before}, _of__start) AS _start",
        "_of__t0 AS _t0",
        "true AS _is_chunk_start",
    )


def _orderable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.MapType, T.VariantType))


def _record_order(df: DataFrame, by: Sequence[str]) -> list[str]:
    """``seq_id``, then channel; further ties are broken by content to give the same result each run."""
    first = [c for c in ("seq_id", "auxchl_id") if c in df.columns]
    skip = {*first, *by, CHUNK, COPIES, PART}
    return first + [quoted(f.name) for f in df.schema if f.name not in skip and _orderable(f.dataType)]


def _numbered(rows: DataFrame, starts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Running values of every row, in the columns of ``RUNNING``."""
    columns = [quoted(c) for c in rows.columns]
    marked = rows.unionByName(starts, allowMissingColumns=True)
    window = _over(
        keys,
        ["_is_chunk_start DESC NULLS LAST", *order],
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW",
    )
    zeros = f"CASE WHEN _is_chunk_start THEN _zeros WHEN {IS_START} THEN {_weight(rows)} ELSE 0L END"
    start = f"CASE WHEN _is_chunk_start THEN _start WHEN {IS_START} THEN seq_id END"
    return marked.selectExpr(
        *columns,
        f"sum({zeros}) {window} AS _zeros",
        f"max({start}) {window} AS _start",
        f"max(_t0) {window} AS _t0",
        "_is_chunk_start",
    ).where("_is_chunk_start IS NULL")


def _spread_copies(numbered: DataFrame, partitions: int | None) -> DataFrame:
    """Give back the copies, each step start among them with its own number."""
    copies = expand_copies(numbered, "_copy", partitions)
    own = f"CASE WHEN {IS_START} THEN _zeros - {COPIES} + _copy ELSE _zeros END"
    return copies.selectExpr(*(f"{own} AS _zeros" if c == "_zeros" else quoted(c) for c in numbered.columns))


def _finish(numbered: DataFrame, columns: Sequence[str], total_time: bool) -> DataFrame:
    out = {"step_count": "_zeros", "step_index": "seq_id - _start + 1"}
    if total_time and "unix_time" in columns:
        out["test_totaltime"] = "unix_time - _t0"
    kept = [quoted(c) for c in columns if c not in out]
    return numbered.selectExpr(*kept, *(f"{text} AS {name}" for name, text in out.items()))


class Parts(NamedTuple):
    """Rows of ordinary chunks, still laid out by chunk, and rows of hot chunks if there are any."""

    cold: DataFrame
    hot: DataFrame | None

    def whole(self) -> DataFrame:
        both = self.cold if self.hot is None else self.cold.unionByName(self.hot, allowMissingColumns=True)
        return both.drop(CHUNK)


def _with_parts(hot: DataFrame, by: Sequence[str], order: Sequence[str], parts: int) -> DataFrame:
    """Splits hot chunks by ranges of the record order; the parts of a chunk are numbered in that order.

    Where Spark draws the ranges decides how work is spread, never a number: a part continues where
    the one before it ends. The rows are distinct, so any range can be split. They are landed,
    because three reads below must see the same parts.
    """
    place = [F.expr(c) for c in [*by, CHUNK, *order]]
    spread = hot.repartitionByRange(parts, *place).withColumn(PART, F.spark_partition_id().cast("bigint"))
    return landed(spread, "hot-rows")


def number_steps(
    cold: DataFrame,
    cold_summary: DataFrame,
    hot: DataFrame | None,
    by: Sequence[str],
    layout: Layout,
    measured: Measured,
    carry: DataFrame | None = None,
    laid_out: bool = False,
    total_time: bool = True,
) -> Parts:
    """Step features of rows that carry a chunk key.

    ``cold_summary`` holds ``summarise`` of the cold rows per chunk. With ``laid_out`` the cold
    rows already lie as ``measured`` says and are not moved again.
    """
    columns = cold.columns
    cold_keys = [CHUNK, *reversed(by)]
    hot_keys = [*cold_keys, PART]
    order = _record_order(cold, by)
    summary = cold_summary.selectExpr(*cold_keys, *CARRY, f"CAST(NULL AS bigint) AS {PART}")
    if hot is not None:
        hot = _with_parts(collapse_copies(hot), by, order, measured.hot_parts)
        summary = summary.unionByName(summarise(hot, hot_keys, total_time).select(*hot_keys, *CARRY))
        starts = landed(_chunk_starts(summary, by, carry, layout, measured.chunks), "chunk-starts")
        cold_starts, hot_starts = starts.where(f"{PART} IS NULL"), starts.where(f"{PART} IS NOT NULL")
        hot_numbered = _spread_copies(_numbered(hot, hot_starts, hot_keys, order), measured.partitions)
        hot_done = _finish(hot_numbered, columns, total_time)
    else:
        cold_starts, hot_done = _chunk_starts(summary, by, carry, layout, measured.chunks), None

    cold_starts = cold_starts.drop(PART)
    if not laid_out and measured.partitions is not None:
        cold, laid_out = measured.lay_out(cold, cold_keys), True
    if laid_out:
        cold_starts = measured.lay_out(cold_starts, cold_keys)
    return Parts(_finish(_numbered(cold, cold_starts, cold_keys, order), columns, total_time), hot_done)


def _first_of_group(df: DataFrame, by: Sequence[str], column: str, name: str, layout: Layout) -> DataFrame:
    """Add the smallest ``column`` per group; the grouped side has one row per group.

    The groups are landed and counted. A short list is broadcast, so records stay where they lie. Of a longer
    one the hot groups are, at most total rows / ``layout.hot_rows``; records of the others are shuffled.
    """
    if not by:
        return _first_of_group(df.withColumn("_all", F.lit(1)), ["_all"], column, name, layout).drop("_all")
    keys = {c: f"_key_{c}" for c in by}
    found = df.groupBy(*by).agg(F.min(column).alias(name), F.expr("count(*) AS _rows"))
    groups = landed(found.withColumnsRenamed(keys), "group-firsts")
    lowest = groups.drop("_rows")
    match = [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()]

    def told(rows: DataFrame, firsts: DataFrame, how: str = "left") -> DataFrame:
        return rows.join(firsts, match, how).drop(*keys.values())

    if groups.count() <= BROADCAST_GROUPS:
        return told(df, F.broadcast(lowest))
    hot = groups.where(F.col("_rows") > layout.hot_rows).drop("_rows")
    if not 0 < hot.count() <= BROADCAST_GROUPS:
        return told(df, lowest)
    hot = F.broadcast(hot)
    rest = df.join(hot.drop(name), match, "left_anti")
    return told(df, hot, "inner").unionByName(told(rest, lowest))


def add_step_features(
    df: DataFrame,
    by: Sequence[str] = (),
    layout: Layout = Layout(),
    carry: DataFrame | None = None,
    total_time: bool = True,
    snapshot: bool = False,
) -> DataFrame:
    """Add the step features to converted records; ``by`` names the columns that identify a test.

    A feature whose inputs are missing is left out. The summary pass runs at once, the features
    when the result is used. With ``snapshot`` both see the records of the summary pass, or the result fails.
    """
    present = set(df.columns)
    if "test_time" in present:
        if "seq_id" not in present:
            raise ValueError("step_count follows the order of seq_id, which is missing")
        rows = with_chunk(df, layout)
        more = [last_place(rows)] if snapshot else []
        summary = landed(summarise(rows, [*by, CHUNK], total_time, more), "chunk-summary")
        measured = measure(summary, by, layout)
        cold, hot = split_hot(rows, measured.hot, by)
        kept = summary.where(f"_rows <= {layout.hot_rows}")
        if snapshot:
            cold, hot = frozen(cold, kept, by, measured), frozen_hot(hot, summary, measured.hot, by)
        return number_steps(cold, kept, hot, by, layout, measured, carry, laid_out=snapshot, total_time=total_time).whole()

    # without test_time there is no running count; the other two need a minimum per group only
    if "seq_id" in present and "step_count" in present:
        df = _first_of_group(df, [*by, "step_count"], "seq_id", "_first", layout)
        df = df.withColumn("step_index", F.col("seq_id") - F.col("_first") + 1).drop("_first")
    if total_time and "unix_time" in present:
        df = _first_of_group(df, by, "unix_time", "_t0", layout)
        df = df.withColumn("test_totaltime", F.col("unix_time") - F.col("_t0")).drop("_t0")
    return df
