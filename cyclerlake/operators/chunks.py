"""Splitting a test into chunks of consecutive records.

A test can be arbitrarily long, so nothing here is ever grouped by test alone except
per-chunk summaries. A chunk is ``chunk_records`` consecutive values of ``seq_id``; its key is
computed from the row, so any retry of a task finds the same chunk.

Chunks normally hold about ``chunk_records`` rows. One can still be far larger when a single
``seq_id`` repeats without end (copies of a record, null ids, endless channels). Those *hot*
chunks are found by counting and take a separate path that splits them further.

A join can be large where neither side is: copies of an id times channels of that id. The sum over
ids of main rows times auxiliary rows is at most the root of the product of the sides' sums of
squares. Those are estimated from sums of signs, one sign per id and column, which add up in
partial aggregates like counts do (the estimate is exact where one id outweighs the others). What
is found this way decides how work is spread, never a result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclerlake.functions.predicates import quoted

CHUNK = "_chunk"
COPIES = "_copies"
BLOCK = 100_000
SIDE = "_side"
# beyond so many tasks each has so many rows at least, whatever a layout asks for: in a shuffle every task of one side
# meets every task of the other, so tiny tasks would cost the square of their number
FEW_TASKS = 200
LEAST_TASK_ROWS = 50_000
SIGNS = [f"_sign{i}" for i in range(8)]


class Layout(NamedTuple):
    """``hot_rows`` also bounds the list of hot chunks: at most total rows / hot_rows entries.

    Beyond ``block_chunks`` chunks, running totals are taken over blocks of so many chunks first.
    """

    chunk_records: int = 200_000
    hot_rows: int = 10_000_000
    task_rows: int = 2_000_000
    block_chunks: int = 4096


def with_chunk(df: DataFrame, layout: Layout) -> DataFrame:
    return df.selectExpr("*", f"seq_id - pmod(seq_id, {layout.chunk_records}L) AS {CHUNK}")


def sign_sums() -> list[Column]:
    """Sums of signs that depend on the id; the mean of their squares estimates the sum of squared rows per id."""
    return [F.expr(f"sum(2L * getbit(xxhash64(seq_id), {i}) - 1L) AS {name}") for i, name in enumerate(SIGNS)]


def chunk_counts(df: DataFrame, by: Sequence[str], more: Sequence[Column] = ()) -> DataFrame:
    """Rows per chunk; combined on the map side, so only summaries are shuffled."""
    return df.groupBy(*by, CHUNK).agg(F.expr("count(*) AS _rows"), *sign_sums(), *more)


def both_sides(main: DataFrame, aux: DataFrame) -> DataFrame:
    """Summaries of the two sides of a join, one row per chunk and side."""
    main, aux = main.selectExpr("*", f"'main' AS {SIDE}"), aux.selectExpr("*", f"'aux' AS {SIDE}")
    return main.unionByName(aux, allowMissingColumns=True)


def joined_counts(sides: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per chunk the rows of the larger side or of the join, whichever are more."""
    squares = " + ".join(f"CAST({c} AS double) * {c}" for c in SIGNS)
    size = {side: f"sum(CASE WHEN {SIDE} = '{side}' THEN ({squares}) / {len(SIGNS)} END)" for side in ("main", "aux")}
    product = f"coalesce(CAST(sqrt({size['main']} * {size['aux']}) AS bigint), 0L)"
    return sides.groupBy(*by, CHUNK).agg(F.expr(f"greatest(max(_rows), {product}) AS _rows"), F.expr(f"{product} AS _joined"))


class Measured(NamedTuple):
    """The hot chunks, if any, and the number of partitions, if the configured one is too small.

    ``hot`` says in ``_cuts`` into how many parts each side of a join is cut.
    """

    hot: DataFrame | None
    partitions: int | None
    chunks: int = 0
    hot_parts: int = 1

    def lay_out(self, df: DataFrame, place: Sequence[str]) -> DataFrame:
        return df.repartition(*place) if self.partitions is None else df.repartition(self.partitions, *place)


def _tasks(rows: int, layout: Layout) -> int:
    """Tasks for so many rows."""
    return min(-(-rows // layout.task_rows), max(FEW_TASKS, -(-rows // LEAST_TASK_ROWS)))


def measure(counts: DataFrame, by: Sequence[str], layout: Layout) -> Measured:
    """Look at landed row counts per chunk."""
    too_many = f"sum(CASE WHEN _rows > {layout.hot_rows} THEN _rows END)"
    found = ["sum(_rows)", "max(_rows)", "count(*)", too_many]
    rows, largest, chunks, hot_rows = counts.agg(*(F.expr(f"coalesce({text}, 0)") for text in found)).first()
    hot = None
    if largest > layout.hot_rows:
        joined = "_joined" if "_joined" in counts.columns else "0L"
        cuts = F.expr(f"CAST(ceil(sqrt(max({joined}) / {layout.task_rows})) AS bigint)")
        hot = counts.where(f"_rows > {layout.hot_rows}").groupBy(*by, CHUNK).agg(F.greatest(cuts, F.lit(1)).alias("_cuts"))
    needed = _tasks(rows, layout)
    configured = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot_parts = max(configured, _tasks(hot_rows, layout))
    return Measured(hot, needed if needed > configured else None, chunks, hot_parts)


def split_hot(df: DataFrame, hot: DataFrame | None, by: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows outside and inside the hot chunks.

    The list is broadcast: every entry stands for more than ``Layout.hot_rows`` rows, so it
    stays below a megabyte for a hundred billion rows.
    """
    if hot is None:
        return df, None
    keys = [*by, CHUNK]
    listed = F.broadcast(hot.selectExpr(*(f"{k} AS _hot_{k}" for k in keys)))
    match = F.expr(" AND ".join(f"{k} <=> _hot_{k}" for k in keys))
    return df.join(listed, match, "left_anti"), df.join(listed, match, "left_semi")


def content(df: DataFrame) -> list[str]:
    """The columns that can be hashed and compared."""
    return [quoted(f.name) for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def cut_side(df: DataFrame, hot: DataFrame, by: Sequence[str], own: str, other: str) -> DataFrame:
    """Rows of hot chunks with the numbers ``own``, by content, and every ``other``.

    When both sides are cut so, each pair of rows meets in one cell of the chunk's grid.
    """
    keys = [*by, CHUNK]
    listed = F.broadcast(hot.selectExpr(*(f"{k} AS _hot_{k}" for k in keys), "_cuts"))
    match = F.expr(" AND ".join(f"{k} <=> _hot_{k}" for k in keys))
    cells = [f"pmod(xxhash64({', '.join(content(df))}), _cuts) AS {own}", f"explode(sequence(0L, _cuts - 1)) AS {other}"]
    return df.join(listed, match).selectExpr(*map(quoted, df.columns), *cells)


def collapse_copies(df: DataFrame) -> DataFrame:
    """Equal rows become one row with a count, so that no number of copies is ever one task's load."""
    if COPIES in df.columns:
        return df
    return df.groupBy(*map(quoted, df.columns)).agg(F.expr(f"count(*) AS {COPIES}"))


def expand_copies(df: DataFrame, keep_number: str | None = None, partitions: int | None = None) -> DataFrame:
    """Undo ``collapse_copies``, in blocks that spread over tasks.

    ``keep_number`` names a column for the running number (from 1) of each copy.
    """
    rows = [quoted(c) for c in df.columns]
    blocks = df.selectExpr(*rows, f"explode(sequence(0L, ({COPIES} - 1) div {BLOCK})) AS _block")
    low = f"_block * {BLOCK}"
    # the rows differ, so their content spreads them, also those of one id
    spread = Measured(None, partitions).lay_out(blocks, content(blocks))
    copies = spread.selectExpr(*rows, f"explode(sequence({low} + 1, least({low} + {BLOCK}, {COPIES}))) AS _copy")
    return copies.withColumnRenamed("_copy", keep_number) if keep_number else copies.drop("_copy", COPIES)
