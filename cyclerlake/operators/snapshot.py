"""One state of tables that are still written to.

A narrow pass summarises every chunk, a wide pass reads the records again. What a tester writes in
between must not shift numbers. So the narrow pass also notes each chunk's high-water mark, the
last place (``seq_id``, then channel) it saw there, and its number of records. The wide pass cuts every chunk at
its mark and counts: records behind the marks are left out, in chunks and tests that are new too, and
a chunk that has more or fewer records up to its mark than before is an error. So the result is the state
of the narrow pass or none. Values that are changed in place are not noticed.

The marks enter the chunks as one extra row each, so no table of marks is broadcast and the layout
that the join and the numbering need anyway is used. A chunk's count is a window over that chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclerlake.functions.predicates import quoted
from cyclerlake.operators.chunks import CHUNK, Measured
from cyclerlake.session import landed

LIMIT = "_limit"
EXPECTED = "_rows"
CHANGED = "records changed while they were read"


class ChangedRecordsError(RuntimeError):
    """Records came or went before a place that had been read already."""


def _place(df: DataFrame) -> str:
    channel = "CAST(auxchl_id AS bigint)" if "auxchl_id" in df.columns else "CAST(NULL AS bigint)"
    return f"struct(CAST(seq_id AS bigint) AS seq_id, {channel} AS channel)"


def last_place(df: DataFrame) -> Column:
    """The high-water mark, to be aggregated with the other summaries of a chunk."""
    return F.expr(f"max({_place(df)}) AS {LIMIT}")


def frozen(rows: DataFrame, marks: DataFrame, by: Sequence[str], measured: Measured) -> DataFrame:
    """The rows up to the marks, laid out by chunk. ``marks`` has ``_rows`` and ``_limit`` per chunk."""
    keys = [CHUNK, *reversed(by)]
    place = f"CASE WHEN _mark IS NULL THEN {_place(rows)} END"
    columns = [quoted(c) for c in rows.columns]
    marks = marks.selectExpr(*keys, f"{EXPECTED} AS _expected", LIMIT, "true AS _mark")
    marked = measured.lay_out(rows, keys).unionByName(measured.lay_out(marks, keys), allowMissingColumns=True)
    chunk = f"OVER (PARTITION BY {', '.join(keys)})"
    marked = marked.selectExpr(*columns, "_mark", f"{place} AS _place", f"max({LIMIT}) {chunk} AS _until", f"max(_expected) {chunk} AS _expected")
    counted = marked.selectExpr("*", f"count_if(_mark IS NULL AND _place <= _until) {chunk} AS _seen")
    kept = f"CASE WHEN _seen <> _expected THEN CAST(raise_error('{CHANGED}') AS boolean) ELSE _mark IS NULL AND _place <= _until END"
    # the second term keeps the optimizer from putting other conditions first, which the row of a mark may fail
    return counted.where(F.expr(f"{kept} AND rand() >= 0")).selectExpr(*columns)


def frozen_hot(rows: DataFrame | None, marks: DataFrame, hot: DataFrame | None, by: Sequence[str]) -> DataFrame | None:
    """The rows of hot chunks up to the marks; they are landed and counted at once.

    ``hot`` lists the hot chunks, a bounded number (see ``split_hot``).
    """
    if rows is None or hot is None:
        return None
    keys = [*by, CHUNK]
    listed = hot.selectExpr(*(f"{k} AS _hot_{k}" for k in keys))
    same = F.expr(" AND ".join(f"{k} <=> _hot_{k}" for k in keys))
    few = marks.join(F.broadcast(listed), same).select(*(F.col(k).alias(f"_of_{k}") for k in keys), F.col(EXPECTED).alias("_expected"), LIMIT)
    match = F.expr(" AND ".join(f"{k} <=> _of_{k}" for k in keys))
    cut = rows.join(F.broadcast(few), match).where(f"{_place(rows)} <= {LIMIT}")
    cut = landed(cut.selectExpr(*map(quoted, rows.columns)), "hot-frozen")
    counts = cut.groupBy(*keys).agg(F.expr("count(*) AS _seen"))
    changed = few.join(counts, match, "left").where("_expected <> coalesce(_seen, 0L)")
    if changed.limit(1).count():
        raise ChangedRecordsError(CHANGED)
    return cut
