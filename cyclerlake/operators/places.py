"""The place of every row in an order, as a column.

Rows are laid out by ranges of the order and landed; a row's place is the number of rows in the
partitions before its own, from counts per partition and their prefix sums, and its number within the
partition. No window holds more than a row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclerlake.functions.predicates import quoted
from cyclerlake.session import landed

ROW = "_row"
# monotonically increasing ids: the number within a partition is in the lower bits
WITHIN = 33


def with_places(df: DataFrame, order: Sequence[str] = (), name: str = "place") -> DataFrame:
    """Adds the running number of each row, from 0, in the given order (nulls first) or as the rows lie.

    Rows that are equal in ``order`` follow each other in any order. The frame is computed once, at the call.
    """
    columns = [quoted(c) for c in df.columns]
    keys = [F.col(quoted(c)) for c in order]
    if keys:
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = landed(df.withColumn(ROW, F.monotonically_increasing_id()), "places")
    part = f"shiftright({ROW}, {WITHIN})"
    counts = rows.groupBy(F.expr(f"{part} AS _part")).agg(F.expr("count(*) AS _n"))
    before = counts.selectExpr("_part", "sum(_n) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - _n AS _before")
    # a row per partition
    placed = rows.selectExpr("*", f"{part} AS _part").join(F.broadcast(before), "_part")
    return placed.selectExpr(*columns, f"_before + ({ROW} & {2**WITHIN - 1}L) AS {quoted(name)}")
