"""The ``where`` notation and the projection argument shared by every reader.

``where`` maps a column to one of

* ``(lo, hi)``    closed range; either end may be ``None`` for an open end
* ``[v, ...]``    membership
* ``None``        the column is null
* ``v``           equality

All entries are combined with AND. Everything becomes plain column comparisons, so the
whole predicate reaches the file or JDBC scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Reference to a column in SQL text, whatever characters its name holds."""
    return "`" + name.replace("`", "``") + "`"


def _single(name: str, want: Any) -> Column:
    column = F.col(quoted(name))
    if want is None:
        return column.isNull()
    if isinstance(want, list):
        return column.isin(want)
    if not isinstance(want, tuple):
        return column == F.lit(want)
    if len(want) != 2 or want == (None, None):
        raise ValueError(f"range for {name!r} must be (lo, hi) with at least one end, got {want!r}")
    lo, hi = want
    if hi is None:
        return column >= F.lit(lo)
    if lo is None:
        return column <= F.lit(hi)
    return column.between(F.lit(lo), F.lit(hi))


def condition(where: Mapping[str, Any] | None) -> Column | None:
    """Conjunction of all entries, or ``None`` when there is nothing to filter."""
    if not where:
        return None
    return reduce(and_, (_single(name, want) for name, want in where.items()))


def column_list(columns: str | Sequence[str] | None) -> list[str] | None:
    if columns is None:
        return None
    return [columns] if isinstance(columns, str) else list(columns)


def pick(
    df: DataFrame,
    columns: str | Sequence[str] | None = None,
    where: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Filter, then project: ``where`` may use columns that are not projected."""
    keep = condition(where)
    if keep is not None:
        df = df.where(keep)
    names = column_list(columns)
    return df if names is None else df.select(*map(quoted, names))
