"""Unions of record tables (same columns) and of catalogue tables (any columns)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclerlake.functions.predicates import column_list, pick, quoted


def select_union(
    *frames: DataFrame,
    columns: str | Sequence[str] | None = None,
    wheres: Sequence[Mapping[str, Any] | None] | Mapping[str, Any] | None = None,
) -> DataFrame:
    """UNION ALL with one filter for all inputs or one per input; duplicates are kept.

    Several inputs without ``columns`` yield their common columns in alphabetical order; a
    single input keeps its own columns and order.
    """
    filters = [wheres] * len(frames) if wheres is None or isinstance(wheres, Mapping) else list(wheres)
    if len(filters) != len(frames):
        raise ValueError(f"{len(frames)} tables but {len(filters)} filters")
    names = column_list(columns)
    if len(frames) > 1 and names is None:
        names = sorted(set.intersection(*(set(frame.columns) for frame in frames)))
    parts = [pick(frame, names, keep) for frame, keep in zip(frames, filters)]
    return parts[0] if len(parts) == 1 else union_all_columns(parts)


def union_all_columns(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name keeping every column; what an input lacks is null and types widen.

    Numbers widen among themselves. A column that is text in any input is text in the result.
    """
    types: dict[str, set[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema:
            types.setdefault(field.name, set()).add(field.dataType)
    text = {n for n, kinds in types.items() if len(kinds) > 1 and any(isinstance(k, T.StringType) for k in kinds)}

    def as_text(frame: DataFrame) -> DataFrame:
        mixed = {f.name for f in frame.schema if f.name in text and not isinstance(f.dataType, T.StringType)}
        if not mixed:
            return frame
        return frame.withColumns({name: F.col(quoted(name)).cast("string") for name in mixed})

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(as_text, frames))


def with_typed_nulls(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Set columns to null of the given type."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in columns.items()})
