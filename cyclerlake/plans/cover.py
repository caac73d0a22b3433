"""Few ranges that cover the keys of many tests.

A fleet may be tests 1 and 1,000,000; the range between them is nearly the whole table. So the sorted
values of a key are cut at their widest gaps into at most ``ranges`` ranges, which reach the scan
as comparisons and prune files and row groups. The join with the tests stays exact: a cover decides what
is read, never a result.

Gaps are found by Spark in two levels: within buckets of equal width, and between the ends of
neighbouring buckets, so that no window holds all tests. What reaches the driver is the ends and the widest
gaps of each key and record table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGES = 16
BUCKETS = 1024
# a cut spares one part in so many at least
SPARED = 100
GROUP = ["device", "kind", "record_table", "key"]

Cover = list[tuple[int, int]]


def covers(values: DataFrame, ranges: int = RANGES, buckets: int = BUCKETS) -> dict[tuple[str, ...], Cover]:
    """Ranges by ``GROUP`` of a frame with these columns and ``value``, a bigint."""
    group = ", ".join(GROUP)
    values = values.where("value IS NOT NULL").distinct()
    ends = values.groupBy(*GROUP).agg(F.expr("min(value) AS low"), F.expr("max(value) AS high"))
    # in decimals: the distance of two bigints may exceed one
    width = f"CAST(ceil((CAST(high AS decimal(20, 0)) - low + 1) / {buckets}) AS decimal(20, 0))"
    placed = values.join(ends, GROUP).selectExpr(*GROUP, "value", f"CAST((CAST(value AS decimal(20, 0)) - low) div {width} AS bigint) AS bucket")
    within = placed.selectExpr(*GROUP, f"lag(value) OVER (PARTITION BY {group}, bucket ORDER BY value) AS before", "value AS after")
    bounds = placed.groupBy(*GROUP, "bucket").agg(F.expr("min(value) AS low"), F.expr("max(value) AS high"))
    between = bounds.selectExpr(*GROUP, f"lag(high) OVER (PARTITION BY {group} ORDER BY bucket) AS before", "low AS after")
    gaps = within.unionByName(between).selectExpr("*", "CAST(after AS decimal(20, 0)) - before AS gap").where("gap > 1")
    place = f"row_number() OVER (PARTITION BY {group} ORDER BY gap DESC, before) AS place"
    widest = gaps.selectExpr("*", place).where(f"place < {ranges}")
    cuts: dict[tuple[str, ...], Cover] = {}
    for row in widest.select(*GROUP, "before", "after").collect():
        cuts.setdefault(tuple(row[c] for c in GROUP), []).append((row["before"], row["after"]))
    out = {}
    for row in ends.collect():
        name = tuple(row[c] for c in GROUP)
        found = sorted(cuts.get(name, []))
        out[name] = list(zip([row["low"], *(after for _, after in found)], [*(before for before, _ in found), row["high"]]))
    return out


def without_narrow_gaps(cover: Cover) -> Cover:
    """The ranges with those joined whose gap is below a hundredth of the span.

    Such a gap prunes next to nothing, but every record is compared with its ends, which costs most where the key is computed.
    """
    span = cover[-1][1] - cover[0][0]
    out = cover[:1]
    for low, high in cover[1:]:
        if (low - out[-1][1]) * SPARED > span:
            out.append((low, high))
        else:
            out[-1] = (out[-1][0], high)
    return out


def within(key: str, cover: Cover) -> Column:
    """Whether a key lies in one of the ranges."""
    return reduce(or_, (F.col(key) == F.lit(low) if low == high else F.col(key).between(F.lit(low), F.lit(high)) for low, high in cover))


def key_values(tests: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the tests by record table, for ``covers``. ``tests`` has device, main_shared and aux_shared."""
    tables = "explode(array(struct('main' AS kind, main_shared AS record_table), struct('aux' AS kind, aux_shared AS record_table))) AS t"
    each = ", ".join(f"struct('{k}' AS key, CAST({k} AS bigint) AS value)" for k in keys)
    named = tests.selectExpr("device", *keys, tables).where("t.record_table IS NOT NULL")
    return named.selectExpr("device", "t.kind", "t.record_table", f"explode(array({each})) AS k").selectExpr("device", "kind", "record_table", "k.key", "k.value")
