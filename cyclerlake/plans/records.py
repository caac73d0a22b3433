"""Which tables hold the records of a test, and how they are filtered.

A catalogue row names up to two tables for main and two for auxiliary records. The first table
is shared by many tests and filtered by identity. The second one, when it accompanies a first
one, belongs to the test as a whole and gets only the caller's filter.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclerlake.functions.predicates import column_list, pick, quoted
from cyclerlake.operators.unions import select_union
from cyclerlake.plans.cover import Cover, covers, key_values, within, without_narrow_gaps
from cyclerlake.session import landed
from cyclerlake.sources.catalogue import IDENTITY
from cyclerlake.sources.schemas import impose, record_schema
from cyclerlake.sources.tables import TABLE, Tables

Test = Mapping[str, Any]
Where = Mapping[str, Any] | None
RECORD_KEYS = ["unit_id", "chl_id", "test_id"]
TABLE_NAMES = ["main_first_table", "main_second_table", "aux_first_table", "aux_second_table"]


def by_identity(where: Where, test: Test) -> dict[str, Any]:
    """The caller's filter with the identity columns set to this test's."""
    return {**(where or {}), **{key: test[key] for key in RECORD_KEYS}}


def _routed(
    read: Callable[[str], DataFrame], first: str | None, second: str | None, test: Test, where: Where, columns
) -> DataFrame:
    own = by_identity(where, test)
    if first is not None and second is not None:
        return select_union(read(first), read(second), columns=columns, wheres=[own, where])
    return pick(read(first if first is not None else second), columns, own)


def main_records(
    read: Callable[[str], DataFrame],
    version: str,
    test: Test,
    where: Where = None,
    columns: str | Sequence[str] | None = None,
) -> DataFrame:
    """Raw main records of one test with their declared types. ``read`` is batch or streaming."""
    if test["main_first_table"] is None:
        raise ValueError("a test needs main_first_table")
    raw = _routed(read, test["main_first_table"], test.get("main_second_table"), test, where, columns)
    return impose(raw, record_schema(version, test["dev_uid"], "main"), column_list(columns))


def aux_records(
    read: Callable[[str], DataFrame],
    version: str,
    test: Test,
    where: Where = None,
    columns: str | Sequence[str] | None = None,
) -> DataFrame | None:
    """Raw auxiliary records of one test, ``None`` when it has no such table."""
    first, second = test.get("aux_first_table"), test.get("aux_second_table")
    if first is None and second is None:
        return None
    raw = _routed(read, first, second, test, where, columns)
    return impose(raw, record_schema(version, test["dev_uid"], "aux"), column_list(columns))


# ---------------------------------------------------------------------------------------------
# many tests at once


class FleetRoutes(NamedTuple):
    """Catalogue facts the driver needs: table names and, for tables owned by a test, its owner."""

    tests: DataFrame
    shared: dict[tuple[str, str, str], int]  # (device type, kind, table) -> number of tests
    owned: dict[tuple[str, str, str], list[Test]]  # (device type, kind, table) -> owners
    keys: dict[tuple[str, ...], Cover]  # (device type, kind, table, key) -> ranges that cover the tests' keys


# identity is four longs: a broadcast of this many tests stays below 10 MB
BROADCAST_TESTS = 100_000
SALTS = 256


# per test: the table filtered by identity and the table owned, for main and for aux records
ROUTE_COLUMNS = [
    "substring(CAST(dev_uid AS string), 1, 2) AS device",
    "main_first_table AS main_shared",
    "main_second_table AS main_owned",
    "coalesce(aux_first_table, aux_second_table) AS aux_shared",
    "CASE WHEN aux_first_table IS NOT NULL THEN aux_second_table END AS aux_owned",
]


def plan_routes(tests: DataFrame) -> FleetRoutes:
    """Read the table names from the catalogue.

    What reaches the driver is one row per record table, and one per test that owns a table of
    its own: a list of tables either way, like the table listing itself.
    """
    absent = {name: F.lit(None).cast("string") for name in TABLE_NAMES if name not in tests.columns}
    tests = tests.withColumns(absent) if absent else tests
    # equal rows are one test; _ways counts different ones of the same identity
    routes = F.expr(f"collect_set(struct({', '.join(TABLE_NAMES)})) AS _routes")
    tests = tests.groupBy(*IDENTITY).agg(routes).selectExpr(*IDENTITY, "_routes[0] AS _r", "size(_routes) AS _ways")
    # landed: all parts of the plan see one state of the catalogue, and it is read once
    tests = tests.select(*IDENTITY, "_r.*", "_ways").selectExpr(*IDENTITY, *ROUTE_COLUMNS, "_ways")
    tests = landed(tests, "tests")

    shared: dict[tuple[str, str, str], int] = {}
    owned: dict[tuple[str, str, str], list[Test]] = {}
    groups = tests.groupBy("device", "main_shared", "aux_shared").agg(
        F.expr("count(*) AS tests"),
        F.expr("max(_ways) AS ways"),
        F.expr("count(main_owned) + count(aux_owned) AS own"),
    )
    listed = groups.collect()
    if any(row["ways"] > 1 for row in listed):
        example = tests.where("_ways > 1").select(*IDENTITY).first()
        raise ValueError(f"tests must be unique by {IDENTITY}; repeated: {example.asDict()}")
    for row in listed:
        for kind in ("main", "aux"):
            if row[f"{kind}_shared"] is not None:
                key = (row["device"], kind, row[f"{kind}_shared"])
                shared[key] = shared.get(key, 0) + row["tests"]
    whole = [k for k in RECORD_KEYS if isinstance(tests.schema[k].dataType, T.IntegralType)]
    keys = covers(key_values(tests, whole)) if shared and whole else {}
    keys = {name: without_narrow_gaps(cover) for name, cover in keys.items()}
    if not any(row["own"] for row in listed):
        return FleetRoutes(tests, shared, owned, keys)
    owners = tests.where("main_owned IS NOT NULL OR aux_owned IS NOT NULL")
    for row in owners.toLocalIterator():
        for kind in ("main", "aux"):
            if row[f"{kind}_owned"] is not None:
                owned.setdefault((row["device"], kind, row[f"{kind}_owned"]), []).append(row.asDict())
    return FleetRoutes(tests, shared, owned, keys)


def tag_shared(records: DataFrame, tests: DataFrame, count: int, keys: Sequence[str] = RECORD_KEYS) -> DataFrame:
    """Keep the records of the given tests and put the tests' identity on them.

    A short list of tests is broadcast. A longer one is joined by shuffle with the records of a
    test spread over salts, as one test may hold a large share of all records.
    """
    if count <= BROADCAST_TESTS:
        return records.join(F.broadcast(tests), list(keys), "inner")
    salted = records.withColumn("_salt", F.expr(f"CAST(pmod(xxhash64(seq_id), {SALTS}) AS int)"))
    every = tests.withColumn("_salt", F.expr(f"explode(sequence(0, {SALTS - 1}))"))
    return salted.join(every, [*keys, "_salt"], "inner").drop("_salt")


def tag_owned(records: DataFrame, owners: Sequence[Test], types: T.StructType) -> DataFrame:
    """Put the identity of the owning test (the columns of ``types``) on all records of a table."""
    names = types.fieldNames()
    plain = [quoted(c) for c in records.columns if c not in names]
    literals = [[F.lit(test[f.name]).cast(f.dataType).alias(f.name) for f in types] for test in owners]
    if len(owners) == 1:
        return records.select(*plain, *literals[0])
    owned = records.select(*plain, F.explode(F.array(*(F.struct(*values) for values in literals))).alias("_owner"))
    return owned.select(*plain, "_owner.*")


def fleet_records(
    tables: Tables,
    version: str,
    routes: FleetRoutes,
    device: str,
    kind: str,
    columns: Sequence[str],
    where: Where = None,
) -> DataFrame | None:
    """Records of all tests of a device type: each table is read once for all its tests.

    Tables owned by single tests are one source where the collection can read them so, else a branch each.
    """
    schema = record_schema(version, device, kind)
    # shared tables are filtered by the tests' identity, which replaces the caller's
    where_shared = {k: v for k, v in (where or {}).items() if k not in RECORD_KEYS}
    wanted = [c for c in columns if c not in IDENTITY]
    tests = routes.tests.selectExpr("*", "aux_shared IS NOT NULL AS has_aux")
    carried = [*IDENTITY, "has_aux"]
    types = tests.select(*carried).schema
    parts = []
    for (dev, which, table), count in sorted(routes.shared.items()):
        if (dev, which) == (device, kind):
            # the join is exact; the ranges of the keys reach the scan and prune files and row groups
            records = tables.frame(table)
            for key in RECORD_KEYS:
                if (dev, which, table, key) in routes.keys:
                    records = records.where(within(key, routes.keys[dev, which, table, key]))
            records = pick(records, [*RECORD_KEYS, *wanted], where_shared)
            here = (F.col("device") == device) & (F.col(f"{kind}_shared") == table)
            named_here = tests.where(here).select(*carried)
            parts.append(tag_shared(impose(records, schema), named_here, count))
    owned = {table: owners for (dev, which, table), owners in sorted(routes.owned.items()) if (dev, which) == (device, kind)}
    joint = tables.together(list(owned)) if owned else None
    if joint is not None:
        # one scan, whatever the number of tables
        records = impose(pick(joint, [*wanted, TABLE], where), schema)
        own = F.col(f"{kind}_owned")
        owners = tests.where((F.col("device") == device) & own.isNotNull()).select(*carried, own.alias(TABLE))
        parts.append(tag_shared(records, owners, sum(map(len, owned.values())), [TABLE]).drop(TABLE))
        owned = {}
    for table, owners in owned.items():
        records = pick(tables.frame(table), wanted, where)
        flagged = [{**owner, "has_aux": owner["aux_shared"] is not None} for owner in owners]
        parts.append(tag_owned(impose(records, schema), flagged, types))
    if not parts:
        return None
    return select_union(*parts, columns=[*carried, *wanted])
