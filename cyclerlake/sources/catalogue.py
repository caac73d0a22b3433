"""Server version and the catalogue of tests."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cyclerlake.operators.places import with_places
from cyclerlake.operators.unions import union_all_columns
from cyclerlake.sources.tables import Tables

IDENTITY = ["dev_uid", "unit_id", "chl_id", "test_id"]


def server_version(tables: Tables) -> str:
    """The single version the database declares."""
    found = tables.get_table("db_ver", "version").distinct().limit(3).collect()
    if len(found) != 1:
        raise ValueError(f"expected exactly one version in db_ver, found {[row[0] for row in found]}")
    return str(found[0][0])


def _tests_0760(tables: Tables) -> DataFrame:
    tests = union_all_columns([tables.get_table("test"), tables.get_table("h_test")])
    notes = tables.get_table("test_note")
    clashes = {c: f"{c}_right" for c in notes.columns if c in tests.columns and c not in IDENTITY}
    return tests.join(notes.withColumnsRenamed(clashes), IDENTITY, "left").select(
        *tests.columns, *(clashes.get(c, c) for c in notes.columns if c not in IDENTITY)
    )


def _tests_0800(tables: Tables) -> DataFrame:
    history = sorted(name for name in tables.names() if name.startswith("h_test"))
    return union_all_columns([tables.get_table(name) for name in ["test", *history]])


CATALOGUES = {"0760": _tests_0760, "0800": _tests_0800}


def supported_version(tables: Tables) -> str:
    version = server_version(tables)
    if version not in CATALOGUES:
        raise ValueError(f"unsupported server version {version!r}, known: {sorted(CATALOGUES)}")
    return version


def unordered_tests(tables: Tables, version: str) -> DataFrame:
    return CATALOGUES[version](tables)


def tests(tables: Tables, version: str) -> DataFrame:
    """One row per test, ordered by identity. The order costs a range shuffle of this table only."""
    return unordered_tests(tables, version).orderBy(*IDENTITY)


def placed_tests(tables: Tables, version: str) -> DataFrame:
    """The same with the order as a column, ``place`` from 0, which survives further operations."""
    return with_places(unordered_tests(tables, version), IDENTITY)
