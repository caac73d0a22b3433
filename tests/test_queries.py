"""Every registered query against its SQL counterpart on DuckDB."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from checks.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(Path(SF).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(rows):
    return sorted(tuple(repr(v) if isinstance(v, float) else str(v) for v in row) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    expected = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    want = expected.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    got = df.select(*(f"`{c}`" for c in columns)).collect()
    assert comparable(got) == comparable(want)
    assert got or not want


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[:4] == ["dev_uid", "unit_id", "chl_id", "test_id"]
    assert len(df.columns) == 4 + 19
    assert df.count() > 0
