"""Every registered query against its SQL in DuckDB, over the smallest tables."""

import datetime as dt
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from feedqueries import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if isinstance(value, float):
        return value + 0.0
    return value.replace(tzinfo=None) if isinstance(value, dt.datetime) else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    expected = duck.sql(ORACLES[name])
    assert table(df.columns, df.collect()) == table(expected.columns, expected.fetchall())


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(contract.queries()) >= set(QUERIES) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
