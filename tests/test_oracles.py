"""Every named query against DuckDB on the generated tables."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as contract
from clickmetrics.plans.oracles import ORACLES
from clickmetrics.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
TABLES = ["region", "nation", "part", "events"]


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield db
    db.close()


def rows(columns, data):
    """Order-free rows with columns sorted by name and times as naive UTC."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        tuple(v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v for v in (r[i] for i in order))
        for r in data
    )


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR)
    want = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    expected = rows(columns, want.fetchall())
    assert expected
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
