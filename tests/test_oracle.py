"""Every query over events against its SQL, on the smallest test folder."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{FOLDER}/events.parquet')")
    return connection


def test_every_query_has_sql():
    assert contract.core_queries().keys() == contract.core_sql().keys()


def in_order(rows):
    return sorted(rows, key=lambda row: [(v is not None, v) for v in row])


@pytest.mark.parametrize("name", contract.core_queries())
def test_query_equals_sql(spark, database, name):
    frame = contract.core_queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    cursor = database.execute(contract.core_sql()[name])
    names = [d[0] for d in cursor.description]
    kinds = dict(zip(names, [str(d[1]) for d in cursor.description]))
    assert sorted(names) == columns
    assert {c: SQL_TYPES[t] for c, t in frame.dtypes} == kinds
    expected = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    assert in_order(tuple(r) for r in frame.select(*columns).collect()) == in_order(expected)


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["week_start", "wau_by_user", "wau_by_session", "week_type"]
    assert frame.count() == 5
