"""The text queries that SQL can express, against their SQL."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from tidemark.llm import queries

FOLDER = "/root/testdata/sf0.001"


def in_order(rows):
    return sorted(rows, key=lambda row: [(v is not None, v) for v in row])


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    frame = queries.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    cursor = database.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    assert in_order(tuple(r) for r in frame.select(*columns).collect()) == in_order(expected)


def test_all_operators_are_registered():
    numbers = {int(name[2:].split("_")[0]) for name in queries.queries()}
    assert numbers == set(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "exact dedup", "SimHash near-dedup", "decontamination", "SentencePiece",
    ]
