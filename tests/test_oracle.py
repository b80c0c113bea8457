"""Every registered query against its SQL counterpart at the smallest scale."""

from __future__ import annotations

import os

import duckdb
import pytest

from verification.oracle import ORACLE
from verification.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in sorted(os.listdir(FOLDER)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def sorted_rows(records):
    return sorted(records, key=lambda record: [(value is None, str(value)) for value in record])


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = [tuple(row[column] for column in columns) for row in df.collect()]
    cursor = database.execute(ORACLE[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    theirs = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    assert sorted_rows(ours) == sorted_rows(theirs)
