"""Results of all queries of the segmentation against DuckDB."""

from __future__ import annotations

import importlib

import pytest

from clientela.plans import check_sql

duckdb = pytest.importorskip("duckdb")
entry = importlib.import_module("__spark_entry__")

TABLES = ("customer", "lineitem", "orders", "part")


def comparable(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(check_sql.oracle_sql()))
def test_query(spark, testdata, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{testdata}/{table}.parquet'")
    cursor = connection.execute(check_sql.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    df = entry.queries()[name](spark, testdata)
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.select(*columns).collect()) == comparable(expected)


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark, testdata):
    assert entry.entry(spark).columns == ["customer_id", "feature_name", "feature_value"]
