"""The registered queries over the smallest tables, against DuckDB or a plain version."""

from __future__ import annotations

import importlib
import os

import pandas as pd
import pytest

from clientela.llm import queries, sql

duckdb = pytest.importorskip("duckdb")
entry = importlib.import_module("__spark_entry__")


def comparable(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_against_sql(spark, testdata, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{testdata}/{table}.parquet'")
    cursor = connection.execute(sql.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    found = entry.queries()[name](spark, testdata)
    assert sorted(found.columns) == sorted(columns)
    assert comparable(found.select(*columns).collect()) == comparable(cursor.fetchall())


def test_every_operator_is_registered():
    assert [q.split("_")[0] for q in queries.QUERIES if q.startswith("op")] and {
        q.split("_")[0] for q in queries.QUERIES
    } == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_language_of_held_out_documents(spark, testdata):
    found = entry.queries()["op5_language"](spark, testdata).toPandas()
    docs = pd.read_parquet(os.path.join(testdata, "documents.parquet"))
    both = found[found.held_out].merge(docs, on="doc_id")
    assert (both.lang == both.lang_pred).mean() > 0.97


def test_quality_of_labelled_documents(spark, testdata):
    found = entry.queries()["op6_quality_trees"](spark, testdata).toPandas()
    labels = pd.read_parquet(os.path.join(testdata, "labels.parquet"))
    both = found[~found.base_failed].merge(labels, on="doc_id")
    assert ((both.quality == 1) == both.kept).mean() > 0.95


def test_nearest_of_all_vectors(spark, testdata):
    found = entry.queries()["op7_nearest_vectors"](spark, testdata).collect()
    vectors = pd.read_parquet(os.path.join(testdata, "embeddings.parquet"))
    asked = vectors.vec_id[vectors.vec_id % 20 == 0]
    assert {r.query_id for r in found} == set(asked)
    assert len(found) == len(asked) * min(20, len(vectors) - 1)


def test_preference_on_held_out_documents(spark, testdata):
    found = entry.queries()["op12_preference_score"](spark, testdata).toPandas()
    docs = pd.read_parquet(os.path.join(testdata, "documents.parquet"))
    labels = pd.read_parquet(os.path.join(testdata, "labels.parquet"))
    assert sorted(found.doc_id) == sorted(docs.doc_id)
    assert found.score.between(0, 1).all()
    assert (found.predicted == (found.score >= 0.5)).all()
    held = found[found.held_out].merge(labels, on="doc_id")
    assert len(held) > 10 and (held.predicted == held.quality).mean() > 0.95
