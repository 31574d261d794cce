"""Language, quality and nearest vectors."""

from __future__ import annotations

import math

import llm_tables as tables
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clientela.llm import ann, boosting, langid, quality


@pytest.fixture(scope="module")
def labelled(spark):
    rows = []
    for k in range(300):
        words = (("the", "and", "ing", "of"), ("der", "und", "ung", "von"))[k % 2]
        text = " ".join(words[(k * j) % 4] + words[(k + j) % 4] for j in range(1, 20 + k % 30))
        rows.append((k, text, ("en", "de")[k % 2], "a", 1))
    return tables.documents(spark, rows)


def test_language_held_out(spark, labelled):
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = langid.fit(labelled, ~held)
    assert model.names == ("de", "en") and model.temperature >= 1
    assert (model.weights == 0).mean() > 0.5
    told = langid.with_language(labelled, model).filter(held).collect()
    assert len(told) > 50
    assert sum(r.lang_pred == r.lang for r in told) / len(told) > 0.98
    assert all(0 <= r.score <= 1 for r in told)


def test_rare_languages_are_learned_from_large_tables(spark, labelled):
    common = spark.range(9_000).select(
        "id", F.concat_ws(" ", *(F.lit("the and ing of"), (F.col("id") % 97).cast("string"))),
        F.lit("en"), F.lit("a"), F.lit(1).cast("long"),
    ).toDF(*labelled.columns)
    rare = [(20_000 + k, f"zażółć gęślą jaźń źdźbło {k}", "pl", "a", 1) for k in range(2)]
    rare += [(30_000, f"şöyle böyle ığdır {k}", "tr", "a", 1) for k in range(500)]  # one doc_id
    docs = common.union(tables.documents(spark, rare))
    cfg = langid.LangConfig(sample_rows=100, language_rows=20)
    model = langid.fit(docs, cfg=cfg)
    assert model.names == ("en", "pl", "tr")
    told = langid.with_language(docs.filter("doc_id >= 20000"), model).collect()
    assert all(r.lang_pred == r.lang for r in told)


def test_prediction_looks_at_the_text_alone(labelled):
    model = langid.fit(labelled)
    other = labelled.withColumns({"lang": F.lit("xx"), "source": F.lit("s"), "doc_id": F.lit(1)})
    keys = ["text", "lang_pred", "score"]
    a, b = (langid.with_language(d, model).select(keys) for d in (labelled, other))
    assert tables.rows_of(a) == tables.rows_of(b)


def test_language_of_odd_rows(spark, labelled):
    model = langid.fit(labelled)
    docs = tables.with_clashes(tables.documents(spark), "place", "found")
    told = langid.with_language(docs, model).collect()
    assert len(told) == len(tables.ODD)
    for row in told:
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred == "und") == (not letters)
        assert letters or row.score == 0
    empty = langid.fit(tables.documents(spark, []))
    assert {r.lang_pred for r in langid.with_language(docs, empty).collect()} == {"und"}
    assert langid.with_language(tables.documents(spark, []), model).collect() == []


def test_language_frequencies_count_all_rows(labelled):
    cfg = langid.LangConfig()
    counted, rows = langid.document_frequencies(labelled, cfg)
    texts = pa.array([r.text for r in labelled.select("text").collect()])
    plain = np.zeros(cfg.features, np.int64)
    for found, _ in langid._features(texts, cfg):
        plain[found] += 1
    assert rows == 300 and (plain == counted).all()


def plain_counts(text):
    text = text or ""
    words = tables.WORD.findall(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if tables.WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_quality_counts_of_odd_rows(spark):
    extra = [
        (20, "a b c a b c a b c", None, None, 1), (21, "x x x x", None, None, 1),
        (22, "# a\n# a\n \n \n# a", None, None, 1), (23, "p q r\x1cs t p q r\x1cs t", None, None, 1),
        (24, "é&ü <x> |é&ü|", None, None, 1),
    ]
    rows = [r if r[0] != 5 else (5, r[1][:3000], *r[2:]) for r in tables.ODD] + extra
    docs = tables.with_clashes(tables.documents(spark, rows), "n_words", "kept", "score")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality.judge_quality(docs, labels)
    got = sorted(
        ((r.doc_id, *(r[c] for c in quality.COUNTS[:5]), r.base_failed, r.kept)
         for r in found.collect()), key=repr
    )
    expected = []
    for doc_id, text, *_ in rows:
        counts = plain_counts(text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        expected.append((doc_id, *counts, failed, not failed))
    assert got == sorted(expected, key=repr)
    assert quality.judge_quality(tables.documents(spark, []), labels).collect() == []


def test_quality_trees_learn_labels(spark):
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for k in range(400):
        words = [f"w{j}" for j in rng.integers(0, 5000, 80)]
        if k % 4 == 0:
            words = [w + "%%%" for w in words]
        rows.append((k, " ".join(words), "en", "a", 1))
        labels.append((k, int(k % 4 != 0), 0))
    labels += [(None, 1, 0), (3, None, 0), (5, 1, 0)]
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = quality.judge_quality(tables.documents(spark, rows), told).collect()
    assert all(r.kept == (r.doc_id % 4 != 0) for r in found)


def plain_margin(trees, row):
    total = trees.base
    for node in trees.roots.tolist():
        while trees.left[node] != node:
            side = trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right
            node = int(side[node])
        total += trees.value[node]
    return total


def test_flat_trees_are_the_trees_and_monotonic():
    rng = np.random.default_rng(1)
    rows = rng.random((600, 3))
    good = (rows[:, 0] + np.sin(9 * rows[:, 1]) + 0.3 * rng.random(600) > 1).astype(float)
    trees = boosting.fit(rows, good, np.array([1, 0, -1]), boosting.BoostConfig(trees=20))
    margins = trees.margin(rows[:50])
    assert np.allclose(margins, [plain_margin(trees, r) for r in rows[:50]])
    assert ((margins > 0) == (good[:50] > 0)).mean() > 0.9
    for feature, sign in ((0, 1), (2, -1)):
        grid = np.repeat(rows[:40], 30, axis=0)
        grid[:, feature] = np.tile(np.linspace(0, 1, 30), 40)
        steps = np.diff(trees.margin(grid).reshape(40, 30), axis=1)
        assert (sign * steps >= -1e-12).all()


def neighbours(rows, k):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float64)
    for at in np.flatnonzero(ids % 20 == 0):
        score = (vectors[at] * vectors).sum(1)
        order = sorted((j for j in range(len(ids)) if j != at), key=lambda j: (-score[j], ids[j]))
        for rank, j in enumerate(order[:k], 1):
            yield (int(ids[at]), rank, int(ids[j]), float(score[j]))


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_nearest_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(k, [float(np.float32(x)) for x in rng.normal(size=6)]) for k in range(90)]
    good += [(k, good[7][1]) for k in range(90, 190)]  # more equal vectors than neighbours
    odd = [(200, None), (220, [0.0] * 6), (240, [math.nan] + [1.0] * 5), (260, [1.0, None] + [1.0] * 4),
           (280, [math.inf] + [1.0] * 5), (300, []), (320, [1.0, 2.0]), (None, [1.0] * 6)]
    rows = [(i, v, 0) for i, v in [*good, *odd, good[3], good[100]]]
    table = tables.with_clashes(frame(spark, rows), "id", "vec", "leaf", "score", "rank")
    found = ann.nearest(table, F.col("id") % 20 == 0, 20)
    assert sorted(tuple(r) for r in found.collect()) == sorted(neighbours(good, 20))
    few = frame(spark, [(i, v, 0) for i, v in good[:5]])
    assert sorted(tuple(r) for r in ann.nearest(few, F.col("id") % 20 == 0).collect()) == sorted(
        neighbours(good[:5], 20)
    )
    assert ann.nearest(frame(spark, []), F.col("id") % 20 == 0).collect() == []


def test_recall_and_blocks(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(2000, 16)).astype(np.float32)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    cfg = ann.ForestConfig(leaf_rows=64, block_rows=50)
    table = frame(spark, [(i, v, 0) for i, v in rows])
    found = {tuple(r)[::2] for r in ann.nearest(table, F.col("id") % 20 == 0, 20, cfg=cfg).collect()}
    exact = {r[::2] for r in neighbours(rows, 20)}
    assert len(found & exact) / len(exact) > 0.9
