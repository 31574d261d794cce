"""Boosted trees against a plain booster that looks at all rows of a node, one node at a time."""

from __future__ import annotations

import random
from dataclasses import replace

import numpy as np
import pytest
from micro import CFG
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clientela.config import RunConfig
from clientela.functions.storage import materialise
from clientela.operators import boosting as bo
from clientela.operators import models as mo

WIDTH = 7


def rows(n, seed=2):
    rng = random.Random(seed)
    for i in range(n):
        x = [rng.random() if rng.random() < 0.5 else 0.0 for _ in range(WIDTH)]
        x[3] = -x[3]
        x[4] = float(rng.randrange(4))
        x[6] = 0.0
        score = 2 * x[0] - x[1] + x[3] + (x[4] == 2) * x[2] + rng.gauss(0, 0.3)
        yield str(i), int(score > 0.3), Vectors.sparse(WIDTH, {k: v for k, v in enumerate(x) if v})


@pytest.fixture(scope="module")
def vectors(spark):
    df = spark.createDataFrame(list(rows(700)), ["customer_id", "target", "features"])
    return materialise(df, "boost-rows")


def plain(x, y, cuts, cfg):
    """Probability of each row by trees grown node by node."""
    margin = np.zeros(len(y))

    def grow(at, g, h, depth):
        total_g, total_h = g[at].sum(), h[at].sum()
        best = (bo.LEAST_GAIN, None, None)
        for f, own in enumerate(cuts):
            for cut in own if depth < cfg.depth else []:
                left = x[at, f] <= cut
                a, b = g[at][left].sum(), h[at][left].sum()
                if b < cfg.least_hessian or total_h - b < cfg.least_hessian:
                    continue
                gain = (
                    a**2 / (b + cfg.ridge)
                    + (total_g - a) ** 2 / (total_h - b + cfg.ridge)
                    - total_g**2 / (total_h + cfg.ridge)
                )
                if gain > best[0]:
                    best = (gain, f, cut)
        if best[1] is None:
            margin[at] += -total_g / (total_h + cfg.ridge) * cfg.rate
            return
        left = x[at, best[1]] <= best[2]
        grow(at[left], g, h, depth + 1)
        grow(at[~left], g, h, depth + 1)

    for _ in range(cfg.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * bo.UNIT) / bo.UNIT, np.rint(p * (1 - p) * bo.UNIT) / bo.UNIT
        grow(np.arange(len(y)), g, h, 0)
    return 1 / (1 + np.exp(-margin))


def told(model, vectors):
    found = model.with_probability(vectors, "p").select("customer_id", "p").collect()
    return np.array([r.p for r in sorted(found, key=lambda r: int(r.customer_id))])


def test_same_as_a_plain_booster(vectors):
    cfg = bo.BoostConfig(trees=6, depth=5, rate=0.3, bins=16)
    model = bo.fit(vectors, 700, cfg)
    table = vectors.orderBy(F.col("customer_id").cast("int")).collect()
    x = np.array([r.features.toArray() for r in table])
    y = np.array([r.target for r in table], float)
    cuts = bo.feature_cuts(vectors, WIDTH, cfg.bins)
    assert len(cuts[6]) == 0 and list(cuts[4]) == [0.0, 1.0, 2.0]
    np.testing.assert_allclose(told(model, vectors), plain(x, y, cuts, cfg), atol=1e-9)


def test_tasks_agree_exactly(vectors):
    cfg = bo.BoostConfig(trees=3, depth=4, rate=0.3, bins=16)
    one = bo.fit(vectors, 700, cfg)
    # A barrier stage of three tasks.
    many = bo.fit(vectors, 700, replace(cfg, rows_per_task=250))
    assert (one.nodes.to_numpy() == many.nodes.to_numpy()).all()
    assert len(one.nodes) > 15


def test_tasks_tell_each_other_by_files(vectors, monkeypatch):
    """Spark's own exchange, a second for each level of a tree, is not asked."""

    def slow(context):
        raise AssertionError("a second for each level")

    cfg = bo.BoostConfig(trees=3, depth=4, rate=0.3, bins=16)
    one = bo.fit(vectors, 700, cfg)
    monkeypatch.setattr(bo, "_among", slow)
    many = bo.fit(vectors, 700, replace(cfg, rows_per_task=250))
    assert (one.nodes.to_numpy() == many.nodes.to_numpy()).all()
    # Where the folder is no path of the machines it is, and only by tables beyond its own bound.
    monkeypatch.undo()
    monkeypatch.setattr(bo, "message_folder", lambda spark: None)
    again = bo.fit(vectors, 700, replace(cfg, trees=1, depth=2, rows_per_slow_task=250))
    few = bo.fit(vectors, 700, replace(cfg, trees=1, depth=2))
    assert (again.nodes.to_numpy() == few.nodes.to_numpy()).all()


def test_scores_are_those_of_whole_rows(vectors):
    """Rows are written out by the features that the trees ask for."""
    model = bo.fit(vectors, 700, bo.BoostConfig(trees=4, depth=3, rate=0.3, bins=16))
    table = vectors.orderBy(F.col("customer_id").cast("int")).collect()
    x = np.array([r.features.toArray() for r in table])
    np.testing.assert_allclose(told(model, vectors), 1 / (1 + np.exp(-model.margin(x))), atol=1e-12)
    assert 6 not in model.feature


def test_reads_what_may_be_cut(monkeypatch):
    """Rare features have no bin, of two children the smaller is read, and the trees are the plain ones."""
    rng = np.random.default_rng(4)
    x = np.round(rng.random((6000, 12)), 1) * (rng.random((6000, 12)) < 0.7)
    x[:, 5:] *= rng.random((6000, 7)) < 0.0005
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.2, 6000) > 0.6).astype(float)
    cuts = [np.unique(own[own > 0])[:-1] for own in np.where(x > 0, x, 1.0).T]
    cuts = [np.append(0.0, own) for own in cuts]
    bins, (row, feature) = bo._Bins.of(cuts), np.nonzero(x)
    code = bins.coded(feature.astype(np.int32), x[row, feature])
    order = np.argsort(code, kind="stable")
    table = bo._Rows(y, row[order].astype(np.int32), feature[order].astype(np.int32), code[order])
    cfg = bo.BoostConfig(trees=3, depth=6, rate=0.3)
    grower = bo._Grower(table, bins, cfg, bo._alone)
    read, own = [], grower._values_of
    monkeypatch.setattr(grower, "_values_of", lambda row: read.append(len(row)) or own(row))
    trees = [grower.tree() for _ in range(cfg.trees)]
    assert grower.t_total < grower.total and len(grower.t_start) == 5
    assert 0 < sum(read) < 0.6 * cfg.trees * (cfg.depth - 1) * len(y)
    assert all(len(nodes) > 30 for nodes in trees)
    expected = plain(x, y, cuts, cfg)
    np.testing.assert_allclose(1 / (1 + np.exp(-grower.margin)), expected, atol=1e-9)


def test_production_defaults(vectors, tmp_path):
    cfg = replace(CFG, model="gbt")
    defaults = RunConfig()
    assert (cfg.trees, cfg.tree_depth, cfg.training_rows) == (400, 20, None)
    assert (defaults.trees, defaults.tree_depth) == (400, 20)
    model = mo.train_classifier(vectors, cfg)
    assert len(model.roots) == 400
    model.save(str(tmp_path / "model"))
    again = bo.BoostedTrees.load(vectors.sparkSession, str(tmp_path / "model"))
    assert (told(model, vectors) == told(again, vectors)).all()
    right = [r.target == (p > 0.5) for r, p in zip(
        vectors.orderBy(F.col("customer_id").cast("int")).collect(), told(model, vectors), strict=True
    )]
    assert np.mean(right) > 0.98
    fresh = vectors.sparkSession.createDataFrame(
        list(rows(300, seed=9)), ["customer_id", "target", "features"]
    )
    scored = mo.score(model, fresh, cfg)
    assert scored.filter("prediction = target").count() > 240


def test_dense_vectors_and_odd_tables(spark, vectors):
    cfg = bo.BoostConfig(trees=3, depth=3, rate=0.3, bins=16)
    dense = vectors.withColumn("features", array_to_vector(vector_to_array("features")))
    a, b = bo.fit(vectors, 700, cfg), bo.fit(materialise(dense, "dense"), 700, cfg)
    assert (a.nodes.to_numpy() == b.nodes.to_numpy()).all()
    assert (told(a, vectors) == told(a, dense)).all()
    # Rows that no split tells apart: single leaves.
    flat = spark.createDataFrame(
        [(str(i), i % 2, Vectors.sparse(2, {})) for i in range(8)], ["customer_id", "target", "features"]
    )
    model = bo.fit(flat, 8, cfg)
    assert model.with_probability(flat, "p").filter("abs(p - 0.5) < 1e-9").count() == 8
    assert model.importances.sum() == 0
