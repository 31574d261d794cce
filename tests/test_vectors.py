"""Vectors as wide as a large dictionary: work goes by what the rows hold, not by their width."""

from __future__ import annotations

import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clientela.functions.storage import materialise
from clientela.functions.vectors import stored, width_of
from clientela.operators.clusters import certificate, lloyd, random_starts

WIDE = 1_000_000


def written(spark, rows):
    return materialise(spark.createDataFrame([(v,) for v in rows], ["features"]), "vectors")


def test_stored_values(spark):
    rows = [Vectors.dense([0.0, 2.0, -1.0]), Vectors.sparse(3, [0, 2], [0.0, 4.0]), Vectors.sparse(3, [], [])]
    told = written(spark, rows).select(width_of("features").alias("w"), stored("features").alias("e"))
    found = sorted((r.w, [tuple(e) for e in r.e]) for r in told.collect())
    assert found == [(3, []), (3, [(1, 2.0), (2, -1.0)]), (3, [(2, 4.0)])]
    wide = written(spark, [Vectors.sparse(WIDE, [i, WIDE - 1], [1.0, 2.0]) for i in range(200)])
    told = wide.select(F.size(stored("features")).alias("n")).agg(F.sum("n")).first()
    assert told[0] == 400


def test_clusters_of_wide_rows(spark):
    """Starts that are drawn, steps and the certificate on rows that would fill 1.6 GB written out."""
    rng = np.random.default_rng(5)
    at = rng.choice(WIDE, 200, replace=False).tolist()
    rows = [
        Vectors.sparse(WIDE, sorted([(a, 1.0), (WIDE // 2 if i % 2 else WIDE // 3, 9.0)])) if a not in (WIDE // 2, WIDE // 3)
        else Vectors.sparse(WIDE, [a], [9.0])
        for i, a in enumerate(at)
    ]
    vectors = written(spark, rows)
    starts = random_starts(vectors, 2, 4, 3)
    assert starts.shape == (4, 2, WIDE) and (starts[:, 0] != starts[:, 1]).any(axis=1).all()
    centres, cost = lloyd(vectors, starts, 100)
    best = centres[int(np.argmin(cost))]
    told = certificate(vectors, best).first()
    assert (told.customers, told.nearest, told.centred) == (200, 200, True)
    dense = {0: [], 1: []}
    for i, v in enumerate(rows):
        dense[i % 2].append(v)
    for own in dense.values():
        mean = np.zeros(WIDE)
        for v in own:
            mean[v.indices] += v.values / len(own)
        assert min(np.abs(best - mean).max(axis=1)) < 1e-9


def test_steps_like_dense_ones(spark):
    """One step from given centres, against plain sums over dense rows with zeros and empty rows."""
    rng = np.random.default_rng(7)
    x = np.where(rng.random((300, 40)) < 0.2, rng.normal(size=(300, 40)), 0.0)
    x[:5] = 0.0
    rows = [Vectors.dense(r) if i % 3 else Vectors.sparse(40, np.flatnonzero(r), r[r != 0]) for i, r in enumerate(x)]
    starts = x[rng.choice(300, 6, replace=False)].reshape(2, 3, 40)
    centres, cost = lloyd(written(spark, rows), starts, 1)
    for s in range(2):
        squares = ((x[:, None] - starts[s]) ** 2).sum(axis=2)
        near = squares.argmin(axis=1)
        plain = np.array([x[near == c].mean(axis=0) if (near == c).any() else starts[s, c] for c in range(3)])
        np.testing.assert_allclose(centres[s], plain, atol=1e-12)
        np.testing.assert_allclose(cost[s], squares.min(axis=1).sum())
