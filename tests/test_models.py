from __future__ import annotations

import random
from dataclasses import replace
from datetime import date

import numpy as np
import pytest
from micro import CFG
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from clientela.functions.storage import materialise
from clientela.operators import clusters
from clientela.operators import datasets as ds
from clientela.operators import models as mo
from clientela.operators.clusters import certificate, lloyd, random_starts
from clientela.operators.surrogate import SurrogateTree, fit_surrogate_tree
from clientela.sources import sinks

AT = "2001-01-02 00:00:00"
LONG = "customer_id string, feature_idx long, feature_value double, target int, customer_idx long"


def test_vectors_add_up_duplicates_and_fill_gaps(spark):
    rows = [
        ("a", 0, 1.0, 1, 0),
        ("a", 0, 2.0, 1, 0),
        ("a", 4, None, 1, 0),
        ("b", 3, 7.0, 0, 1),
    ]
    vectors = ds.feature_vectors(spark.createDataFrame(rows, LONG), 6, "target", "customer_idx")
    got = {r.customer_id: r for r in vectors.collect()}
    assert got["a"].features == SparseVector(6, {0: 3.0, 4: 0.0})
    assert got["b"].features == SparseVector(6, {3: 7.0})
    assert (got["a"].target, got["b"].customer_idx) == (1, 1)


def test_scoring_set_wants_a_known_value(spark):
    customers = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0)], "customer_id string, target int")
    features = spark.createDataFrame(
        [("a", "x", 1.0), ("a", "y", None), ("b", "x", None), ("c", "new", 1.0), ("a", "z", 2.0)],
        "customer_id string, feature_name string, feature_value double",
    )
    dictionary = spark.createDataFrame([("x", 0), ("y", 1), ("z", 2)], "feature_name string, feature_idx long")
    modelled = dictionary.filter("feature_name <> 'z'")
    rows = ds.scoring_set(customers, features, dictionary, modelled).collect()
    assert sorted((r.customer_id, r.feature_name, r.customer_idx) for r in rows) == [
        ("a", "x", 0),
        ("a", "y", 0),
    ]


@pytest.fixture(scope="module")
def separable(spark):
    rng = random.Random(1)
    rows = []
    for i in range(200):
        target = i % 2
        rows.append((str(i), 0, rng.random() + 2 * target, target, i))
        rows.append((str(i), 1, rng.random(), target, i))
    return materialise(
        ds.feature_vectors(spark.createDataFrame(rows, LONG), 2, "target", "customer_idx"), "vectors"
    )


@pytest.mark.parametrize("model", ["gbt", "logreg"])
def test_classifiers_separate(separable, model):
    cfg = replace(CFG, model=model, trees=5, tree_depth=3, logreg_iterations=200)
    train, test = separable.randomSplit([0.7, 0.3], 3)
    fitted = mo.train_classifier(train, cfg)
    predictions = mo.test_predictions(fitted, test, cfg, AT)
    metrics = mo.classifier_metrics(predictions).first()
    assert metrics.accuracy > 0.95 and metrics.matthews > 0.9
    dictionary = separable.sparkSession.createDataFrame(
        [("good", 0), ("noise", 1)], "feature_name string, feature_idx long"
    )
    weights = {r.feature_name: abs(r.coef) for r in mo.coefficients(fitted, dictionary, cfg, AT).collect()}
    assert weights["good"] > weights["noise"]


def test_unknown_model(separable):
    with pytest.raises(ValueError):
        mo.train_classifier(separable, replace(CFG, model="none"))


def test_metrics_by_hand(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4
    row = mo.classifier_metrics(spark.createDataFrame(pairs, "target int, prediction int")).first()
    assert (row.true_positives, row.false_negatives, row.false_positives, row.true_negatives) == (3, 1, 2, 4)
    assert row.accuracy == pytest.approx(0.7)
    assert row.matthews == pytest.approx((3 * 4 - 2 * 1) / (5 * 4 * 6 * 5) ** 0.5)


def blobs(spark):
    rng = random.Random(5)
    rows = []
    for i in range(240):
        x, y = [(0, 0), (10, 0), (0, 10), (10, 10)][i % 4]
        rows += [(str(i), 0, x + rng.random(), 0, i), (str(i), 1, y + rng.random(), 0, i)]
    return materialise(ds.feature_vectors(spark.createDataFrame(rows, LONG), 2), "blobs")


@pytest.mark.parametrize("start", ["random", "k-means++", "pca"])
def test_clusters(spark, start):
    vectors = blobs(spark)
    fitted = mo.fit_clusters(vectors, 4, replace(CFG, cluster_init=start))
    clustered = fitted.transform(vectors)
    sizes = sorted(r["count"] for r in clustered.groupBy("prediction").count().collect())
    assert sum(sizes) == 240
    if start != "pca":
        assert sizes == [60, 60, 60, 60]
    summary = mo.cluster_summary(clustered, fitted.clusterCenters(), ["x", "y"])
    assert sum(r.percentage for r in summary.collect()) == pytest.approx(100.0)


def test_surrogate_tree_and_thresholds(spark):
    vectors = blobs(spark)
    clustered = vectors.withColumn(
        "cluster", F.when(F.col("customer_id").cast("int") % 4 == 0, 0).otherwise(1)
    )
    tree = fit_surrogate_tree(materialise(clustered, "clustered"))
    splits = tree.thresholds(["x", "y"])
    assert set(splits) == {"x", "y"}
    # Cluster 0 is the low corner: its points are exactly those at or below both splits.
    values = vector_to_array("features")
    low = (values[0] <= splits["x"]) & (values[1] <= splits["y"])
    assert clustered.filter(low != (F.col("cluster") == 0)).count() == 0


def test_a_feature_used_twice_keeps_the_right_most_split():
    tree = SurrogateTree({0: (0, 5.0), 1: (0, 1.5), 2: (1, 2.0e-4)}, {3: 0, 4: 1, 5: 2, 6: 3})
    assert tree.thresholds(["a", "b"]) == {"a": 1.5, "b": 2.0e-4}


def test_exact_cuts_equal_a_plain_search(spark):
    rng = random.Random(7)
    x = [[rng.choice([0, 1, 1, 2, 5]) + (rng.random() if i % 2 else 0), rng.randrange(6)] for i in range(150)]
    clusters = [int(a > 2) + int(b > 3 and a < 1.5) + (rng.random() < 0.1) for a, b in x]
    rows = [(str(i), f, float(v), 0, i) for i, row in enumerate(x) for f, v in enumerate(row)]
    own = spark.createDataFrame([(str(i), int(c)) for i, c in enumerate(clusters)], "customer_id string, cluster int")
    vectors = ds.feature_vectors(spark.createDataFrame(rows, LONG), 2).join(own, "customer_id")
    tree = fit_surrogate_tree(materialise(vectors, "cuts"))

    def purity(members):
        counts = [members.count(c) for c in set(members)]
        return sum(n * n for n in counts) / len(members)

    def best(members):
        found = []
        for f in range(2):
            values = sorted({x[i][f] for i in members})
            for a, b in zip(values, values[1:]):
                cut = (a + b) / 2
                sides = [[clusters[i] for i in members if (x[i][f] <= cut) == s] for s in (True, False)]
                found.append((-(purity(sides[0]) + purity(sides[1])), f, a, cut))
        return min(found)[1::2]

    everyone = list(range(150))
    expected = {0: best(everyone)}
    f, cut = expected[0]
    for node, side in ((1, True), (2, False)):
        members = [i for i in everyone if (x[i][f] <= cut) == side]
        if len({clusters[i] for i in members}) > 1:
            expected[node] = best(members)
    assert tree.cuts == expected


def test_surrogate_tree_is_saved(spark, tmp_path):
    tree = SurrogateTree({0: (1, 5.0)}, {1: 0, 2: 3})
    tree.save(spark, str(tmp_path / "tree"))
    assert SurrogateTree.load(spark, str(tmp_path / "tree")) == tree


def test_one_cluster_is_one_leaf(spark):
    clustered = materialise(blobs(spark).withColumn("cluster", F.lit(2)), "one")
    tree = fit_surrogate_tree(clustered)
    assert (tree.cuts, tree.classes) == ({}, {0: 2})
    assert tree.transform(clustered).filter("prediction = 2").count() == 240


def test_all_starts_in_one_pass_equal_single_fits(spark):
    vectors = blobs(spark)
    x = np.array([r.features.toArray() for r in vectors.collect()])
    starts = random_starts(vectors, 4, 6, 3)
    assert starts.shape == (6, 4, 2)
    centres, cost = lloyd(vectors, starts, 1000)
    for start, own, total in zip(starts, centres, cost, strict=True):
        plain = start.copy()
        while True:
            near = ((x[:, None] - plain[None]) ** 2).sum(axis=2).argmin(axis=1)
            moved = np.array([x[near == c].mean(axis=0) if (near == c).any() else plain[c] for c in range(4)])
            if np.abs(moved - plain).max() < 1e-12:
                break
            plain = moved
        np.testing.assert_allclose(own, plain, atol=1e-9)
        assert total == pytest.approx(((x - plain[near]) ** 2).sum())
    fitted = mo.fit_clusters(vectors, 4, replace(CFG, seed=3, cluster_restarts=6))
    told = certificate(vectors, fitted.clusterCenters()).first()
    assert (told.customers, told.nearest, told.centred) == (240, 240, True)
    moved = certificate(vectors, [[c[0] + 0.3, c[1]] for c in fitted.clusterCenters()]).first()
    assert not moved.centred


@pytest.mark.parametrize("layout", ["one task", "four tasks", "jobs"])
def test_rows_are_read_once_for_all_steps(spark, monkeypatch, layout):
    """Sums of a step are a job only where the rows can't be held; all layouts settle alike."""
    rng = random.Random(5)
    rows = [
        (str(i), Vectors.sparse(40, {f: rng.gauss(i % 3, 1.0) for f in sorted(rng.sample(range(40), 9))}))
        for i in range(900)
    ]
    rows += [(str(900 + i), Vectors.sparse(40, {})) for i in range(5)]
    vectors = materialise(spark.createDataFrame(rows, ["customer_id", "features"]), "held")
    x = np.array([r.features.toArray() for r in vectors.collect()])
    starts = random_starts(vectors, 3, 4, 1)

    def no_job(*_):
        raise AssertionError("a job and a shuffle for each step")

    if layout == "jobs":
        monkeypatch.setattr(clusters, "message_folder", lambda spark: None)
        monkeypatch.setattr(clusters, "TASK_VALUES", 1000)
    else:
        monkeypatch.setattr(clusters, "_sums", no_job)
        monkeypatch.setattr(clusters, "TASK_VALUES", 1 << 20 if layout == "one task" else 2000)
    centres, cost = lloyd(vectors, starts, 1000)
    for start, own, total in zip(starts, centres, cost, strict=True):
        plain = start.copy()
        while True:
            near = ((x[:, None] - plain[None]) ** 2).sum(axis=2).argmin(axis=1)
            moved = np.array([x[near == c].mean(axis=0) if (near == c).any() else plain[c] for c in range(3)])
            if np.abs(moved - plain).max() < 1e-12:
                break
            plain = moved
        np.testing.assert_allclose(own, plain, atol=1e-9)
        assert total == pytest.approx(((x - plain[near]) ** 2).sum())
    # Stopped early, each layout stands where the same number of steps leads.
    near = ((x[:, None] - starts[0][None]) ** 2).sum(axis=2).argmin(axis=1)
    first = np.array([x[near == c].mean(axis=0) for c in range(3)])
    near = ((x[:, None] - first[None]) ** 2).sum(axis=2).argmin(axis=1)
    second = np.array([x[near == c].mean(axis=0) for c in range(3)])
    early, total = lloyd(vectors, starts, 2)
    np.testing.assert_allclose(early[0], second, atol=1e-9)
    assert total[0] == pytest.approx(((x - first[near]) ** 2).sum())


def test_the_optimum_has_a_certificate(separable):
    cfg = replace(CFG, model="logreg")
    fitted = mo.train_classifier(separable, cfg)
    assert tuple(mo.logistic_certificate(fitted, separable, cfg).first()) == (200, True)
    early = mo.train_classifier(separable, replace(cfg, logreg_iterations=1))
    assert not mo.logistic_certificate(early, separable, cfg).first().optimal


def test_level_1(spark):
    vectors = blobs(spark).withColumn("customer_idx", F.col("customer_id").cast("long"))
    fitted = mo.fit_clusters(vectors, 2, CFG)
    scored = mo.score_level_1(fitted, vectors, CFG, AT)
    everyone = spark.range(250).select(F.col("id").cast("string").alias("customer_id"))
    filled = mo.fill_level_1(scored, everyone, CFG, AT)
    assert filled.count() == 250
    added = filled.filter("customer_idx = -1").collect()
    assert len(added) == 10 and {(r.cluster_id, r.necessity_lvl_1) for r in added} == {(0, "typeB_A")}


def test_models_are_saved_by_version(spark, tmp_path):
    fitted = mo.fit_clusters(blobs(spark), 2, CFG)
    base = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        sinks.latest_version(spark, base)
    sinks.save_model(fitted, base, date(2001, 1, 1))
    sinks.save_model(fitted, base, date(2001, 2, 1))
    assert sinks.latest_version(spark, base).endswith("version=20010201")
    loaded = sinks.load_model(spark, KMeansModel.read(), base)
    assert len(loaded.clusterCenters()) == 2


def test_csv_and_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), (None, 0.1)], "k string, v double")
    path = str(tmp_path / "csv")
    sinks.export_csv(df, path)
    back = sinks.read_csv_folder(spark, path, "k string, v double", ".gz")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    sinks.publish_table(df, "published")
    sinks.append_table(df, "published")
    assert spark.table("published").count() == 4
    spark.sql("DROP TABLE published")


def test_given_centres_assign_wide_sparse_vectors(spark):
    """5,000 features: the centres are a model, not literals in a plan."""
    width = 5000
    rows = [(str(k), (k * 37) % width, 1.0 + k % 2, 0, k) for k in range(200)]
    vectors = ds.feature_vectors(spark.createDataFrame(rows, LONG), width)
    model = mo.clusters_of(spark, [[0.0] * width, [0.0002] * width])
    found = {r.customer_id: r.prediction for r in model.transform(vectors).collect()}
    for name, idx, value, *_ in rows:
        zero = value**2
        other = (value - 0.0002) ** 2 + (width - 1) * 0.0002**2
        assert found[name] == int(other < zero)


def test_given_coefficients_score(spark):
    rows = [("a", 0, 2.0, 1, 0), ("b", 1, 1.0, 0, 1)]
    vectors = ds.feature_vectors(spark.createDataFrame(rows, LONG), 2, "target")
    told = mo.score(mo.logistic_of(spark, [1.0, -1.0], 0.5), vectors, CFG).collect()
    got = {r.customer_id: (round(r.prob_typeB, 6), r.prediction) for r in told}
    assert got == {"a": (0.924142, 1), "b": (0.377541, 0)}


def test_a_missing_class_is_named(spark):
    rows = [(str(k), 0, 1.0, 1, k) for k in range(5)]
    vectors = ds.feature_vectors(spark.createDataFrame(rows, LONG), 1, "target")
    with pytest.raises(ValueError, match="class 0"):
        mo.train_classifier(vectors, CFG)
