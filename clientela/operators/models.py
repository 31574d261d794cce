"""Classifier and clusters."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clientela.config import RunConfig
from clientela.functions.columns import hash_below
from clientela.functions.vectors import entries, width_of
from clientela.operators import boosting
from clientela.operators.boosting import BoostConfig, BoostedTrees
from clientela.operators.clusters import lloyd, random_starts

BOOSTED = ("gbt", "xgboost")
LOGISTIC = "logreg"
CLUSTER_MODEL = "K-means"
FALLBACK_SEGMENT = "typeB_A"
# Names of the two level 1 clusters.
LEVEL_1_SEGMENTS = {0: "typeB_A", 1: "typeB_B"}


def train_classifier(vectors: DataFrame, cfg: RunConfig):
    """Fit on ``features`` and ``target``; the caller keeps the vectors in a written table.

    Of more than ``cfg.training_rows`` labelled rows about that many are taken, by a
    hash of the customer.
    """
    counts = {row["target"]: row["count"] for row in vectors.groupBy("target").count().collect()}
    for target in (0, 1):
        if not counts.get(target):
            raise ValueError(f"no training customer of class {target}: nothing to tell apart")
    rows = sum(counts.values())
    if cfg.training_rows is not None and rows > cfg.training_rows:
        share = cfg.training_rows / rows
        vectors = vectors.filter(hash_below(F.col("customer_id"), cfg.seed, "fit", share))
        rows = cfg.training_rows
    if cfg.model in BOOSTED:
        boost = BoostConfig(trees=cfg.trees, depth=cfg.tree_depth, rate=cfg.learning_rate)
        return boosting.fit(vectors, rows, boost)
    if cfg.model == LOGISTIC:
        labelled = vectors.withColumn("label", F.col("target").cast("double"))
        # An L2 penalty of 1 on the summed loss is 1/n on the mean loss.
        return LogisticRegression(
            maxIter=cfg.logreg_iterations,
            regParam=1.0 / max(rows, 1),
            elasticNetParam=0.0,
            standardization=False,
        ).fit(labelled)
    raise ValueError(f"unknown model {cfg.model!r}")


def score(model, vectors: DataFrame, cfg: RunConfig) -> DataFrame:
    """Probability of typeB and the class above the threshold."""
    if isinstance(model, BoostedTrees):
        return with_prediction(model.with_probability(vectors, "prob_typeB"), cfg)
    probability = vector_to_array("probability")[1]
    kept = [c for c in vectors.columns if c != "features"]
    scored = model.transform(vectors).select(*kept, probability.alias("prob_typeB"))
    return with_prediction(scored, cfg)


def with_prediction(scored: DataFrame, cfg: RunConfig) -> DataFrame:
    """The class of each score: 1 above the threshold."""
    above = F.col("prob_typeB") > cfg.threshold
    return scored.withColumn("prediction", F.when(above, 1).otherwise(0))


def with_run(df: DataFrame, cfg: RunConfig, classified_at: str, model: str) -> DataFrame:
    return df.withColumns(
        {
            "country_id": F.lit(cfg.country),
            "model": F.lit(model),
            "classification_dttm": F.lit(classified_at).cast("timestamp_ntz"),
            "period": F.lit(cfg.period).cast("long"),
        }
    )


def test_predictions(model, vectors: DataFrame, cfg: RunConfig, classified_at: str) -> DataFrame:
    """The table of predictions on the held-out customers."""
    scored = with_run(score(model, vectors, cfg), cfg, classified_at, cfg.model)
    return scored.select(
        "customer_idx",
        F.col("target").cast("long").alias("target"),
        "prob_typeB",
        F.col("prediction").cast("long").alias("prediction"),
        "country_id",
        "model",
        "classification_dttm",
        "period",
    )


def classifier_metrics(predictions: DataFrame) -> DataFrame:
    """Confusion counts and shares, accuracy and Matthews correlation, in one row."""
    target, predicted = F.col("target"), F.col("prediction")
    counts = predictions.agg(
        F.count_if((target == 0) & (predicted == 0)).alias("true_negatives"),
        F.count_if((target == 0) & (predicted == 1)).alias("false_positives"),
        F.count_if((target == 1) & (predicted == 0)).alias("false_negatives"),
        F.count_if((target == 1) & (predicted == 1)).alias("true_positives"),
    )
    names = ("true_negatives", "false_positives", "false_negatives", "true_positives")
    tn, fp, fn, tp = (F.col(n).cast("double") for n in names)
    rows = tn + fp + fn + tp
    spread = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    matthews = F.when(spread > 0, (tp * tn - fp * fn) / spread).otherwise(0.0)
    some = rows > 0
    return counts.select(
        *names,
        *[F.when(some, F.col(n) * 100 / rows).alias(f"{n}_pct") for n in names],
        F.when(some, (tp + tn) / rows).alias("accuracy"),
        matthews.alias("matthews"),
    )


def coefficients(model, dictionary: DataFrame, cfg: RunConfig, created_at: str) -> DataFrame:
    """Coefficient (or importance) of each feature. One number per dictionary entry."""
    trees = isinstance(model, BoostedTrees)
    weights = model.importances if trees else model.coefficients.toArray()
    values = dictionary.sparkSession.createDataFrame(
        [(i, float(w)) for i, w in enumerate(weights)], "feature_idx long, coef double"
    )
    return values.join(dictionary, "feature_idx").select(
        F.lit(cfg.country).alias("country_id"),
        F.lit(cfg.model).alias("model"),
        F.lit(created_at).cast("timestamp_ntz").alias("creation_dttm"),
        "feature_idx",
        "coef",
        "feature_name",
    )


def fit_clusters(vectors: DataFrame, k: int, cfg: RunConfig) -> KMeansModel:
    """k-means; of several seeded starts, all in one pass a step, the one with the lowest cost.

    ``vectors`` are a written table.
    """
    held = vectors.select("features")
    if cfg.cluster_init == "pca":
        starts = np.array([_components(held, k)])
    elif cfg.cluster_init == "random":
        starts = random_starts(held, k, cfg.cluster_restarts, cfg.seed)
    else:
        starts = np.array([_scattered(held, k, cfg, r) for r in range(cfg.cluster_restarts)])
    centres, cost = lloyd(held, starts, cfg.cluster_iterations)
    return clusters_of(vectors.sparkSession, centres[int(np.argmin(cost))].tolist())


def _scattered(vectors: DataFrame, k: int, cfg: RunConfig, restart: int) -> np.ndarray:
    """Centres that lie far apart, as k-means|| draws them."""
    mode = {"k-means++": "k-means||"}.get(cfg.cluster_init, cfg.cluster_init)
    drawn = KMeans(k=k, initMode=mode, maxIter=1, seed=cfg.seed + restart).fit(vectors)
    centres = [list(c) for c in drawn.clusterCenters()]
    return np.array([centres[i % len(centres)] for i in range(k)])


def _components(vectors: DataFrame, k: int) -> np.ndarray:
    """The first ``k`` principal components.

    With fewer features than clusters the components are fewer; they are then filled up
    with their negatives.
    """
    width = vectors.select(width_of("features")).first()[0]
    components = PCA(k=min(k, width), inputCol="features", outputCol="c").fit(vectors).pc
    columns = [list(column) for column in components.toArray().T]
    return np.array((columns + [[-x for x in c] for c in columns])[:k])


def clusters_of(spark: SparkSession, centres: Sequence[Sequence[float]]) -> KMeansModel:
    """A k-means model with given centres: it assigns, is saved and is loaded as any other."""
    jvm = spark.sparkContext._jvm
    points = spark.sparkContext._gateway.new_array(
        jvm.org.apache.spark.mllib.linalg.Vector, len(centres)
    )
    for k, centre in enumerate(centres):
        points[k] = _jvm_vector(spark, centre)
    parent = jvm.org.apache.spark.mllib.clustering.KMeansModel(points)
    uid = f"kmeans_{uuid.uuid4().hex[:12]}"
    return KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(uid, parent))


def _jvm_vector(spark: SparkSession, values: Sequence[float]):
    """A dense vector of Spark, sent in one call however wide it is."""
    text = json.dumps({"type": 1, "values": [float(x) for x in values]})
    return spark.sparkContext._jvm.org.apache.spark.mllib.linalg.Vectors.fromJson(text)


def logistic_of(
    spark: SparkSession, coefficients: Sequence[float], intercept: float
) -> LogisticRegressionModel:
    """A logistic model with given coefficients."""
    jvm = spark.sparkContext._jvm
    weights = _jvm_vector(spark, coefficients).asML()
    uid = f"logreg_{uuid.uuid4().hex[:12]}"
    made = jvm.org.apache.spark.ml.classification.LogisticRegressionModel
    return LogisticRegressionModel(made(uid, weights, float(intercept)))


def nearest_centre(centres: Sequence[Sequence[float]]) -> Column:
    """(distance, cluster) of the nearest centre, as an expression over ``features``.

    For the few features of a summary: every coordinate stands in the plan. Models
    assign clusters themselves.
    """
    values = vector_to_array("features")

    def squared(centre: Sequence[float]) -> Column:
        point = F.array(*[F.lit(float(x)) for x in centre])
        differences = F.zip_with(values, point, lambda a, b: (a - b) * (a - b))
        return F.aggregate(differences, F.lit(0.0), lambda total, x: total + x)

    distances = [
        F.struct(F.sqrt(squared(c)).alias("distance"), F.lit(i).alias("cluster"))
        for i, c in enumerate(centres)
    ]
    return F.array_min(F.array(*distances))


def cluster_summary(clustered: DataFrame, centres, names: Sequence[str]) -> DataFrame:
    """Size, share, and mean and deviation of each feature and of the distance per cluster."""
    values = vector_to_array("features")
    wide = clustered.select(
        F.col("prediction").alias("cluster"),
        nearest_centre([list(c) for c in centres])["distance"].alias("distance"),
        *[values[i].alias(name) for i, name in enumerate(names)],
    )
    measured = ["distance", *names]
    per_cluster = wide.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("customers"),
        *[F.avg(c).alias(f"{c}_mean") for c in measured],
        *[F.stddev_samp(c).alias(f"{c}_std") for c in measured],
    )
    rows = wide.agg(F.count(F.lit(1)).alias("n")).scalar()
    return per_cluster.withColumn("percentage", F.col("customers") * 100.0 / rows)


def score_level_1(
    model,
    vectors: DataFrame,
    cfg: RunConfig,
    classified_at: str,
    segments: Mapping[int, str] = LEVEL_1_SEGMENTS,
) -> DataFrame:
    """Cluster and segment name; a cluster without a name is left out."""
    names = F.create_map(*[F.lit(x) for pair in segments.items() for x in pair])
    clustered = model.transform(vectors).withColumn("necessity_lvl_1", names[F.col("prediction")])
    named = with_run(clustered, cfg, classified_at, CLUSTER_MODEL)
    return named.filter(F.col("necessity_lvl_1").isNotNull()).select(
        "country_id",
        "model",
        "classification_dttm",
        "period",
        "customer_idx",
        "customer_id",
        F.col("prediction").cast("long").alias("cluster_id"),
        "necessity_lvl_1",
    )


def fill_level_1(
    scored: DataFrame,
    customers: DataFrame,
    cfg: RunConfig,
    classified_at: str,
    segments: Mapping[int, str] = LEVEL_1_SEGMENTS,
) -> DataFrame:
    """Add the customers without features, in the fallback segment."""
    cluster = next((k for k, name in segments.items() if name == FALLBACK_SEGMENT), 0)
    missing = customers.select("customer_id").join(
        scored.select("customer_id"), "customer_id", "left_anti"
    )
    filled = with_run(missing, cfg, classified_at, CLUSTER_MODEL).withColumns(
        {
            "customer_idx": F.lit(-1).cast("long"),
            "cluster_id": F.lit(cluster).cast("long"),
            "necessity_lvl_1": F.lit(FALLBACK_SEGMENT),
        }
    )
    return scored.unionByName(filled)


def logistic_certificate(model: LogisticRegressionModel, vectors: DataFrame, cfg: RunConfig) -> DataFrame:
    """What shows that the fitted coefficients are the optimum, in one pass over the rows.

    The gradient of the mean loss with its penalty at these coefficients: ``customers`` and
    whether its largest entry is below 1e-3 (``optimal``); at any other point it would not vanish.
    """
    weights, intercept = model.coefficients.toArray(), float(model.intercept)
    width = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(width + 1), 0
        for batch in batches:
            row, feature, value = entries(batch["features"])
            margin = np.bincount(row, value * weights[feature], batch.num_rows) + intercept
            error = 1 / (1 + np.exp(-margin)) - batch["target"].to_numpy()
            total += np.append(np.bincount(feature, value * error[row], width), error.sum())
            rows += batch.num_rows
        at = np.arange(width + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(total), pa.array(np.where(at == width, rows, 0))],
            ["feature", "slope", "customers"],
        )

    sums = vectors.select("features", "target").mapInArrow(run, "feature long, slope double, customers long")
    sums = sums.groupBy("feature").agg(F.sum("slope").alias("slope"), F.sum("customers").alias("n"))
    spark = vectors.sparkSession
    known = spark.createDataFrame(
        [(i, float(w)) for i, w in enumerate(np.append(weights, 0.0))], "feature long, weight double"
    )
    # The penalty is 1 on the summed loss; the constant has none.
    gap = F.max(F.abs(F.col("slope") + F.col("weight")))
    return sums.join(known, "feature").agg(
        F.sum("n").alias("customers"), (gap / F.sum("n") < 1e-3).alias("optimal")
    )
