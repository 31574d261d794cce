"""The monthly run: profile training and scoring, necessity segments, final table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from clientela.config import TYPE_B, RunConfig
from clientela.functions.storage import materialise
from clientela.operators import cohorts as co
from clientela.operators import datasets as ds
from clientela.operators import features as fe
from clientela.operators import featureset as fs
from clientela.operators import models as mo
from clientela.operators import rules as ru
from clientela.operators.boosting import BoostedTrees
from clientela.operators.surrogate import SurrogateTree, fit_surrogate_tree
from clientela.sources.sinks import (
    COMPLETE,
    latest_version,
    mark_complete,
    publish_parquet,
    read_published,
    version_path,
)
from clientela.sources.tables import Sources

# Folders of the versions of each kind of model.
PROFILE_MODEL, NEED_MODEL, LEVEL_1_MODEL = "profile_model", "need_model", "level_1_model"


@dataclass(frozen=True)
class Base:
    """Cohorts and raw features of a run, written once and read by all later steps."""

    cohorts: co.Cohorts
    customers: DataFrame
    features: DataFrame


def build_base(src: Sources, cfg: RunConfig) -> Base:
    flags = materialise(co.customer_flags(src, cfg), "flags")
    cohorts = co.build_cohorts(src, cfg, flags)
    universe = (
        co.feature_customers_of_flags(flags, src, cfg)
        if src.companies is None
        else co.feature_customers(cohorts)
    )
    features = materialise(fe.features(src, cfg, universe), "features")
    customers = materialise(co.all_customers(cohorts), "customers")
    return Base(cohorts, customers, features)


@dataclass(frozen=True)
class ProfileModel:
    """A trained classifier with what scoring needs, and its evaluation tables."""

    classifier: object
    dictionary: DataFrame
    width: int
    standardizer: DataFrame | None
    coefficients: DataFrame
    test_predictions: DataFrame
    metrics: DataFrame


@dataclass(frozen=True)
class TrainingData:
    standardizer: DataFrame | None
    feature_set: DataFrame
    customers: DataFrame
    long: DataFrame
    dictionary: DataFrame
    customer_index: DataFrame


def training_data(base: Base, src: Sources, cfg: RunConfig) -> TrainingData:
    chosen, standardizer = fs.feature_set(
        base.features, base.customers, cfg.profile_set, cfg.period
    )
    chosen = materialise(chosen, "profile_set")
    totals = materialise(co.invoice_totals(base.cohorts, src, cfg), "invoice_totals")
    pro = materialise(co.pro_customers(totals, cfg), "pro")
    home = co.home_sample(base.cohorts.receipt, pro, cfg)
    customers = materialise(co.training_customers(pro, home, cfg), "training_customers")
    long = materialise(ds.training_long(customers, chosen), "training_long")
    return TrainingData(
        standardizer=standardizer,
        feature_set=chosen,
        customers=customers,
        long=long,
        dictionary=materialise(ds.feature_dictionary(long), "dictionary"),
        customer_index=materialise(ds.customer_dictionary(long), "customer_dictionary"),
    )


def split_vectors(data: TrainingData, cfg: RunConfig) -> tuple[DataFrame, DataFrame, int]:
    """Train and test vectors, and their width."""
    width = data.dictionary.count()
    indexed = ds.training_set(data.long, data.dictionary, data.customer_index)
    vectors = ds.feature_vectors(indexed, width, "target", "customer_idx")
    vectors = materialise(ds.train_test_split(vectors, cfg), "training_vectors")
    return vectors.filter("is_train"), vectors.filter("NOT is_train"), width


def train_profile(base: Base, src: Sources, cfg: RunConfig, at: str) -> ProfileModel:
    data = training_data(base, src, cfg)
    train, test, width = split_vectors(data, cfg)
    classifier = mo.train_classifier(train, cfg)
    predictions = mo.test_predictions(classifier, test, cfg, at)
    return ProfileModel(
        classifier=classifier,
        dictionary=data.dictionary,
        width=width,
        standardizer=data.standardizer,
        coefficients=mo.coefficients(classifier, data.dictionary, cfg, at),
        test_predictions=predictions,
        metrics=mo.classifier_metrics(predictions),
    )


def score_customers(base: Base, model: ProfileModel, cfg: RunConfig) -> DataFrame:
    """Probability and class of all customers with a known feature."""
    chosen, _ = fs.feature_set(
        base.features,
        base.customers,
        cfg.profile_set,
        cfg.period,
        parameters=model.standardizer,
    )
    # Read twice: for the index and for the values.
    chosen = materialise(chosen, "scoring_features")
    long = ds.scoring_set(base.customers, chosen, model.dictionary, model.coefficients)
    vectors = ds.feature_vectors(long, model.width, "target", "customer_idx")
    return mo.score(model.classifier, vectors, cfg)


def profile_results(base: Base, scored: DataFrame, src: Sources, cfg: RunConfig, at: str) -> DataFrame:
    return ru.apply_profile_rules(scored, base.cohorts, src, cfg, at)


@dataclass(frozen=True)
class NeedModel:
    """Clusters of the typeB customers and the tree that explains them."""

    clusters: object
    tree: SurrogateTree
    clustered: DataFrame
    summary: DataFrame
    splits: dict[str, float]


def need_training_customers(base: Base, customers: DataFrame, cfg: RunConfig) -> DataFrame:
    if cfg.outliers is None:
        return customers
    return materialise(fs.drop_outliers(base.features, customers, cfg.outliers), "no_outliers")


@dataclass(frozen=True)
class NeedData:
    """Scaled vectors for the clusters and original ones for the tree, side by side."""

    vectors: DataFrame
    names: list[str]


def need_vectors(base: Base, customers: DataFrame, cfg: RunConfig) -> NeedData:
    kept = need_training_customers(base, customers, cfg)
    scaled, parameters = fs.feature_set(
        base.features, customers, cfg.need_set, cfg.period, fit_customers=kept
    )
    long = scaled.join(kept.select("customer_id"), "customer_id", "left_semi")
    long = materialise(long, "need_long")
    dictionary = materialise(ds.feature_dictionary(long), "need_dictionary")
    # As wide as the feature list: its names are few and go to the driver as labels.
    names = [row[0] for row in dictionary.orderBy("feature_idx").select("feature_name").collect()]
    original = (
        long
        if parameters is None
        else fs.invert_standardizer(long, parameters, cfg.need_set.method)
    )
    scaled_vectors = ds.feature_vectors(long.join(dictionary, "feature_name"), len(names))
    original_vectors = ds.feature_vectors(original.join(dictionary, "feature_name"), len(names))
    both = scaled_vectors.join(
        original_vectors.withColumnRenamed("features", "original"), "customer_id"
    )
    return NeedData(materialise(both, "need_vectors"), names)


def train_need(base: Base, customers: DataFrame, cfg: RunConfig, clusters: int = 4) -> NeedModel:
    data = need_vectors(base, customers, cfg)
    fitted = mo.fit_clusters(data.vectors, clusters, cfg)
    labelled = fitted.transform(data.vectors).select(
        "customer_id", F.col("prediction").alias("cluster"), F.col("original").alias("features")
    )
    clustered = materialise(labelled, "clustered")
    tree = fit_surrogate_tree(clustered)
    predicted = tree.transform(clustered)
    wide = predicted.select(
        F.col("prediction").cast("int").alias("prediction"), "features", "customer_id"
    )
    centres = [[0.0] * len(data.names)]
    summary = mo.cluster_summary(wide, centres, data.names).drop("distance_mean", "distance_std")
    return NeedModel(fitted, tree, clustered, summary, tree.thresholds(data.names))


def need_results(
    base: Base,
    profile: DataFrame,
    thresholds: ru.NeedThresholds,
    cfg: RunConfig,
    at: str,
) -> DataFrame:
    customers = co.profile_subset(profile, TYPE_B)
    minimum = 3 if cfg.outliers is None else cfg.outliers.min_transactions
    needs = ru.assign_needs(customers, base.features, thresholds, cfg, at, minimum)
    return ru.override_needs(needs, profile)


@dataclass(frozen=True)
class Level1Model:
    """Two clusters of the typeB customers over the profile features, and what they read."""

    clusters: KMeansModel
    dictionary: DataFrame
    width: int
    standardizer: DataFrame | None


def _level_1_vectors(
    base: Base, customers: DataFrame, model: Level1Model | None, cfg: RunConfig
) -> tuple[DataFrame, DataFrame, int, DataFrame | None]:
    chosen, standardizer = fs.feature_set(
        base.features,
        customers,
        cfg.profile_set,
        cfg.period,
        parameters=None if model is None else model.standardizer,
    )
    chosen = materialise(chosen, "level_1_set")
    dictionary = (
        materialise(ds.feature_dictionary(chosen), "level_1_dictionary")
        if model is None
        else model.dictionary
    )
    width = dictionary.count() if model is None else model.width
    scoring = ds.need_scoring_set(customers, chosen, dictionary)
    vectors = materialise(ds.feature_vectors(scoring, width, "customer_idx"), "level_1_vectors")
    return vectors, dictionary, width, standardizer


def train_level_1(base: Base, customers: DataFrame, cfg: RunConfig) -> Level1Model:
    vectors, dictionary, width, standardizer = _level_1_vectors(base, customers, None, cfg)
    return Level1Model(mo.fit_clusters(vectors, 2, cfg), dictionary, width, standardizer)


def score_level_1(
    base: Base, customers: DataFrame, model: Level1Model, cfg: RunConfig, at: str
) -> DataFrame:
    """Cluster and segment of all given customers; those without features get the fallback."""
    vectors = _level_1_vectors(base, customers, model, cfg)[0]
    return mo.fill_level_1(mo.score_level_1(model.clusters, vectors, cfg, at), customers, cfg, at)


def save_level_1(model: Level1Model, version: str) -> None:
    model.clusters.write().overwrite().save(f"{version}/clusters")
    publish_parquet(model.dictionary, f"{version}/dictionary")
    if model.standardizer is not None:
        publish_parquet(model.standardizer, f"{version}/standardizer")
    mark_complete(model.dictionary.sparkSession, version)


def load_level_1(spark: SparkSession, version: str, cfg: RunConfig) -> Level1Model:
    dictionary = read_published(spark, f"{version}/dictionary")
    return Level1Model(
        KMeansModel.load(f"{version}/clusters"),
        dictionary,
        dictionary.count(),
        _standardizer(spark, version, cfg),
    )


def _standardizer(spark: SparkSession, version: str, cfg: RunConfig) -> DataFrame | None:
    return read_published(spark, f"{version}/standardizer") if cfg.profile_set.standardize else None


def save_profile(model: ProfileModel, version: str) -> None:
    """All of a training in one folder: scoring never mixes two trainings."""
    if isinstance(model.classifier, BoostedTrees):
        model.classifier.save(f"{version}/classifier")
    else:
        model.classifier.write().overwrite().save(f"{version}/classifier")
    publish_parquet(model.dictionary, f"{version}/dictionary")
    publish_parquet(model.coefficients, f"{version}/coefficients")
    publish_parquet(model.test_predictions, f"{version}/test_predictions")
    publish_parquet(model.metrics, f"{version}/metrics")
    if model.standardizer is not None:
        publish_parquet(model.standardizer, f"{version}/standardizer")
    mark_complete(model.dictionary.sparkSession, version)


def load_profile(spark: SparkSession, version: str, cfg: RunConfig) -> ProfileModel:
    saved = f"{version}/classifier"
    if cfg.model == mo.LOGISTIC:
        classifier = LogisticRegressionModel.load(saved)
    else:
        classifier = BoostedTrees.load(spark, saved)
    dictionary = read_published(spark, f"{version}/dictionary")
    return ProfileModel(
        classifier=classifier,
        dictionary=dictionary,
        width=dictionary.count(),
        standardizer=_standardizer(spark, version, cfg),
        coefficients=read_published(spark, f"{version}/coefficients"),
        test_predictions=read_published(spark, f"{version}/test_predictions"),
        metrics=read_published(spark, f"{version}/metrics"),
    )


def save_need(
    spark: SparkSession, need: NeedModel, thresholds: ru.NeedThresholds, version: str
) -> None:
    need.clusters.write().overwrite().save(f"{version}/clusters")
    need.tree.save(spark, f"{version}/tree")
    row = [tuple(vars(thresholds).values())]
    publish_parquet(spark.createDataFrame(row, list(vars(thresholds))), f"{version}/thresholds")
    mark_complete(spark, version)


def load_thresholds(spark: SparkSession, version: str) -> ru.NeedThresholds:
    return ru.NeedThresholds(**read_published(spark, f"{version}/thresholds").first().asDict())


def run_month(
    src: Sources,
    cfg: RunConfig,
    folder: str,
    at: str,
    train: bool = True,
    train_needs: bool = True,
    fallback_thresholds: Mapping[str, float] | None = None,
    version: str | None = None,
) -> DataFrame:
    """One month from sales to the final table, published under ``folder``.

    A training writes its own version, stamped ``at``. With ``train`` off the models of the
    training at ``version`` are used (of the latest finished one by default).
    ``fallback_thresholds`` serve features the surrogate tree has no split on;
    without them such a tree is an error.
    """
    spark = src.sales.sparkSession
    home = f"{folder}/{cfg.country}"
    base = build_base(src, cfg)

    def chosen(kind: str) -> str:
        if version is not None:
            return version_path(f"{home}/{kind}", version)
        return latest_version(spark, f"{home}/{kind}", COMPLETE)

    if train:
        model = train_profile(base, src, cfg, at)
        save_profile(model, version_path(f"{home}/{PROFILE_MODEL}", at))
    else:
        model = load_profile(spark, chosen(PROFILE_MODEL), cfg)
    scored = materialise(score_customers(base, model, cfg), "scored")
    profile = publish_parquet(
        profile_results(base, scored, src, cfg, at), f"{home}/profile_{cfg.period}"
    )
    if train_needs:
        need = train_need(base, co.profile_subset(profile, TYPE_B), cfg)
        thresholds = ru.NeedThresholds.from_tree(need.splits, fallback_thresholds)
        save_need(spark, need, thresholds, version_path(f"{home}/{NEED_MODEL}", at))
    else:
        thresholds = load_thresholds(spark, chosen(NEED_MODEL))
    needs = publish_parquet(
        need_results(base, profile, thresholds, cfg, at), f"{home}/needs_{cfg.period}"
    )
    return publish_parquet(co.final_results(profile, needs), f"{home}/final_{cfg.period}")
