"""Training and scoring sets: long form with dense indices, and vectors."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from clientela.config import RunConfig
from clientela.functions.columns import hash_below
from clientela.functions.ranking import dense_index

SPARSE = 0  # type tag of a sparse vector in the storage form of VectorUDT


def training_long(customers: DataFrame, feature_set: DataFrame) -> DataFrame:
    """The features of the training customers."""
    return customers.join(feature_set, "customer_id").filter(F.col("feature_name").isNotNull())


def feature_dictionary(long: DataFrame) -> DataFrame:
    """0-based index of each feature name, in name order."""
    return dense_index(long.select("feature_name").distinct(), "feature_name", name="feature_idx")


def customer_dictionary(long: DataFrame) -> DataFrame:
    """0-based index of each customer, in id order."""
    return dense_index(long.select("customer_id").distinct(), "customer_id", name="customer_idx")


def training_set(long: DataFrame, features: DataFrame, customers: DataFrame) -> DataFrame:
    """Attach both indices. The dictionaries are written tables of known size."""
    return long.join(customers, "customer_id").join(features, "feature_name")


def scoring_set(
    customers: DataFrame, feature_set: DataFrame, dictionary: DataFrame, model_features: DataFrame
) -> DataFrame:
    """Features known to dictionary and model, of customers with at least one known value.

    ``feature_set`` is a written table. Its rows are cut to customers by a partial
    aggregation before any shuffle, so only a row per customer and task moves for the index.
    """
    known = feature_set.join(dictionary, "feature_name")
    valued = known.filter(F.col("feature_value").isNotNull()).select("customer_id").distinct()
    with_value = valued.join(customers.select("customer_id", "target").distinct(), "customer_id")
    indexed = dense_index(with_value, "customer_id", "target", name="customer_idx")
    modelled = model_features.select("feature_name").distinct()
    return (
        known.join(modelled, "feature_name", "left_semi")
        .join(indexed, "customer_id")
        .select(
            "customer_id", "customer_idx", "feature_name", "feature_idx", "feature_value", "target"
        )
    )


def need_scoring_set(customers: DataFrame, feature_set: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Scoring set of the necessity levels: known features of a customer set, no target."""
    known = customers.select("customer_id").join(feature_set, "customer_id")
    known = known.join(dictionary, "feature_name")
    return known.join(customer_dictionary(known), "customer_id")


def feature_vectors(long: DataFrame, width: int, *keep: str) -> DataFrame:
    """One sparse vector per customer, as wide as the dictionary.

    Values of the same customer and feature add up, missing values are 0. ``keep`` are
    columns with one value per customer. The Arrow step only labels the two arrays as
    a vector; it sees no row in Python.
    """
    per_feature = (
        long.repartition("customer_id")
        .groupBy("customer_id", "feature_idx")
        .agg(
            F.sum(F.coalesce("feature_value", F.lit(0.0))).alias("value"),
            *[F.max(c).alias(c) for c in keep],
        )
    )
    entry = F.struct(F.col("feature_idx").cast("int").alias("idx"), "value")
    arrays = (
        per_feature.groupBy("customer_id")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"), *[F.max(c).alias(c) for c in keep])
        .select(
            "customer_id",
            *keep,
            F.col("entries.idx").alias("indices"),
            F.col("entries.value").alias("values"),
        )
    )
    kept = [arrays.schema["customer_id"], *[arrays.schema[c] for c in keep]]
    schema = StructType([*kept, StructField("features", VectorUDT(), False)])

    def to_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            vector = pa.StructArray.from_arrays(
                [
                    pa.array([SPARSE] * rows, pa.int8()),
                    pa.array([width] * rows, pa.int32()),
                    batch.column("indices"),
                    batch.column("values"),
                ],
                names=["type", "size", "indices", "values"],
            )
            columns = [batch.column(field.name) for field in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, vector], names=[*[field.name for field in kept], "features"]
            )

    return arrays.mapInArrow(to_vectors, schema)


def train_test_split(customers: DataFrame, cfg: RunConfig) -> DataFrame:
    """Mark the training share by a hash of the customer: stable, and no shuffle."""
    return customers.withColumn(
        "is_train", hash_below(F.col("customer_id"), cfg.seed, "split", cfg.train_share)
    )
