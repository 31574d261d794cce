"""Selecting and standardizing features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from clientela.config import FeatureSetConfig, OutlierRule
from clientela.functions.columns import like_any
from clientela.functions.ranking import with_position
from clientela.functions.storage import materialise

MIN_MAX = "MinMax"
Z_SCORE = "Z"


def select_features(features: DataFrame, customers: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Features of a customer set whose names are LIKE one of the patterns (none: all)."""
    chosen = features.filter(like_any(F.col("feature_name"), patterns))
    return chosen.join(customers.select("customer_id"), "customer_id")


def fit_standardizer(
    features: DataFrame, customers: DataFrame, patterns: Sequence[str], method: str, period: int
) -> DataFrame:
    """Mean, deviation and range of each matching feature; constant features are left out."""
    value = F.col("feature_value")
    return (
        select_features(features, customers, patterns)
        .groupBy("feature_name")
        .agg(
            F.avg(value).alias("avg_feature"),
            F.stddev_pop(value).alias("std_dev_feature"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
        )
        .filter(F.col("std_dev_feature") != 0)
        .select(
            F.lit(period).alias("period"),
            F.lit(method).alias("std_type"),
            "feature_name",
            "avg_feature",
            "std_dev_feature",
            "min_value",
            "max_value",
        )
    )


def _scale(method: str) -> tuple[Column, Column]:
    """Origin and unit of a method."""
    if method == Z_SCORE:
        return F.col("avg_feature"), F.col("std_dev_feature")
    if method == MIN_MAX:
        return F.col("min_value"), F.col("max_value") - F.col("min_value")
    raise ValueError(f"unknown standardization {method!r}, use {Z_SCORE!r} or {MIN_MAX!r}")


def _rescale(
    features: DataFrame, parameters: DataFrame, method: str, value: Column
) -> DataFrame:
    """``parameters`` should be a written table: its size decides on a broadcast.

    Parameters that were fitted for another method are an error.
    """
    scales = parameters.drop("period").withColumn("known", F.lit(True))
    other = F.concat(F.lit(f"not fitted for {method} but for "), F.col("std_type"))
    result = (
        F.when(F.col("known") & (F.col("std_type") != method), F.raise_error(other).cast("double"))
        .when(F.col("known"), value)
        .otherwise(F.col("feature_value"))
    )
    return features.join(scales, "feature_name", "left").select(
        *[c for c in features.columns if c != "feature_value"], result.alias("feature_value")
    )


def apply_standardizer(features: DataFrame, parameters: DataFrame, method: str) -> DataFrame:
    """Standardize features that have parameters; the others pass as they are."""
    origin, unit = _scale(method)
    return _rescale(features, parameters, method, (F.col("feature_value") - origin) / unit)


def invert_standardizer(features: DataFrame, parameters: DataFrame, method: str) -> DataFrame:
    """Back to original values, for the features that are present."""
    origin, unit = _scale(method)
    return _rescale(features, parameters, method, F.col("feature_value") * unit + origin)


def feature_set(
    features: DataFrame,
    customers: DataFrame,
    cfg: FeatureSetConfig,
    period: int,
    fit_customers: DataFrame | None = None,
    parameters: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """The features a model sees, and the parameters they were standardized with.

    Given ``parameters`` are used as they are (scoring); otherwise they are fitted on
    ``fit_customers``, by default on all ``customers`` (training).
    """
    chosen = select_features(features, customers, cfg.features)
    if not cfg.standardize:
        return chosen, None
    if parameters is None:
        fitted = fit_standardizer(
            features,
            customers if fit_customers is None else fit_customers,
            cfg.standardized,
            cfg.method,
            period,
        )
        parameters = materialise(fitted, "standardizer")
    return apply_standardizer(chosen, parameters, cfg.method), parameters


def _exact_quartiles(members: DataFrame) -> DataFrame:
    """Interpolated quartiles from the rows at their positions in the global order.

    Nothing but those four rows meets in one task.
    """
    placed = with_position(
        members.select("customer_id", "value"), "value", "customer_id", name="place"
    )
    last, place = F.col("place_of") - 1, F.col("place")

    def neighbour(share: float, rounded) -> Column:
        return F.when(place == rounded(last * share), F.col("value"))

    def weight(share: float) -> Column:
        return F.max(last * share - F.floor(last * share))

    def quantile(share: float) -> Column:
        low, high = F.max(neighbour(share, F.floor)), F.max(neighbour(share, F.ceil))
        return low + (high - low) * weight(share)

    wanted = [place == rounded(last * share) for share in (0.25, 0.75) for rounded in (F.floor, F.ceil)]
    return placed.filter(reduce(or_, wanted)).agg(
        quantile(0.25).alias("q25"), quantile(0.75).alias("q75")
    )


def _approximate_quartiles(members: DataFrame) -> DataFrame:
    """Quartiles that are values of the set, in bounded memory and without a sort."""
    return members.agg(
        F.percentile_approx("value", 0.25, 10000).alias("q25"),
        F.percentile_approx("value", 0.75, 10000).alias("q75"),
    )


def outlier_fence(
    features: DataFrame, customers: DataFrame, rule: OutlierRule, exact: bool = True
) -> DataFrame:
    """Quartiles of the feature over the customer set and the upper fence, in one row."""
    value = F.coalesce("feature_value", F.lit(0.0)).alias("value")
    members = features.filter(F.col("feature_name") == rule.feature).join(
        customers.select("customer_id"), "customer_id"
    )
    members = members.select("customer_id", value)
    quartiles = _exact_quartiles(members) if exact else _approximate_quartiles(members)
    width = F.col("q75") - F.col("q25")
    return quartiles.withColumn("fence", F.col("q75") + F.lit(float(rule.fence_width)) * width)


def below_fence(values: DataFrame, fence: DataFrame) -> DataFrame:
    """Rows with a value below the fence, a one-row table read as a scalar subquery."""
    return values.filter(F.col("feature_value") < fence.select("fence").scalar())


def drop_outliers(
    features: DataFrame, customers: DataFrame, rule: OutlierRule, exact: bool = True
) -> DataFrame:
    """Customers with enough transactions and a feature value below the fence."""
    limit = outlier_fence(features, customers, rule, exact).select("fence").scalar()
    name, value = F.col("feature_name"), F.col("feature_value")
    enough = (name == "total_transactions") & (value >= rule.min_transactions)
    inside = (name == rule.feature) & (value < limit)
    return (
        features.filter(name.isin("total_transactions", rule.feature))
        .groupBy("customer_id")
        .agg(F.bool_or(enough).alias("enough"), F.bool_or(inside).alias("inside"))
        .filter("enough AND inside")
        .join(customers.select("customer_id"), "customer_id", "left_semi")
        .select("customer_id")
    )
