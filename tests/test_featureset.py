from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clientela.config import FeatureSetConfig, OutlierRule
from clientela.operators import featureset as fs

ROWS = [
    ("a", "x", 1.0), ("b", "x", 3.0), ("c", "x", 5.0),
    ("a", "same", 2.0), ("b", "same", 2.0),
    ("a", "y", None), ("b", "y", 4.0), ("c", "y", 8.0),
    ("a", "free", 10.0),
]


@pytest.fixture()
def features(spark):
    return spark.createDataFrame(ROWS, "customer_id string, feature_name string, feature_value double")


@pytest.fixture()
def customers(spark):
    return spark.createDataFrame([("a",), ("b",), ("c",)], "customer_id string")


def values(df):
    return {(r.customer_id, r.feature_name): r.feature_value for r in df.collect()}


def test_fit_leaves_out_constant_features(features, customers):
    fitted = fs.fit_standardizer(features, customers, ["x", "same", "y"], "MinMax", 200101)
    rows = {r.feature_name: r for r in fitted.collect()}
    assert set(rows) == {"x", "y"}
    assert (rows["x"].avg_feature, rows["x"].min_value, rows["x"].max_value) == (3.0, 1.0, 5.0)


@pytest.mark.parametrize("method", ["MinMax", "Z"])
def test_apply_and_invert(features, customers, method):
    cfg = FeatureSetConfig(("x", "y", "free", "same"), ("x", "y", "same"), method)
    scaled, parameters = fs.feature_set(features, customers, cfg, 200101)
    got = values(scaled)
    assert got["a", "free"] == 10.0 and got["a", "same"] == 2.0 and got["a", "y"] is None
    if method == "MinMax":
        assert [got[c, "x"] for c in "abc"] == [0.0, 0.5, 1.0]
    back = values(fs.invert_standardizer(scaled, parameters, method))
    for key, value in values(features).items():
        assert back[key] == pytest.approx(value)


def test_scoring_uses_given_parameters(features, customers):
    cfg = FeatureSetConfig(("x",), ("x",))
    _, parameters = fs.feature_set(features, customers, cfg, 200101)
    later = features.withColumn("feature_value", F.col("feature_value") * 3)
    got = values(fs.feature_set(later, customers, cfg, 200102, parameters=parameters)[0])
    assert got["c", "x"] == 3.5


def test_no_standardization_and_no_pattern(features, customers):
    cfg = FeatureSetConfig((), (), standardize=False)
    chosen, parameters = fs.feature_set(features, customers, cfg, 200101)
    assert parameters is None and chosen.count() == len(ROWS)


def test_unknown_method(features, customers):
    with pytest.raises(ValueError):
        fs.apply_standardizer(features, features, "log")


def test_drop_outliers(spark):
    rows = []
    for i in range(1, 5):
        rows += [(str(i), "total_sales_amt", float(i)), (str(i), "total_transactions", 3.0)]
    rows += [("few", "total_sales_amt", 2.0), ("few", "total_transactions", 2.0)]
    rows += [("big", "total_sales_amt", 1000.0), ("big", "total_transactions", 9.0)]
    rows += [("half", "total_transactions", 9.0)]
    names = "customer_id string, feature_name string, feature_value double"
    features = spark.createDataFrame(rows, names)
    customers = features.select("customer_id").distinct()
    kept = fs.drop_outliers(features, customers, OutlierRule(), exact=True)
    assert sorted(r.customer_id for r in kept.collect()) == ["1", "2", "3", "4"]
    fence = fs.outlier_fence(features, customers, OutlierRule(), exact=True).first()
    at_fence = spark.createDataFrame([("z", fence.fence)], "customer_id string, feature_value double")
    table = fs.outlier_fence(features, customers, OutlierRule(), exact=True)
    assert fs.below_fence(at_fence, table).count() == 0


def test_the_fence_is_exact_by_default(spark):
    rows = [(str(i), "total_sales_amt", float(i)) for i in range(1, 5)]
    features = spark.createDataFrame(rows, "customer_id string, feature_name string, feature_value double")
    fence = fs.outlier_fence(features, features.select("customer_id"), OutlierRule()).first()
    assert (fence.q25, fence.q75) == (1.75, 3.25)
