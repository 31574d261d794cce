"""Run parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

# Document types, unit, channel and hierarchy codes the input data uses.
RECEIPT = "blta"
INVOICE = "fctr"
CREDIT_NOTE = "ntcr"
DIRECT_SALES_AREA = "VE"
PREFERRED_CHANNEL = "SR"
OTHER_CHANNEL = "NSR"
RENT_FAMILY = "0626"
DEPARTMENTS = 6

# Segment names written to the result tables.
TYPE_A = "typeA"
TYPE_B = "typeB"
LARGE_COMPANY = "GGEE"
NEED_A = "L2A"
NEED_B = "L2B"
NEED_C = "L2C"
ACTIVE = "NO FUGADO"
CHURNED = "FUGADO"

# Feature patterns of the profile model (SQL LIKE).
PROFILE_FEATURES = (
    "avg_units_trx",
    "item_pro_%",
    "per_sales_ntcr",
    "per_trx_N0%",
    "per_trx_N1%",
    "per_trx_N2%",
    "per_trx_channel_%",
    "per_trx_cuchi_store",
    "per_trx_hour_%",
    "per_trx_ntcr",
    "per_trx_store_%",
    "per_trx_weekday_%",
    "per_uni_N0%",
    "per_uni_N1%",
    "per_uni_N2%",
    "set_diversity",
    "skus_N1%",
    "total_stores",
    "trx_N1%",
)
PROFILE_STANDARDIZED = (
    "avg_units_trx",
    "per_sales_ntcr",
    "per_trx_ntcr",
    "set_diversity",
    "skus_N1%",
    "total_stores",
    "trx_N1%",
)
NEED_FEATURES = ("months_since_last_trx", "per_trx_frec_N0", "total_sales_amt")
NEED_STANDARDIZED = ("months_since_last_trx", "total_sales_amt")


@dataclass(frozen=True)
class OutlierRule:
    """Customers kept for fitting: enough transactions and below the upper fence."""

    min_transactions: int = 3
    feature: str = "total_sales_amt"
    fence_width: float = 3.0


@dataclass(frozen=True)
class FeatureSetConfig:
    """Which features a model sees, and which of them are standardized."""

    features: tuple[str, ...]
    standardized: tuple[str, ...]
    method: str = "MinMax"  # or "Z"
    standardize: bool = True


@dataclass(frozen=True)
class RunConfig:
    """One monthly run. Defaults are the production values of the segmentation.

    ``training_rows`` bounds the labelled customers that the classifier is fitted on
    (by a hash of the customer); None fits on all of them.
    """

    country: str = "CL"
    period: int = 202001
    months: int = 24
    business_unit: str = "ENT"
    history_from: str = "2016-01-01"

    ggee_tranche: int = 7
    cont_tranche: int = 4

    percentile: int = 5
    n_times: int = 4
    sample: float = 1.0
    train_share: float = 0.7
    seed: int = 27218
    country_without_pro_filter: str = "CO"

    model: str = "gbt"  # or "logreg"
    threshold: float = 0.5
    tree_depth: int = 20
    trees: int = 400
    training_rows: int | None = None
    learning_rate: float = 0.1
    logreg_iterations: int = 20000

    cluster_init: str = "random"  # "k-means||" or "pca"
    cluster_iterations: int = 1000
    cluster_restarts: int = 10

    strict_trx_key: bool = False
    strict_store_label: bool = False
    canonical_loyalty: bool = False
    dedupe_ggee: bool = False

    profile_set: FeatureSetConfig = field(
        default_factory=lambda: FeatureSetConfig(PROFILE_FEATURES, PROFILE_STANDARDIZED)
    )
    need_set: FeatureSetConfig = field(
        default_factory=lambda: FeatureSetConfig(NEED_FEATURES, NEED_STANDARDIZED)
    )
    outliers: OutlierRule | None = field(default_factory=OutlierRule)
