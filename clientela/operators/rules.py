"""Business rules on top of the models, each as one declarative expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Window, functions as F

from clientela.config import (
    ACTIVE,
    CHURNED,
    INVOICE,
    LARGE_COMPANY,
    NEED_A,
    NEED_B,
    NEED_C,
    TYPE_A,
    TYPE_B,
    RunConfig,
)
from clientela.sources.tables import Sources
from clientela.operators.cohorts import Cohorts, in_country

# Rule names in order of application, and the suffix each writes.
RULE_SUFFIX = {
    "factura": " (BR - Factura)",
    "lp": " (BR - LP)",
    "vvee": " (BR - VVEE PRO)",
    "sii": " (BR - SII)",
    "ggee": " (BR - GGEE SII)",
    "l2a_sii": " (BR - L2A SII)",
}
RULES = tuple(RULE_SUFFIX)
NEED_MODEL = "K-means - Decision Tree"
NEED_OVERRIDE_SUFFIX = " - BR SSII"


def _any(condition: Column, window) -> Column:
    return F.coalesce(F.bool_or(condition).over(window), F.lit(False))


def _loyalty(src: Sources, cfg: RunConfig) -> DataFrame:
    """Loyalty customers; their ids are compared as they are unless the run wants them trimmed."""
    known = in_country(src.main_customers, cfg)
    if cfg.canonical_loyalty:
        known = known.withColumn("customer_id", F.trim("customer_id"))
    return known


def apply_profile_rules(
    scored: DataFrame,
    cohorts: Cohorts,
    src: Sources,
    cfg: RunConfig,
    classified_at: str,
    upto: str = RULES[-1],
) -> DataFrame:
    """Profile of every known customer after the rules up to and including ``upto``.

    ``scored`` has customer_id, customer_idx, target, prob_typeB, prediction. The rows of
    all lists meet in one shuffle by customer; flags over the customer say which lists
    it is on, and from them follows which rows stay and what the last matching rule
    wrote. That is the result of inserting and updating rule by rule:

    * invoice customers without a score are added;
    * loyalty customers that are on no list yet, not excluded and not in direct sales
      are added; those present are relabelled;
    * direct sales customers that are not there yet are added;
    * registered customers below the limit that are not there yet are added; all
      registered ones are relabelled;
    * registered customers at or above the limit are added in any case;
    * customers registered in the middle range are relabelled, large ones included.
    """
    active = RULES[: RULES.index(upto) + 1]

    def listed(df: DataFrame, origin: str) -> DataFrame:
        return df.select("customer_id").withColumn("origin", F.lit(origin))

    everything = scored.select(
        "customer_id",
        F.lit("score").alias("origin"),
        "customer_idx",
        F.col("target").cast("long").alias("target"),
        "prob_typeB",
        F.col("prediction").cast("long").alias("prediction"),
        F.lit(None).cast("int").alias("tranche"),
    )
    large = cohorts.large.select(
        "customer_id", F.lit("register").alias("origin"), F.col("sales_tranche").alias("tranche")
    )
    for part in (
        listed(cohorts.invoice, "invoice"),
        listed(_loyalty(src, cfg), "loyalty"),
        listed(in_country(src.exclusions, cfg), "excluded"),
        listed(cohorts.direct, "direct"),
        large,
    ):
        everything = everything.unionByName(part, allowMissingColumns=True)

    # A missing id equals no other: each such row is on its own.
    alone = F.when(F.col("customer_id").isNull(), F.monotonically_increasing_id())
    same = Window.partitionBy("customer_id", "alone")
    origin, tranche = F.col("origin"), F.col("tranche")
    below = tranche < cfg.ggee_tranche
    middle = below & (tranche >= cfg.cont_tranche)
    flagged = everything.withColumn("alone", alone).withColumns(
        {
            "has_score": _any(origin == "score", same),
            "has_invoice": _any(origin == "invoice", same),
            "has_loyalty": _any(origin == "loyalty", same),
            "has_excluded": _any(origin == "excluded", same),
            "has_direct": _any(origin == "direct", same),
            "has_register": _any(origin == "register", same),
            "has_middle": _any((origin == "register") & middle, same),
        }
    )

    def enabled(rule: str, condition: Column) -> Column:
        return condition if rule in active else F.lit(False)

    early = F.col("has_score") | F.col("has_invoice")
    loyal = F.col("has_loyalty") & ~early & ~F.col("has_excluded") & ~F.col("has_direct")
    before_register = early | loyal | F.col("has_direct")
    is_large = (origin == "register") & ~below
    stays = (
        (origin == "score")
        | enabled("factura", (origin == "invoice") & ~F.col("has_score"))
        | enabled("lp", (origin == "loyalty") & loyal)
        | enabled("vvee", (origin == "direct") & ~early)
        | enabled("sii", (origin == "register") & below & ~before_register)
        | enabled("ggee", is_large)
    )
    invoiced = (origin == "invoice") | ((origin == "score") & (F.col("target") == 1))
    last_rule = (
        F.when(enabled("l2a_sii", F.col("has_middle")), "l2a_sii")
        .when(is_large, "ggee")
        .when(enabled("sii", F.col("has_register")), "sii")
        .when(origin == "direct", "vvee")
        .when(enabled("lp", F.col("has_loyalty")), "lp")
        .when(invoiced, "factura")
    )
    suffixes = F.create_map(*[F.lit(x) for pair in RULE_SUFFIX.items() for x in pair])
    given = F.when(origin.isin("invoice", "direct"), F.lit(1).cast("long")).otherwise(F.col("target"))
    ruled = flagged.filter(stays).withColumn("last_rule", last_rule)
    result = ruled.select(
        F.lit(cfg.country).alias("country_id"),
        F.concat(F.lit(cfg.model), F.coalesce(suffixes[F.col("last_rule")], F.lit(""))).alias("model"),
        F.lit(classified_at).cast("timestamp_ntz").alias("classification_dttm"),
        F.lit(cfg.period).cast("long").alias("period"),
        "customer_idx",
        "prob_typeB",
        "prediction",
        "customer_id",
        given.alias("target"),
        F.when(F.col("last_rule") == "ggee", LARGE_COMPANY)
        .when(F.col("last_rule").isNotNull() | (F.col("prediction") == 1), TYPE_B)
        .otherwise(TYPE_A)
        .alias("company_profile"),
        *([_any(is_large, same).alias("id_is_large"), is_large.alias("is_large")]
          if cfg.dedupe_ggee else []),
    )
    if cfg.dedupe_ggee:
        result = result.filter(F.col("is_large") | ~F.col("id_is_large"))
        result = result.drop("is_large", "id_is_large")
    return result


@dataclass(frozen=True)
class NeedThresholds:
    """Feature values that split the necessity segments."""

    total_sales_amt: float
    per_trx_frec_N0: float
    months_since_last_trx: float

    @classmethod
    def from_tree(
        cls, splits: Mapping[str, float], fallback: Mapping[str, float] | None = None
    ) -> NeedThresholds:
        """The splits of a tree; ``fallback`` serves features the tree did not use."""
        splits = {**(fallback or {}), **splits}
        missing = [f.name for f in fields(cls) if f.name not in splits]
        if missing:
            raise ValueError(
                f"the tree has no split on {missing}; give a fallback for them"
            )
        return cls(**{f.name: float(splits[f.name]) for f in fields(cls)})


def _feature_values(features: DataFrame, names: Sequence[str]) -> DataFrame:
    name, value = F.col("feature_name"), F.col("feature_value")
    return (
        features.filter(name.isin(*names))
        .groupBy("customer_id")
        .agg(*[F.max(F.when(name == n, value)).alias(n) for n in names])
    )


def assign_needs(
    customers: DataFrame,
    features: DataFrame,
    thresholds: NeedThresholds,
    cfg: RunConfig,
    classified_at: str,
    min_transactions: int = 3,
) -> DataFrame:
    """Segment and recency of each customer from its raw feature values."""
    values = _feature_values(
        features,
        ("total_sales_amt", "per_trx_frec_N0", "total_transactions", "months_since_last_trx"),
    )
    big = F.col("total_sales_amt") > thresholds.total_sales_amt
    focused = (F.col("per_trx_frec_N0") > thresholds.per_trx_frec_N0) & (
        F.col("total_transactions") >= min_transactions
    )
    recent = F.col("months_since_last_trx") <= thresholds.months_since_last_trx
    return customers.join(values, "customer_id", "left").select(
        F.lit(cfg.country).alias("country_id"),
        F.lit(NEED_MODEL).alias("model"),
        F.lit(classified_at).cast("timestamp_ntz").alias("classification_dttm"),
        F.lit(cfg.period).cast("long").alias("period"),
        "customer_id",
        F.when(big, 0).when(focused, 1).otherwise(2).cast("long").alias("cluster_id"),
        F.when(big, NEED_A).when(focused, NEED_B).otherwise(NEED_C).alias("necessity_lvl_2"),
        F.when(recent, ACTIVE).otherwise(CHURNED).alias("necessity_lvl_2_recency"),
    )


def override_needs(needs: DataFrame, profile: DataFrame) -> DataFrame:
    """Customers whose profile was set by the middle register range become L2A.

    The cluster stays as it was.
    """
    marked = (
        profile.filter(F.col("model").like("%L2A%"))
        .select("customer_id", F.lit(True).alias("marked"))
        .distinct()
    )
    return needs.join(marked, "customer_id", "left").select(
        "country_id",
        F.when(F.col("marked"), F.concat("model", F.lit(NEED_OVERRIDE_SUFFIX)))
        .otherwise(F.col("model"))
        .alias("model"),
        "classification_dttm",
        "period",
        "customer_id",
        "cluster_id",
        F.when(F.col("marked"), NEED_A).otherwise(F.col("necessity_lvl_2")).alias("necessity_lvl_2"),
        "necessity_lvl_2_recency",
    )
