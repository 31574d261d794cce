"""Behavioural features of each customer, as rows (customer_id, feature_name, feature_value)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from clientela.config import DEPARTMENTS, RunConfig
from clientela.functions.columns import months_between_calendar
from clientela.functions.storage import materialise, tasks_of
from clientela.operators import measures as m
from clientela.operators.lines import (
    beside_lines,
    catalog,
    join_catalog,
    period_window,
    sales_and_credit_notes,
    valid_sales,
    with_customer,
    with_transaction,
)
from clientela.sources.sinks import put_partitions
from clientela.sources.tables import LINES_PER_TASK, Sources

FEATURE_SCHEMA = StructType(
    [
        StructField("customer_id", StringType()),
        StructField("feature_name", StringType()),
        StructField("feature_value", DoubleType()),
    ]
)


def _of(kind: str, measure: str) -> Column:
    return F.max(F.when(F.col("kind") == kind, F.col(measure)))


# Aggregates over the measures of one customer. They make the totals table, and over a
# customer window they are the denominators of the other features.
TOTALS: dict[str, Callable[[], Column]] = {
    "transactions": lambda: _of(m.ALL, "transactions"),
    "units": lambda: _of(m.ALL, "units"),
    "amount": lambda: _of(m.ALL, "amount"),
    "last_day": lambda: _of(m.ALL, "last_day"),
    "stores": lambda: F.count_if(F.col("kind") == m.LOCATION),
    "items": lambda: _of(m.ITEMS, "members"),
    "sets": lambda: _of(m.SETS, "members"),
    "departments": lambda: _of(m.DEPARTMENTS_SEEN, "members"),
    "top_store": lambda: _of(m.STORE, "transactions"),
    "top_family_trx": lambda: _of(m.FAMILY, "transactions"),
    "top_subfamily_trx": lambda: _of(m.SUBFAMILY, "transactions"),
    "top_family_units": lambda: _of(m.FAMILY, "units"),
    "top_subfamily_units": lambda: _of(m.SUBFAMILY, "units"),
}


def _total(name: str) -> Column:
    return F.col(f"total_{name}").cast("double")


def _department_share() -> Column:
    return _total("departments") / DEPARTMENTS


def _months_since(cfg: RunConfig) -> Column:
    _, end = period_window(cfg.period, cfg.months)
    return months_between_calendar(F.lit(end), F.col("total_last_day")).cast("long")


def known_items(src: Sources, cfg: RunConfig, tasks: int | None = None) -> DataFrame:
    """The catalog, written first: with its true size known, Spark broadcasts it or not.

    ``tasks`` is the number of tasks that the lines which meet it ask for.
    """
    return beside_lines(materialise(catalog(src.items, src.main_skus, cfg), "catalog"), tasks)


def feature_lines(
    src: Sources, cfg: RunConfig, items: DataFrame, credit_notes: bool = True
) -> DataFrame:
    """The sale lines of the window with item codes, canonical customer and transaction."""
    lines = sales_and_credit_notes(src.sales, cfg) if credit_notes else valid_sales(src.sales, cfg)
    joined = join_catalog(lines, items)
    return with_customer(with_transaction(joined, cfg))


def measure_tasks(src: Sources) -> int | None:
    """Tasks for the sale lines, so that a task's share does not grow with the table.

    The count of a plain table is in its files' footers: no line is read for it.
    """
    lines = (src.sales if src.counted is None else src.counted).count()
    return tasks_of(src.sales.sparkSession, lines, LINES_PER_TASK)


TOTAL_KINDS = (m.ALL, m.LOCATION, m.ITEM)


def totals(src: Sources, cfg: RunConfig, customers: DataFrame) -> DataFrame:
    """One row per customer with a valid sale: the denominators and counts of all features."""
    tasks = measure_tasks(src)
    items = known_items(src, cfg, tasks)
    lines = feature_lines(src, cfg, items, credit_notes=False)
    measured = m.customer_measures(lines, items, TOTAL_KINDS, tasks=tasks)
    names = ("transactions", "units", "amount", "last_day", "stores", "items", "sets", "departments")
    return (
        measured.groupBy("customer_id")
        .agg(*[TOTALS[name]().alias(f"total_{name}") for name in names])
        .join(customers.select("customer_id"), "customer_id", "left_semi")
        .select(
            "customer_id",
            _total("units").alias("total_units_cnt"),
            _total("amount").alias("total_sales_amt"),
            _total("stores").alias("total_stores"),
            _total("items").alias("total_distinct_items"),
            _total("sets").alias("total_distinct_sets"),
            _department_share().alias("per_distinct_departments"),
            _total("transactions").alias("total_transactions"),
            _months_since(cfg).alias("months_since_last_trx"),
        )
    )


@dataclass(frozen=True)
class Emitted:
    """Features emitted for the measure rows of one kind.

    ``values`` are (name, value) pairs; ``needs`` are the kinds whose totals they read.
    """

    kind: str
    values: Sequence[tuple[Column, Column]]
    needs: tuple[str, ...] = ()
    valid: Column | None = None


ITEM_KINDS = (m.SKUS, m.ITEMS, m.SETS, m.DEPARTMENTS_SEEN, m.SUBFAMILIES, m.MAIN_SKU)

FAMILIES = (
    "per_trx_store",
    "top_store",
    "item_pro",
    "per_trx_hour",
    "per_trx_weekday",
    "per_trx_channel",
    "from_totals",
    "family_completeness",
    "per_trx_hier",
    "per_uni_hier",
    "trx_hier",
    "ntcr",
    "skus",
    "per_trx_rent",
    "per_trx_fctr",
    "top_share",
)


def _emitted(cfg: RunConfig) -> dict[str, list[Emitted]]:
    transactions = F.col("transactions").cast("double")
    units = F.col("units").cast("double")
    members = F.col("members").cast("double")
    trx_share = transactions / _total("transactions")

    def labelled(prefix: str) -> Column:
        return F.concat(F.lit(prefix), F.col("label"))

    def total(name: str, value: Column, *needs: str) -> Emitted:
        return Emitted(m.ALL, [(F.lit(name), value)], needs)

    def top(name: str, kind: str, best: str, whole: str) -> Emitted:
        # The largest share is the largest part over the same total.
        value = _total(best) / _total(whole)
        return Emitted(m.ALL, [(F.lit(name), value)], (kind,), F.col(f"total_{best}").isNotNull())

    return {
        "per_trx_store": [Emitted(m.STORE, [(labelled("per_trx_store_"), trx_share)])],
        "top_store": [top("per_trx_cuchi_store", m.STORE, "top_store", "transactions")],
        "item_pro": [
            Emitted(
                m.MAIN_SKU,
                [(labelled("item_pro_"), F.when(transactions > 0, 1.0).otherwise(0.0))],
            )
        ],
        "per_trx_hour": [Emitted(m.HOUR, [(labelled("per_trx_hour_"), trx_share)])],
        "per_trx_weekday": [Emitted(m.WEEKDAY, [(labelled("per_trx_weekday_"), trx_share)])],
        "per_trx_channel": [Emitted(m.CHANNEL, [(labelled("per_trx_channel_"), trx_share)])],
        "from_totals": [
            total("per_distinct_department", _department_share(), m.ITEM),
            total("months_since_last_trx", _months_since(cfg).cast("double")),
            total("avg_units_trx", _total("units") / _total("transactions")),
            total("set_diversity", _total("sets") / _total("items"), m.ITEM),
            total("total_stores", _total("stores"), m.LOCATION),
            total("total_units_cnt", _total("units")),
            total("total_sales_amt", _total("amount")),
            total("total_transactions", _total("transactions")),
            total("avg_ticket", _total("amount") / _total("transactions")),
        ],
        "family_completeness": [
            Emitted(
                m.SUBFAMILIES, [(labelled("per_family_completeness_"), members / F.col("whole"))]
            )
        ],
        "per_trx_hier": [
            Emitted(level, [(labelled(f"per_trx_{level}_"), trx_share)])
            for level in (m.FAMILY, m.GROUP, m.SUBFAMILY, m.DEPARTMENT)
        ],
        "per_uni_hier": [
            Emitted(level, [(labelled(f"per_uni_{level}_"), units / _total("units"))])
            for level in (m.FAMILY, m.GROUP, m.SUBFAMILY)
        ],
        "trx_hier": [Emitted(m.SUBFAMILY, [(labelled("trx_N1_"), transactions)])],
        "ntcr": [
            Emitted(
                m.CREDITED,
                [
                    (F.lit("per_trx_ntcr"), trx_share),
                    (F.lit("per_sales_ntcr"), F.col("amount").cast("double") / _total("amount")),
                ],
                valid=F.col("total_transactions").isNotNull(),
            )
        ],
        "skus": [Emitted(m.SKUS, [(labelled("skus_N1_"), members)])],
        "per_trx_rent": [Emitted(m.RENT, [(F.lit("per_trx_rent"), trx_share)])],
        "per_trx_fctr": [Emitted(m.INVOICED, [(F.lit("per_trx_fctr"), trx_share)])],
        "top_share": [
            top("per_trx_frec_N0", m.FAMILY, "top_family_trx", "transactions"),
            top("per_trx_frec_N1", m.SUBFAMILY, "top_subfamily_trx", "transactions"),
            top("per_uni_frec_family", m.FAMILY, "top_family_units", "units"),
            top("per_uni_frec_subfamily", m.SUBFAMILY, "top_subfamily_units", "units"),
        ],
    }


def features(
    src: Sources, cfg: RunConfig, customers: DataFrame, families: Sequence[str] = FAMILIES
) -> DataFrame:
    """The features of the chosen families for a customer set.

    Sale lines are read once, whatever the number of families. The customer set is
    applied to the aggregated rows, not to the lines.
    """
    chosen, kinds = _chosen(cfg, families)
    tasks = measure_tasks(src)
    items = known_items(src, cfg, tasks)
    lines = feature_lines(src, cfg, items, credit_notes=m.CREDITED in kinds)
    measured = m.customer_measures(lines, items, kinds, cfg.strict_store_label, tasks)
    return as_features(emit_features(measured, customers, chosen))


def _chosen(cfg: RunConfig, families: Sequence[str]) -> tuple[list[Emitted], list[str]]:
    """What the families emit, and the kinds of measures that takes."""
    defined = _emitted(cfg)
    chosen = [emitted for name in families for emitted in defined[name]]
    kinds = {m.ALL}
    for emitted in chosen:
        kinds.update(emitted.needs)
        kinds.add(m.ITEM if emitted.kind in ITEM_KINDS else emitted.kind)
    return chosen, sorted(kinds)


def put_months(src: Sources, cfg: RunConfig, path: str) -> None:
    """Measure the months of the run's window and put them into the store at ``path``.

    A month that is there already is replaced as a whole, so months with late lines are measured
    again and a repeated run changes nothing. ``replace(cfg, months=1)`` reads the lines of
    the last month alone.
    """
    lines = feature_lines(src, cfg, known_items(src, cfg))
    put_partitions(m.month_measures(lines, cfg.strict_store_label), path, "month")


def features_of_months(
    src: Sources,
    cfg: RunConfig,
    path: str,
    customers: DataFrame,
    families: Sequence[str] = FAMILIES,
) -> DataFrame:
    """``features`` of the window from the store alone: no sale line is read.

    Months outside of the window are not read; they may stay in the store. Counts by family,
    group and department are by the catalog when the month was measured, distinct counts of
    items by the catalog of today.
    """
    spark = src.items.sparkSession
    start, end = period_window(cfg.period, cfg.months)
    first, stop = (day.year * 100 + day.month for day in (start, end))
    stored = spark.read.parquet(path).filter((F.col("month") >= first) & (F.col("month") < stop))
    chosen, kinds = _chosen(cfg, families)
    measured = m.merged_measures(stored, known_items(src, cfg), kinds)
    return as_features(emit_features(measured, customers, chosen))


def emit_features(
    measured: DataFrame, customers: DataFrame, chosen: Sequence[Emitted]
) -> DataFrame:
    """Turn measures into feature rows, next to the totals of their customer."""
    everyone = Window.partitionBy("customer_id")
    known = measured.join(customers.select("customer_id"), "customer_id", "left_semi")
    placed = known.withColumns(
        {f"total_{name}": total().over(everyone) for name, total in TOTALS.items()}
    )
    by_kind: dict[str, list[Column]] = {}
    for emitted in chosen:
        for name, value in emitted.values:
            row = F.struct(name.alias("feature_name"), value.alias("feature_value"))
            if emitted.valid is not None:
                row = F.when(emitted.valid, row)
            by_kind.setdefault(emitted.kind, []).append(row)
    rows = None
    for kind, entries in by_kind.items():
        test, values = F.col("kind") == kind, F.array(*entries)
        rows = F.when(test, values) if rows is None else rows.when(test, values)
    return (
        placed.select("customer_id", F.explode_outer(rows).alias("feature"))
        .filter(F.col("feature").isNotNull())
        .select("customer_id", "feature.feature_name", "feature.feature_value")
    )


def label_share(
    src: Sources, cfg: RunConfig, customers: DataFrame, label: Column
) -> DataFrame:
    """Share of a customer's transactions by any label of a sale line.

    The label Column is the whole feature name and may use the columns of the sale
    line and of the catalog; lines where it is NULL are left out.
    """
    tasks = measure_tasks(src)
    lines = feature_lines(src, cfg, known_items(src, cfg, tasks), credit_notes=False)
    labels = {m.ALL: F.lit(""), "custom": F.col("custom")}
    measured = m.with_members(
        m.label_measures(lines, {"custom": label}, labels, tasks=tasks), tasks
    )
    share = F.col("transactions").cast("double") / _total("transactions")
    return emit_features(measured, customers, [Emitted("custom", [(F.col("label"), share)])])


def top_value(features: DataFrame, pattern: str, name: str) -> DataFrame:
    """The largest value of each customer among the features with matching names."""
    return (
        features.filter(F.col("feature_name").like(pattern))
        .groupBy("customer_id")
        .agg(F.max("feature_value").alias("feature_value"))
        .select("customer_id", F.lit(name).alias("feature_name"), "feature_value")
    )


def as_features(df: DataFrame) -> DataFrame:
    """Rows with exactly the feature columns and types."""
    return df.to(FEATURE_SCHEMA)
