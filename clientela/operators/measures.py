"""Distinct transactions, units and amounts of each customer by any set of labels.

Every label of a sale line becomes one row (``kind``, ``label``), after the lines
were spread by customer and transaction. Counting a transaction once per label is
then local to a partition; only partial results per customer and label move on. A
customer with a third of all lines is spread over its transactions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clientela.config import (
    CREDIT_NOTE,
    INVOICE,
    OTHER_CHANNEL,
    PREFERRED_CHANNEL,
    RENT_FAMILY,
)
from clientela.functions.columns import hour_of, store_label, two_digits, weekday_label
from clientela.functions.storage import spread

ALL = "all"
STORE = "store"
LOCATION = "location"
HOUR = "hour"
WEEKDAY = "weekday"
CHANNEL = "channel"
FAMILY = "N0"
SUBFAMILY = "N1"
GROUP = "N2"
DEPARTMENT = "ND"
RENT = "rent"
INVOICED = "fctr"
CREDITED = "ntcr"
ITEM = "item"

SKUS = "skus"
ITEMS = "items"
SETS = "sets"
DEPARTMENTS_SEEN = "departments"
SUBFAMILIES = "subfamilies"
MAIN_SKU = "main_sku"

# What the distinct counts need of an item. It joins the catalog behind the first two shuffles,
# which carry the item's key alone.
ITEM_COLUMNS = (
    "catalog_item_id",
    "hier_department_cd",
    "hier_set_cd",
    "family",
    "subfamily",
    "family_subfamilies",
    "is_main_sku",
)


# What the standard labels need of a line. Only these columns are shuffled; the labels
# are spelled out behind the shuffle.
CARRIED: dict[str, Callable[[], Column]] = {
    "location": lambda: F.col("location_id"),
    "hour": lambda: hour_of(F.col("transaction_dttm")),
    "preferred": lambda: F.trim("sub_channel_level1_sales_flg") == PREFERRED_CHANNEL,
    "rented": lambda: F.col("hier_family_cd") == RENT_FAMILY,
    "invoiced": lambda: F.col("sales_return_type_cd") == INVOICE,
    "item_id": lambda: F.col("item_id"),
    "family": lambda: F.col("family"),
    "subfamily": lambda: F.col("subfamily"),
    "group": lambda: F.col("group"),
    "department": lambda: F.col("department"),
}


def standard_labels(strict_store: bool = False) -> dict[str, Column]:
    """The label of a sale line for each kind; NULL where the line does not count for it."""
    present = F.lit("")
    return {
        ALL: present,
        STORE: store_label(F.col("location"), strict_store),
        LOCATION: F.col("location").cast("string"),
        HOUR: two_digits(F.col("hour")),
        WEEKDAY: weekday_label(F.col("day")),
        CHANNEL: F.when(F.col("preferred"), PREFERRED_CHANNEL).otherwise(OTHER_CHANNEL),
        FAMILY: F.col("family"),
        SUBFAMILY: F.col("subfamily"),
        GROUP: F.col("group"),
        DEPARTMENT: F.col("department"),
        RENT: F.when(F.col("rented"), present),
        INVOICED: F.when(F.col("invoiced"), present),
        ITEM: F.col("item_id"),
    }


def basket_key() -> Column:
    """The transaction, or a hash of the line where a part of its key is missing.

    Lines without a transaction count for no transaction, so where they go is free:
    the hash keeps them from gathering in one partition.
    """
    line = F.xxhash64(
        "item_id",
        "st_extended_net_amt",
        "unit_cnt",
        "sales_return_dt",
        "sales_return_document_num",
        "location_id",
        "transaction_dttm",
    )
    return F.coalesce(F.col("trx_key"), F.concat(F.lit("?"), line.cast("string")))


def _once_per_basket(
    dealt: DataFrame, keys: Sequence[str], tasks: int | None = None
) -> DataFrame:
    """Sums per key. ``dealt`` is partitioned by customer and basket: no shuffle for baskets.

    With ``tasks`` it is partitioned by customer and ``share``, and the sums of a share, made
    before the second shuffle, are dealt to as many tasks.
    """
    share = [] if tasks is None else ["share"]
    per_basket = dealt.groupBy(*keys, *share, "basket").agg(
        F.bool_or("counted").alias("counted"),
        F.sum("units").alias("units"),
        F.sum("amount").alias("amount"),
        F.max("day").alias("day"),
    )
    sums = per_basket.groupBy(*keys, *share).agg(
        F.count_if("counted").alias("transactions"),
        F.sum("units").alias("units"),
        F.sum("amount").alias("amount"),
        F.max("day").alias("last_day"),
    )
    if tasks is None:
        return sums
    units, amount = (sums.schema[name].dataType for name in ("units", "amount"))
    return (
        spread(sums.drop("share"), tasks, *keys)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum("transactions"), F.lit(0)).alias("transactions"),
            F.sum("units").cast(units).alias("units"),
            F.sum("amount").cast(amount).alias("amount"),
            F.max("last_day").alias("last_day"),
        )
    )


def _narrow(lines: DataFrame, *columns: str | Column, tasks: int | None = None) -> DataFrame:
    """What the counts need of each line, spread by customer and basket.

    With ``tasks`` baskets are told apart by ``share``, one of as many, which the sums of a
    customer can be made by before they move on.
    """
    narrow = lines.select(
        *columns,
        basket_key().alias("basket"),
        F.col("trx_key").isNotNull().alias("counted"),
        F.col("unit_cnt").alias("units"),
        F.col("st_extended_net_amt").alias("amount"),
        F.col("sales_return_dt").alias("day"),
    )
    if tasks is None:
        return spread(narrow, tasks, "customer_id", "basket")
    share = F.pmod(F.xxhash64("basket"), F.lit(tasks)).cast("int")
    return spread(narrow.withColumn("share", share), tasks, "customer_id", "share")


def count_transactions(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct transactions, units, amount and last day for each key; one key is the customer."""
    return _once_per_basket(_narrow(lines, *keys), keys)


# Kinds whose units, amounts or last days are read; the others carry NULL, which is
# neither added up nor shuffled as a number.
WITH_UNITS = (ALL, FAMILY, SUBFAMILY, GROUP)
WITH_AMOUNT = (ALL, CREDITED)
WITH_DAY = (ALL,)


def label_measures(
    lines: DataFrame,
    carried: Mapping[str, Column],
    labels: Mapping[str, Column],
    monthly: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Measures of each customer by (``kind``, ``label``), all kinds in one pass.

    ``carried`` are columns taken from the lines, ``labels`` maps a kind to the label
    made from them. The kind ``item`` also carries the item's key in ``item``.
    Credit notes only count as such. With ``monthly`` there is a row for each ``month``
    (YYYYMM): a transaction has one day, so the rows of several months add up.
    """
    with_item = ITEM in labels
    narrow = _narrow(
        lines,
        "customer_id",
        (F.col("sales_return_type_cd") == CREDIT_NOTE).alias("credited"),
        *[column.alias(name) for name, column in carried.items()],
        *([F.col("item_key").alias("own_item")] if with_item else []),
        tasks=tasks,
    )

    def only(kind: str, kinds: Sequence[str], column: str) -> Column:
        value = F.col(column)
        return value if kind in kinds else F.lit(None).cast(narrow.schema[column].dataType)

    def entry(kind: str, label: Column) -> Column:
        fields = [
            F.lit(kind).alias("kind"),
            label.alias("label"),
            only(kind, WITH_UNITS, "units").alias("units"),
            only(kind, WITH_AMOUNT, "amount").alias("amount"),
            only(kind, WITH_DAY, "day").alias("day"),
        ]
        if with_item:
            fields.append(only(kind, (ITEM,), "own_item").alias("item"))
        return F.struct(*fields)

    of_sale = F.array(*[entry(kind, label) for kind, label in labels.items()])
    of_credit = F.array(entry(CREDITED, F.lit("").cast("string")))
    entries = F.when(F.col("credited"), of_credit).otherwise(of_sale)
    month = (F.year("day") * 100 + F.month("day")).alias("month")
    by = [month] if monthly else []
    share = [] if tasks is None else ["share"]
    rows = narrow.select(
        "customer_id", *by, *share, "basket", "counted", F.inline_outer(entries)
    ).filter(F.col("label").isNotNull())
    keys = ["customer_id", *(["month"] if monthly else []), "kind", "label"]
    return _once_per_basket(rows, keys + (["item"] if with_item else []), tasks)


MEASURE_COLUMNS = ("transactions", "units", "amount", "last_day")


def with_members(measured: DataFrame, tasks: int | None = None) -> DataFrame:
    """The shape of ``customer_measures`` for measures without items."""
    return spread(measured, tasks, "customer_id").withColumns(
        {"members": F.lit(0).cast("long"), "whole": F.lit(None).cast("long")}
    )


def _chosen(kinds: Sequence[str] | None, strict_store: bool) -> dict[str, Column]:
    labels = standard_labels(strict_store)
    return {k: v for k, v in labels.items() if kinds is None or k in kinds}


def customer_measures(
    lines: DataFrame,
    items: DataFrame,
    kinds: Sequence[str] | None = None,
    strict_store: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Measures of each customer, partitioned by customer. ``items`` is the catalog of the lines.

    ``tasks`` is the number of tasks that lines and then customers are dealt to.
    """
    chosen = _chosen(kinds, strict_store)
    carried = {k: v() for k, v in CARRIED.items()}
    measured = label_measures(lines, carried, chosen, tasks=tasks)
    if ITEM in chosen:
        return over_items(measured, items, tasks)
    return with_members(measured, tasks)


def month_measures(lines: DataFrame, strict_store: bool = False) -> DataFrame:
    """State of all kinds by customer and month, to be kept and added up by ``merged_measures``."""
    carried = {k: v() for k, v in CARRIED.items()}
    return label_measures(lines, carried, _chosen(None, strict_store), monthly=True)


def merged_measures(months: DataFrame, items: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """``customer_measures`` of the kinds, from the rows that some months left."""
    # What an item adds to distinct counts is told apart behind the shuffle, so months just add up.
    return over_items(months.filter(F.col("kind").isin(*kinds)).drop("month"), items)


def _with_codes(measured: DataFrame, items: DataFrame) -> DataFrame:
    """Rows with the codes of their item as ``codes``; one for each catalog row of its key.

    Rows of other kinds match nothing; their own hash keeps them from gathering under one key.
    """
    codes = items.select(
        F.col("item_key").alias("own_key"),
        F.lit(ITEM).alias("own_kind"),
        F.struct(*ITEM_COLUMNS).alias("codes"),
    )
    key = F.when(F.col("kind") == ITEM, F.col("item")).otherwise(F.xxhash64("customer_id", "label"))
    same = (F.col("key") == F.col("own_key")) & (F.col("kind") == F.col("own_kind"))
    return measured.withColumn("key", key).join(codes, same, "left").drop("key", "own_key", "own_kind")


def over_items(measured: DataFrame, items: DataFrame, tasks: int | None = None) -> DataFrame:
    """Turn rows of the kind ``item`` into the distinct counts taken over items.

    Their number goes to ``members``; rows of the other kinds are added up by label. A customer
    has at most one row for each item and label (and month), so working on whole customers from
    here on is bounded by the catalog.
    """
    item, raw_id = F.col("codes"), F.col("label")

    def entry(kind: Column, label: Column, part: Column, whole: Column | None = None) -> Column:
        whole = F.lit(None).cast("long") if whole is None else whole
        return F.struct(
            kind.alias("kind"), label.alias("label"), part.alias("part"), whole.alias("whole")
        )

    nothing, no_part = F.lit(""), F.lit(None).cast("string")
    of_item = F.array(
        entry(F.lit(SKUS), item["subfamily"], raw_id),
        entry(F.lit(ITEMS), nothing, raw_id),
        entry(F.lit(SETS), nothing, item["hier_set_cd"]),
        entry(F.lit(DEPARTMENTS_SEEN), nothing, item["hier_department_cd"]),
        entry(
            F.lit(SUBFAMILIES),
            F.when(item["subfamily"].isNotNull(), item["family"]),
            item["subfamily"],
            item["family_subfamilies"],
        ),
        entry(F.lit(MAIN_SKU), F.when(item["is_main_sku"], item["catalog_item_id"]), nothing),
    )
    as_is = F.array(entry(F.col("kind"), F.col("label"), no_part))
    entries = F.when(F.col("kind") == ITEM, of_item).otherwise(as_is)
    rows = (
        spread(_with_codes(measured, items), tasks, "customer_id")
        .withColumn("entries", entries)
        .select("customer_id", *MEASURE_COLUMNS, F.inline_outer("entries"))
        .filter(F.col("label").isNotNull())
    )
    distinct_parts = rows.groupBy("customer_id", "kind", "label", "part").agg(
        F.sum("transactions").alias("transactions"),
        F.sum("units").alias("units"),
        F.sum("amount").alias("amount"),
        F.max("last_day").alias("last_day"),
        F.max("whole").alias("whole"),
    )
    return distinct_parts.groupBy("customer_id", "kind", "label").agg(
        F.sum("transactions").alias("transactions"),
        F.sum("units").alias("units"),
        F.sum("amount").alias("amount"),
        F.max("last_day").alias("last_day"),
        F.count("part").alias("members"),
        F.max("whole").alias("whole"),
    )
