"""Sale lines joined to the item catalog: the base every cohort and feature reads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from clientela.config import CREDIT_NOTE, INVOICE, RECEIPT, RunConfig
from clientela.functions.columns import canonical_customer, safe_long, transaction_key
from clientela.functions.storage import broadcast_bytes, tasks_of, written_bytes

SALE_TYPES = (RECEIPT, INVOICE)
#: Rows of the catalog that a task holds as a hash table while sale lines pass.
ITEMS_PER_TASK = 1_000_000


def period_window(period: int, months: int) -> tuple[date, date]:
    """First day (inclusive) and end (exclusive) of the months before a YYYYMM period."""
    year, month = divmod(period, 100)
    end = date(year, month, 1)
    first = year * 12 + (month - 1) - months
    return date(first // 12, first % 12 + 1, 1), end


def is_positive() -> Column:
    return (F.col("st_extended_net_amt") > 0) & (F.col("unit_cnt") > 0)


def in_scope(df: DataFrame, cfg: RunConfig) -> DataFrame:
    """Rows of the run's country and business unit, on bare columns so that it is pushed down."""
    return df.filter(
        (F.col("country_id") == cfg.country) & (F.col("business_unit_id") == cfg.business_unit)
    )


def dated(df: DataFrame, start: date | str, end: date | str) -> DataFrame:
    day = F.col("sales_return_dt")
    return df.filter((day >= F.lit(str(start)).cast("date")) & (day < F.lit(str(end)).cast("date")))


def valid_sales(sales: DataFrame, cfg: RunConfig) -> DataFrame:
    """Receipts and invoices with positive amount and units inside the run's window."""
    start, end = period_window(cfg.period, cfg.months)
    return dated(in_scope(sales, cfg), start, end).filter(
        F.col("sales_return_type_cd").isin(*SALE_TYPES) & is_positive()
    )


def sales_and_credit_notes(sales: DataFrame, cfg: RunConfig) -> DataFrame:
    """The above and the credit notes of the window, whatever their sign, in one scan."""
    start, end = period_window(cfg.period, cfg.months)
    kind = F.col("sales_return_type_cd")
    return dated(in_scope(sales, cfg), start, end).filter(
        (kind == CREDIT_NOTE) | (kind.isin(*SALE_TYPES) & is_positive())
    )


def with_customer(sales: DataFrame) -> DataFrame:
    return sales.withColumn(
        "customer_id", canonical_customer(F.col("customer_id"), F.col("main_customer_id"))
    )


def with_item_key(df: DataFrame) -> DataFrame:
    return df.withColumn("item_key", safe_long(F.col("item_id")))


def with_transaction(sales: DataFrame, cfg: RunConfig) -> DataFrame:
    return sales.withColumn(
        "trx_key",
        transaction_key(
            F.col("country_id"),
            F.col("business_unit_id"),
            F.col("sales_return_dt"),
            F.col("sales_return_type_cd"),
            F.col("sales_return_document_num"),
            F.col("location_id"),
            strict=cfg.strict_trx_key,
        ),
    )


def item_keys(items: DataFrame, cfg: RunConfig) -> DataFrame:
    """Numeric keys of the catalog in scope, for use as a filter."""
    keyed = with_item_key(in_scope(items, cfg))
    return keyed.filter(F.col("item_key").isNotNull()).select("item_key")


def catalog(items: DataFrame, main_skus: DataFrame, cfg: RunConfig) -> DataFrame:
    """Catalog rows in scope with what the features need to know about each item.

    ``is_main_sku`` and ``family_subfamilies`` are worked out here, on the catalog,
    so that no sale line has to be joined for them. Rows with the same numeric key
    are kept: a sale line matches each of them.
    """
    keyed = with_item_key(in_scope(items, cfg)).filter(F.col("item_key").isNotNull())
    codes = keyed.select(
        "item_key",
        F.col("item_id").alias("catalog_item_id"),
        "hier_department_cd",
        "hier_family_cd",
        "hier_subfamily_cd",
        "hier_group_cd",
        "hier_set_cd",
        F.trim("hier_department_cd").alias("department"),
        F.trim("hier_family_cd").alias("family"),
        F.trim("hier_subfamily_cd").alias("subfamily"),
        F.trim("hier_group_cd").alias("group"),
    )
    per_family = codes.groupBy("family").agg(
        F.count_distinct("subfamily").alias("family_subfamilies")
    )
    main = (
        with_item_key(main_skus.filter(F.col("country_id") == cfg.country))
        .select("item_key", F.lit(True).alias("main_sku"))
        .distinct()
    )
    return (
        codes.join(per_family, "family", "left")
        .join(main, "item_key", "left")
        .withColumn("is_main_sku", F.coalesce("main_sku", F.lit(False)))
        .drop("main_sku")
    )


def beside_lines(items: DataFrame, tasks: int | None) -> DataFrame:
    """Written rows of the catalog, for joins with sale lines that ask for ``tasks`` tasks.

    What is too large to be broadcast becomes a hash table in each of the session's partitions,
    which the lines pass. A sort would hold the lines of a partition, and these grow with the
    table. A hash table cannot spill: a catalog that is too large for it is left to the sort.
    """
    spark = items.sparkSession
    if tasks is None or written_bytes(items) <= broadcast_bytes(spark):
        return items
    if tasks_of(spark, items.count(), ITEMS_PER_TASK) is not None:
        return items
    return items.hint("shuffle_hash")


def join_catalog(sales: DataFrame, items: DataFrame) -> DataFrame:
    """Inner join on the numeric item key; a text that is no number matches nothing.

    No broadcast hint: Spark broadcasts the catalog when it is small enough, else it shuffles
    both (see ``beside_lines``), and adaptive execution splits the partitions of best-selling items.
    """
    return with_item_key(sales).join(items, "item_key")


def join_sales_items(sales: DataFrame, items: DataFrame, cfg: RunConfig) -> DataFrame:
    """Sale lines of the scope with the hierarchy codes of their item."""
    codes = with_item_key(in_scope(items, cfg)).drop("country_id", "business_unit_id")
    return join_catalog(
        in_scope(sales, cfg), codes.withColumnRenamed("item_id", "catalog_item_id")
    )
