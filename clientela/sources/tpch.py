"""The input tables, derived from TPC-H style tables.

Lets every operator run on a public star schema. Each rule below puts one data
quality case of real sales data into the derived rows: padded and missing ids,
item codes that are no numbers, unreadable timestamps, credit notes.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clientela.config import RunConfig
from clientela.functions.storage import spread, tasks_of
from clientela.sources.tables import LINES_PER_TASK, Sources

TPCH_RUN = replace(RunConfig(), period=200101, history_from="1995-06-01")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _lines_and_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their order, joined in as many tasks as the lines ask for."""
    lines = _table(spark, folder, "lineitem")
    orders = _table(spark, folder, "orders")
    tasks = tasks_of(spark, lines.count(), LINES_PER_TASK)
    if tasks is not None:
        lines, orders = spread(lines, tasks, "l_orderkey"), spread(orders, tasks, "o_orderkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def sales(spark: SparkSession, folder: str) -> DataFrame:
    order, customer, part = F.col("o_orderkey"), F.col("o_custkey"), F.col("l_partkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    is_return = (status == "P") & (priority == "5-LOW")
    is_invoice = (customer % 4 == 0) & (status == "F")

    def returned(amount: Column) -> Column:
        negated = F.when(is_return & ~is_invoice, -amount).otherwise(amount)
        return negated.cast("decimal(18,2)")

    net_share = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    net = F.round(F.col("l_extendedprice").cast("decimal(18,2)") * net_share, 2)
    moment = F.col("o_orderdate") + F.make_interval(hours=(order % 24).cast("int"))
    return _lines_and_orders(spark, folder).select(
        F.when(F.col("l_suppkey") % 10 == 0, "CO").otherwise("CL").alias("country_id"),
        F.when(F.col("l_suppkey") % 17 == 0, "OTH").otherwise("ENT").alias("business_unit_id"),
        F.when(order % 19 == 0, "0")
        .when(order % 23 == 0, F.lit(None))
        .otherwise(F.concat(F.lit(" "), customer.cast("string"), F.lit(" ")))
        .alias("customer_id"),
        customer.cast("string").alias("main_customer_id"),
        F.when(part % 211 == 0, F.concat(F.lit("X"), part.cast("string")))
        .otherwise(F.lpad(part.cast("string"), 8, "0"))
        .alias("item_id"),
        F.to_date("o_orderdate").alias("sales_return_dt"),
        F.when(is_invoice, "fctr")
        .when(is_return, "ntcr")
        .otherwise("blta")
        .alias("sales_return_type_cd"),
        order.alias("sales_return_document_num"),
        (order % 25).alias("location_id"),
        F.when(order % 31 == 0, "bad").otherwise(moment.cast("string")).alias("transaction_dttm"),
        F.when((customer % 11 == 0) & (priority == "1-URGENT"), "VE")
        .otherwise("ST")
        .alias("business_area_sales_flg"),
        F.when(priority == "2-HIGH", " SR ")
        .when(priority == "3-MEDIUM", F.lit(None))
        .otherwise("XX")
        .alias("sub_channel_level1_sales_flg"),
        returned(net).alias("st_extended_net_amt"),
        returned(F.col("l_quantity").cast("decimal(18,2)")).alias("unit_cnt"),
    )


# Family code per part type.
FAMILY_BY_TYPE = {
    "ECONOMY": "0626",
    "LARGE": "0601",
    "MEDIUM": "0602",
    "PROMO": "0603",
    "SMALL": "0604",
    "STANDARD": "0605",
}


def items(spark: SparkSession, folder: str) -> DataFrame:
    part = _table(spark, folder, "part")
    codes = F.create_map(*[F.lit(x) for pair in FAMILY_BY_TYPE.items() for x in pair])
    family = codes[F.col("p_type")]
    return part.select(
        F.explode(F.array(F.lit("CL"), F.lit("CO"))).alias("country_id"),
        F.lit("ENT").alias("business_unit_id"),
        F.col("p_partkey").cast("string").alias("item_id"),
        (F.col("p_size") % 6).cast("string").alias("hier_department_cd"),
        family.alias("hier_family_cd"),
        F.concat(F.lit(" "), family, F.lit("-"), F.col("p_brand"), F.lit(" ")).alias(
            "hier_subfamily_cd"
        ),
        F.col("p_brand").alias("hier_group_cd"),
        F.col("p_size").cast("string").alias("hier_set_cd"),
    )


def tpch_sources(spark: SparkSession, folder: str, with_companies: bool = False) -> Sources:
    customer = _table(spark, folder, "customer")
    part = _table(spark, folder, "part")
    key = F.col("c_custkey")
    home = F.lit("CL").alias("country_id")
    plain_id = key.cast("string").alias("customer_id")
    companies = customer.filter(F.col("c_mktsegment") == "BUILDING").select(home, plain_id)
    return Sources(
        sales=sales(spark, folder),
        items=items(spark, folder),
        exclusions=customer.filter(key % 97 == 0).select(
            home, F.concat(F.lit(" "), key.cast("string")).alias("customer_id")
        ),
        main_skus=part.filter(F.col("p_partkey") % 29 == 0).select(
            home, F.col("p_partkey").cast("string").alias("item_id")
        ),
        main_customers=customer.filter(key % 53 == 0).select(home, plain_id),
        sii_data=customer.filter(key % 7 == 0).select(
            home, plain_id, (key % 13).cast("int").alias("tramo_ventas")
        ),
        companies=companies if with_companies else None,
        counted=_table(spark, folder, "lineitem"),
    )
