"""Hand-written inputs: a few rows per rule."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from decimal import Decimal

from pyspark.sql import SparkSession

from clientela.config import RunConfig
from clientela.sources.tables import Sources

CFG = replace(RunConfig(), period=200101, history_from="1995-06-01")

SALES_SCHEMA = (
    "country_id string, business_unit_id string, customer_id string, main_customer_id string, "
    "item_id string, sales_return_dt date, sales_return_type_cd string, "
    "sales_return_document_num long, location_id long, transaction_dttm string, "
    "business_area_sales_flg string, sub_channel_level1_sales_flg string, "
    "st_extended_net_amt decimal(18,2), unit_cnt decimal(18,2)"
)
ITEM_SCHEMA = (
    "country_id string, business_unit_id string, item_id string, hier_department_cd string, "
    "hier_family_cd string, hier_subfamily_cd string, hier_group_cd string, hier_set_cd string"
)
ITEMS = [
    ("CL", "ENT", "12", "1", "0601", " 0601-A ", "G1", "S1"),
    ("CL", "ENT", "0012", "1", "0601", " 0601-A ", "G1", "S2"),
    ("CL", "ENT", "13", "2", "0626", "0626-B", "G2", "S1"),
    ("CL", "ENT", "14", " 2 ", "0601", "0601-C", "G2", None),
    ("CL", "ENT", "X15", "3", "0601", "0601-Z", "G9", "S9"),
    ("CO", "ENT", "13", "9", "0609", "0609-Q", "G8", "S8"),
]


def sale(customer, item="13", day="2000-06-15", kind="blta", doc=1, loc=5, amt="10", units="1", **more):
    row = {
        "country_id": "CL",
        "business_unit_id": "ENT",
        "main_customer_id": "999",
        "dttm": f"{day} 10:30:00",
        "area": "ST",
        "channel": None,
        **more,
    }
    return (
        row["country_id"],
        row["business_unit_id"],
        customer,
        row["main_customer_id"],
        item,
        date.fromisoformat(day),
        kind,
        doc,
        loc,
        row["dttm"],
        row["area"],
        row["channel"],
        Decimal(amt),
        Decimal(units),
    )


def sources(
    spark: SparkSession,
    sales,
    exclusions=(),
    register=(),
    loyalty=(),
    skus=(),
    companies=None,
) -> Sources:
    ids = "country_id string, customer_id string"

    def listed(values):
        return spark.createDataFrame([("CL", v) for v in values], ids)

    return Sources(
        sales=spark.createDataFrame(list(sales), SALES_SCHEMA),
        items=spark.createDataFrame(ITEMS, ITEM_SCHEMA),
        exclusions=listed(exclusions),
        main_skus=spark.createDataFrame([("CL", v) for v in skus], "country_id string, item_id string"),
        main_customers=listed(loyalty),
        sii_data=spark.createDataFrame(
            [("CL", c, t) for c, t in register], f"{ids}, tramo_ventas int"
        ),
        companies=None if companies is None else listed(companies),
    )


def ids(df) -> list:
    return sorted((row.customer_id for row in df.select("customer_id").collect()), key=str)
