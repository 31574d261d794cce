"""Input tables by logical name."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# The columns each input must have.
REQUIRED_COLUMNS = {
    "sales": (
        "country_id",
        "business_unit_id",
        "customer_id",
        "main_customer_id",
        "item_id",
        "sales_return_dt",
        "sales_return_type_cd",
        "sales_return_document_num",
        "location_id",
        "transaction_dttm",
        "business_area_sales_flg",
        "sub_channel_level1_sales_flg",
        "st_extended_net_amt",
        "unit_cnt",
    ),
    "items": (
        "country_id",
        "business_unit_id",
        "item_id",
        "hier_department_cd",
        "hier_family_cd",
        "hier_subfamily_cd",
        "hier_group_cd",
        "hier_set_cd",
    ),
    "exclusions": ("country_id", "customer_id"),
    "companies": ("country_id", "customer_id"),
    "main_skus": ("country_id", "item_id"),
    "main_customers": ("country_id", "customer_id"),
    "sii_data": ("country_id", "customer_id", "tramo_ventas"),
}
OPTIONAL_TABLES = ("companies",)
#: Sale lines of all times for each task that counts those of the window and holds their customers.
LINES_PER_TASK = 600_000


@dataclass(frozen=True)
class Sources:
    """The inputs of a run. Without ``companies`` the invoice cohort is derived from sales.

    ``counted`` is a table with as many rows as ``sales`` or more, where those are no plain table
    and counting them takes longer.
    """

    sales: DataFrame
    items: DataFrame
    exclusions: DataFrame
    main_skus: DataFrame
    main_customers: DataFrame
    sii_data: DataFrame
    companies: DataFrame | None = None
    counted: DataFrame | None = None

    def __post_init__(self) -> None:
        for name, columns in REQUIRED_COLUMNS.items():
            table = getattr(self, name)
            if table is None:
                if name not in OPTIONAL_TABLES:
                    raise ValueError(f"input table {name} is required")
                continue
            missing = [c for c in columns if c not in table.columns]
            if missing:
                raise ValueError(f"input table {name} lacks columns {missing}")

    @classmethod
    def from_parquet(cls, spark: SparkSession, paths: Mapping[str, str]) -> Sources:
        return cls(**{name: spark.read.parquet(path) for name, path in paths.items()})

    @classmethod
    def from_catalog(cls, spark: SparkSession, tables: Mapping[str, str]) -> Sources:
        return cls(**{name: spark.table(table) for name, table in tables.items()})

    def named(self) -> dict[str, DataFrame]:
        tables = {name: getattr(self, name) for name in REQUIRED_COLUMNS}
        return {name: table for name, table in tables.items() if table is not None}
