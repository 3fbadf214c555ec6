"""Bronze to silver: full names, priced sales by month, everything else as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession

from stratamart.model import (
    CATEGORIES,
    CITIES,
    COUNTRIES,
    CUSTOMERS,
    PRODUCTS,
    SALES,
    SALES_PARTITIONS,
    SELLERS,
    Lake,
)
from stratamart.operators.pricing import conform_sales
from stratamart.operators.shaping import merge_names
from stratamart.sinks.staged import forget_loads
from stratamart.sinks.tables import overwrite, overwrite_partitioned
from stratamart.sources.tables import scan_table

PERSONS = {CUSTOMERS: "ClienteID", SELLERS: "VendedorID"}
UNCHANGED = (PRODUCTS, CATEGORIES, CITIES, COUNTRIES)


def build(spark: SparkSession, lake: Lake) -> None:
    """Replace every silver table."""
    build_dimensions(spark, lake)
    build_sales(spark, lake)


def build_dimensions(spark: SparkSession, lake: Lake) -> None:
    for table, key in PERSONS.items():
        persons = scan_table(spark, lake.table("bronze", table), lake.fmt)
        overwrite(merge_names(persons, key), lake.table("silver", table), lake.fmt)
    for table in UNCHANGED:
        overwrite(scan_table(spark, lake.table("bronze", table), lake.fmt), lake.table("silver", table), lake.fmt)


def build_sales(spark: SparkSession, lake: Lake) -> None:
    forget_loads(spark, lake.table("silver", SALES))
    sales = scan_table(spark, lake.table("bronze", SALES), lake.fmt)
    products = scan_table(spark, lake.table("bronze", PRODUCTS), lake.fmt)
    overwrite_partitioned(conform_sales(sales, products), lake.table("silver", SALES), SALES_PARTITIONS, lake.fmt)
