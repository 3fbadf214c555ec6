"""Pricing sale lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.functions.dates import month_of, year_of
from stratamart.functions.money import line_total, unit_price
from stratamart.model import FACT_COLUMNS, MONTH, REGISTERED, SALE_DATE, TRANSACTION, YEAR
from stratamart.operators.broadcasting import broadcast_if_small
from stratamart.operators.validity import intervals, lookup_valid


def price_by_product(sales: DataFrame, products: DataFrame, limit: int | None = None) -> DataFrame:
    """Add ``PrecoUnitario`` from the product, if it was registered on or before the sale date.

    Sales without such a product stay, with a null price. Every product row that qualifies
    yields a row, so products with several price rows call for :func:`price_as_of`.
    """
    p = products.select(
        F.col("ProdutoID").alias("_product"),
        F.col(REGISTERED).alias("_registered"),
        unit_price(F.col("Preco")).alias("PrecoUnitario"),
    )
    known = (F.col("ProdutoID") == F.col("_product")) & (F.col("_registered") <= F.col(SALE_DATE))
    return sales.join(broadcast_if_small(p, limit), known, "left").drop("_product", "_registered")


def price_as_of(sales: DataFrame, prices: DataFrame, limit: int | None = None) -> DataFrame:
    """Add ``PrecoUnitario``: the latest price registered on or before the sale date.

    One row per sale, however many price rows a product has. Of several prices registered on
    one day the highest counts.
    """
    # A price counts from the day it was registered, also where the hour is known.
    day = F.col(REGISTERED).cast("date").alias(REGISTERED)
    history = intervals(
        prices.select("ProdutoID", day, unit_price(F.col("Preco")).alias("PrecoUnitario")),
        "ProdutoID",
        REGISTERED,
        "PrecoUnitario",
    )
    return lookup_valid(
        sales, history, "ProdutoID", SALE_DATE, REGISTERED, "_until", limit, no_more_than=prices
    )


def with_totals(priced: DataFrame) -> DataFrame:
    """Add ``PrecoTotal`` and put the sales columns in their order."""
    total = line_total(F.col("Quantidade"), F.col("PrecoUnitario"), F.col("Desconto"))
    return priced.withColumn("PrecoTotal", total).select(*FACT_COLUMNS)


def with_calendar(sales: DataFrame) -> DataFrame:
    """Add the year and month of the sale, the storage partitions of the table."""
    return sales.withColumns({YEAR: year_of(SALE_DATE), MONTH: month_of(SALE_DATE)})


def conform_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Raw sales to the conformed sales table: priced as of their date, totalled, ordered, with year and month.

    One row per sale, also where a product has several rows.
    """
    return with_calendar(with_totals(price_as_of(sales.drop(TRANSACTION), products)))
