"""Prices and totals in exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratamart.model import DISCOUNT, PRICE, QUANTITY, TOTAL


def unit_price(price: Column) -> Column:
    """``price`` rounded half up to cents."""
    return F.round(price, 2).cast(PRICE)


def line_total(quantity: Column, price: Column, discount: Column) -> Column:
    """Quantity times unit price less the discount fraction, rounded half up to cents.

    Null when any part is null: a sale without a known price has no total.
    """
    kept = F.lit(1).cast(DISCOUNT) - discount.cast(DISCOUNT)
    return F.round(quantity.cast(QUANTITY) * price.cast(PRICE) * kept, 2).cast(TOTAL)
