"""High-water marks: what a table already holds, and which rows are newer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.functions.dates import day_literal
from stratamart.model import MONTH, SALE_DATE, SALES_PARTITIONS, YEAR


def high_watermark(table: DataFrame, column: str = SALE_DATE) -> DataFrame:
    """One row with the greatest value of ``column``, null for a table without any.

    For the sale date, looks only into the newest month of a table that carries its year and
    month as columns. Finding that month takes no column data when they are storage partitions.
    """
    if column == SALE_DATE and set(SALES_PARTITIONS) <= set(table.columns):
        month = F.col(YEAR) * 12 + F.col(MONTH)
        table = table.filter(month == table.agg(F.max(month)).scalar())
    return table.agg(F.max(column).alias(column))


def read_watermark(table: DataFrame | None, column: str = SALE_DATE) -> date | None:
    """The high-water mark as a value; None for an absent or empty table.

    A table with undated rows alone has the earliest date as its mark, so that a load that is repeated
    adds dated rows, of which it has none, and not the undated ones again.
    """
    if table is None:
        return None
    mark = high_watermark(table, column).first()[0]
    return date.min if mark is None and not table.isEmpty() else mark


def newer_than(rows: DataFrame, mark: date | None, column: str = SALE_DATE) -> DataFrame:
    """Rows strictly newer than the mark; all rows while there is no mark.

    As a literal the mark reaches the scan as a pushed filter. Rows dated on or before it, or
    not dated, are left out for good, so a load that is repeated adds nothing.
    """
    return rows if mark is None else rows.filter(F.col(column) > day_literal(mark))
