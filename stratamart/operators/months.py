"""Choosing calendar months, the storage partitions of sales tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.model import MONTH, SALES_PARTITIONS, YEAR


def differing_months(left: DataFrame, right: DataFrame) -> tuple[list[tuple], list[tuple]]:
    """Months whose rows differ between two tables, and those that only the second has.

    Rows are compared as a multiset, whatever their order, by their count and the sum of their hashes
    over the columns of ``left``, combined per task before the shuffle. Both lists are bounded by the calendar.
    """
    columns = [c for c in left.columns if c not in SALES_PARTITIONS]
    # A hash passes over nulls, so which values are null is hashed too.
    row = F.xxhash64(*columns, *(F.col(c).isNull() for c in columns)).cast("decimal(38,0)")

    def digest(table: DataFrame, side: str) -> DataFrame:
        return table.groupBy(*SALES_PARTITIONS).agg(F.struct(F.count("*"), F.sum(row)).alias(side))

    year, month = (F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in SALES_PARTITIONS)
    both = digest(left, "mine").alias("l").join(digest(right, "theirs").alias("r"), year & month, "full_outer")
    rows = both.where("NOT mine <=> theirs").select(
        F.col("mine").isNotNull().alias("held"), *(F.coalesce(f"l.{c}", f"r.{c}").alias(c) for c in SALES_PARTITIONS)
    )
    found = rows.collect()
    return [(r[YEAR], r[MONTH]) for r in found if r.held], [(r[YEAR], r[MONTH]) for r in found if not r.held]


def in_months(table: DataFrame, months: list[tuple]) -> DataFrame:
    """All rows of the given months; compared to literals, so other folders are not read."""
    chosen = F.lit(False)
    for year, month in months:
        chosen = chosen | (F.col(YEAR).eqNullSafe(F.lit(year)) & F.col(MONTH).eqNullSafe(F.lit(month)))
    return table.filter(chosen)
