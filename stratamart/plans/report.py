"""Reports on the stored tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.model import DIMENSIONS, SALES, SALES_PARTITIONS, Dimension, Lake
from stratamart.operators.history_check import all_history_faults
from stratamart.operators.quality import quality_report
from stratamart.sources.tables import scan_table


def sales_by_month(sales: DataFrame) -> DataFrame:
    """Per month: sales, sum of their totals, and how many have no price."""
    return sales.groupBy(*SALES_PARTITIONS).agg(
        F.count("*").alias("vendas"),
        F.sum("PrecoTotal").alias("total"),
        F.count_if(F.col("PrecoTotal").isNull()).alias("sem_preco"),
    )


def gold_history(
    spark: SparkSession, lake: Lake, dimensions: Iterable[Dimension] = tuple(DIMENSIONS.values())
) -> DataFrame:
    """Faults in the histories of the gold dimensions."""
    return all_history_faults([(spec, scan_table(spark, lake.table("gold", spec.table), lake.fmt)) for spec in dimensions])


def silver_quality(
    spark: SparkSession, lake: Lake, dimensions: Iterable[Dimension] = tuple(DIMENSIONS.values())
) -> DataFrame:
    """The quality report on silver: the sales table against the tables its keys point to."""
    parents = {d.key: (d.table, scan_table(spark, lake.table("silver", d.table), lake.fmt)) for d in dimensions}
    return quality_report(scan_table(spark, lake.table("silver", SALES), lake.fmt), SALES, parents)
