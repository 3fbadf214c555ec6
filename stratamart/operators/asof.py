"""Prices by the time of day: the last one known at the moment of a sale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.functions.money import unit_price
from stratamart.model import REGISTERED


def price_as_of_time(sales: DataFrame, prices: DataFrame, at: str, hours: int = 24, since: str = REGISTERED) -> DataFrame:
    """Add ``PrecoUnitario``: the last price registered at or before the time of the sale.

    One row per sale. Of several prices registered at one moment the highest counts; sales without a product or a time, and
    those before the first price, have none.

    Prices and sales of a product are put in one order of time, in which the last price is carried on: no sale is ever paired with
    all prices of its product. The order is cut into slices of ``hours`` (a divisor of 24), so that a product with a
    third of all sales is many partitions; each begins with the price that the slices before it hand over, which is
    worked out from one price per product and slice. Sales are shuffled once.
    """
    if 24 % hours:
        raise ValueError("hours must divide a day")

    def slice_of(time: Column) -> Column:
        return (F.datediff(F.to_date(time), F.lit("1970-01-01").cast("date")) * (24 // hours) + F.floor(F.hour(time) / hours)).cast("int")

    kind = sales.schema[at].dataType
    timed = F.col("ProdutoID").isNotNull() & F.col(at).isNotNull()
    sold = sales.filter(timed).select(
        F.col("ProdutoID").alias("_product"), slice_of(F.col(at)).alias("_slice"), F.col(at).alias("_time"), F.struct("*").alias("_row")
    )
    known = (
        prices.filter(F.col("ProdutoID").isNotNull() & F.col(since).isNotNull())
        .groupBy(F.col("ProdutoID").alias("_product"), F.col(since).cast(kind).alias("_time"))
        .agg(F.max(unit_price(F.col("Preco"))).alias("_price"))
        .withColumn("_slice", slice_of(F.col("_time")))
    )
    # One row per product and slice with sales or prices: bounded by the calendar.
    ends = known.groupBy("_product", "_slice").agg(F.max_by("_price", "_time").alias("_last"))
    used = sold.select("_product", "_slice").distinct().withColumn("_last", F.lit(None).cast(known.schema["_price"].dataType))
    ends = ends.unionByName(used).groupBy("_product", "_slice").agg(F.max("_last").alias("_last"))
    before = Window.partitionBy("_product").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select("_product", "_slice", F.last("_last", ignorenulls=True).over(before).alias("_price")).filter("_price IS NOT NULL")

    def event(rows: DataFrame, rank: int, time: Column, price: Column, row: Column) -> DataFrame:
        return rows.select("_product", "_slice", F.lit(rank).alias("_rank"), time.alias("_time"), price.alias("_price"), row.alias("_row"))

    no_row = F.lit(None).cast(sold.schema["_row"].dataType)
    no_price = F.lit(None).cast(known.schema["_price"].dataType)
    events = event(handed, 0, F.lit(None).cast(kind), F.col("_price"), no_row)
    events = events.unionByName(event(known, 1, F.col("_time"), F.col("_price"), no_row))
    events = events.unionByName(event(sold, 2, F.col("_time"), no_price, F.col("_row")))
    order = Window.partitionBy("_product", "_slice").orderBy(F.asc_nulls_first("_time"), "_rank")
    carried = F.last("_price", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    priced = events.withColumn("_price", carried).filter("_rank = 2")
    out = priced.select(*(F.col(f"_row.{c}").alias(c) for c in sales.columns), F.col("_price").alias("PrecoUnitario"))
    return out.unionByName(sales.filter(~timed).withColumn("PrecoUnitario", no_price))
