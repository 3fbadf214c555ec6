"""Incremental sales loads: batches to bronze, their new rows to silver, touched months to gold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.model import PRODUCTS, SALES, SALES_PARTITION_TYPES, SALES_PARTITIONS, Lake
from stratamart.operators.audit import load_audit
from stratamart.operators.pricing import conform_sales
from stratamart.operators.shaping import stack
from stratamart.operators.watermark import newer_than, read_watermark
from stratamart.plans.bronze import ingest_sales_batches
from stratamart.plans.gold import refresh_sales
from stratamart.sinks.staged import append_staged, finish_loads
from stratamart.sinks.tables import append_partitioned
from stratamart.sources.tables import scan_table, scan_table_if_present

# Formats of plain files, whose appends a dead driver can leave half done.
UNLOGGED = ("parquet", "orc", "json", "csv", "avro")


def load_sales(
    spark: SparkSession, lake: Lake, batches: Sequence[str], infer: bool = False, mode: str = "PERMISSIVE"
) -> DataFrame:
    """Take batch files from the landing zone through bronze into silver; returns the audit."""
    ingest_sales_batches(spark, lake, batches, infer, mode)
    return append_sales(spark, lake, batches)


def append_sales(spark: SparkSession, lake: Lake, batches: Sequence[str]) -> DataFrame:
    """Append to silver the rows of the bronze batches that are newer than all it holds.

    Returns an audit row per batch. A load that broke off before is finished first: its rows count in the
    mark only together. The mark is read once, before the write, so that audit and appended rows agree. Batches are
    read back from bronze, where the mark is pushed into the scan. Without a silver table everything
    is loaded. Table formats that append in one step take the rows without staging.
    """
    target = lake.table("silver", SALES)
    staged = lake.fmt in UNLOGGED
    if staged:
        finish_loads(spark, target)
    held = scan_table_if_present(spark, target, lake.fmt, SALES_PARTITION_TYPES)
    mark = read_watermark(held)
    arrived = stack(
        *(scan_table(spark, lake.table("bronze", b), lake.fmt).withColumn("lote", F.lit(b)) for b in batches)
    )
    products = scan_table(spark, lake.table("bronze", PRODUCTS), lake.fmt)
    rows = conform_sales(newer_than(arrived, mark), products)
    schema = held.schema if held is not None else None
    if staged:
        append_staged(rows, target, SALES_PARTITIONS, lake.fmt, schema, {"lotes": list(batches), "marca": mark})
    else:
        append_partitioned(rows, target, SALES_PARTITIONS, lake.fmt, target=schema)
    return load_audit(arrived, mark)


def load_sales_and_refresh(
    spark: SparkSession, lake: Lake, batches: Sequence[str], infer: bool = False, mode: str = "PERMISSIVE"
) -> DataFrame:
    """An incremental load followed by the refresh of the gold months that changed."""
    audit = load_sales(spark, lake, batches, infer, mode)
    refresh_sales(spark, lake)
    return audit
