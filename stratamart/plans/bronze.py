"""Landing zone to bronze: CSV files to stored tables, no value changed or lost unseen.

Declared types are used unless ``infer`` asks for all types to be taken from the data. With ``mode`` FAILFAST a
line that does not have its declared types ends the load. Otherwise its bad values become
null, and the line is kept as read in a column of its own, which loads count in their audit.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from stratamart.model import DECLARED, LANDING_FILES, SALES, UNREADABLE, Lake
from stratamart.sinks.tables import overwrite
from stratamart.sources.landing import scan_csv
from stratamart.sources.merged import scan_merged
from stratamart.sources.tables import scan_table_if_present


def ingest(
    spark: SparkSession,
    lake: Lake,
    tables: Iterable[str] = tuple(LANDING_FILES),
    infer: bool = False,
    mode: str = "PERMISSIVE",
) -> None:
    """Replace the bronze copy of each table by its landing file."""
    for table in tables:
        _copy(spark, lake, table, None if infer else DECLARED[table], table != SALES, mode)


def ingest_sales_batches(
    spark: SparkSession, lake: Lake, batches: Iterable[str], infer: bool = False, mode: str = "PERMISSIVE"
) -> None:
    """Replace the bronze copy of each batch, a sales file of its own beside the first one.

    Types that are taken from the data are those that hold the values of all batches, and of the first file's table
    if it is there, so that batches that look different are stored alike.
    """
    batches = list(batches)
    if infer and batches:
        first = scan_table_if_present(spark, lake.table("bronze", SALES), lake.fmt)
        known = None if first is None else first.drop(UNREADABLE).schema
        files, _ = scan_merged(spark, [lake.landing_file(b) for b in batches], known)
        for batch, rows in zip(batches, files, strict=True):
            overwrite(rows, lake.table("bronze", batch), lake.fmt)
        return
    for batch in batches:
        _copy(spark, lake, batch, DECLARED[SALES], False, mode)


def _copy(spark: SparkSession, lake: Lake, table: str, declared: T.StructType | None, infer_rest: bool, mode: str) -> None:
    # Only sales carry the column on; other tables are small enough to be loaded with FAILFAST.
    kept = UNREADABLE if declared is DECLARED[SALES] and mode == "PERMISSIVE" else None
    rows = scan_csv(spark, lake.landing_file(table), declared, infer_rest=infer_rest, mode=mode, unreadable=kept)
    overwrite(rows, lake.table("bronze", table), lake.fmt)
