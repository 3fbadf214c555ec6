"""Stored tables, addressed by path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Error conditions Spark raises when there is no table at a path yet.
_ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_PATH_DOES_NOT_EXIST"}


def scan_table(
    spark: SparkSession, path: str, fmt: str = "parquet", partitions: Mapping[str, T.DataType] | None = None
) -> DataFrame:
    """The table at ``path``; ``partitions`` are types of columns that may be stored as null alone.

    Types of storage partitions are taken from folder names, and a folder for nulls has none to give.
    """
    table = spark.read.format(fmt).load(path)
    untyped = {f.name for f in table.schema.fields if isinstance(f.dataType, T.NullType)}
    known = {c: kind for c, kind in (partitions or {}).items() if c in untyped}
    return table.withColumns({c: F.col(c).cast(kind) for c, kind in known.items()}) if known else table


def scan_table_if_present(
    spark: SparkSession, path: str, fmt: str = "parquet", partitions: Mapping[str, T.DataType] | None = None
) -> DataFrame | None:
    """The table at ``path``, or None where nothing was written yet.

    Any other failure is raised: taking an unreadable table for a missing one would load
    everything a second time.
    """
    try:
        return scan_table(spark, path, fmt, partitions)
    except AnalysisException as failure:
        if failure.getCondition() in _ABSENT:
            return None
        raise


def scan_partition(spark: SparkSession, path: str, fmt: str = "parquet", **values: object) -> DataFrame:
    """Rows of the storage partitions with the given column values.

    Filters the whole table instead of reading a partition's folder: only the matching folders
    are read all the same, and the partition columns stay in the result.
    """
    table = scan_table(spark, path, fmt)
    for column, value in values.items():
        table = table.filter(F.col(column).eqNullSafe(F.lit(value)))
    return table
