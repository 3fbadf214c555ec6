"""CSV files of the landing zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class LandingFileError(ValueError):
    """A landing file lacks columns its table is declared to have."""


def scan_csv(
    spark: SparkSession,
    path: str,
    declared: T.StructType | None = None,
    delimiter: str = ",",
    infer_rest: bool = True,
    mode: str = "PERMISSIVE",
    unreadable: str | None = None,
) -> DataFrame:
    """Scan a CSV file, or a folder of them, that starts with a header line.

    Declared columns are matched by name, so files may order them differently, and get their
    declared type whatever a batch happens to contain. The types of other columns are inferred,
    which takes a second pass over the file; with ``infer_rest`` off they stay strings, and only
    the header is read ahead. Files of one folder whose headers disagree are refused.

    Short lines are padded with nulls, long ones cut, and a value that does not have its declared
    type is read as null; with ``mode`` FAILFAST such lines are an error. A column named
    ``unreadable`` keeps the whole of such lines, and is null for all others.
    """
    reader = spark.read.option("sep", delimiter).option("header", True).option("mode", mode)
    if declared is None:
        return reader.option("inferSchema", True).csv(path)

    header = reader.csv(path).schema
    missing = sorted(set(declared.names) - set(header.names))
    if missing:
        raise LandingFileError(f"{path} lacks the columns {', '.join(missing)}")
    if infer_rest and set(header.names) - set(declared.names):
        header = reader.option("inferSchema", True).csv(path).schema
    kinds = {f.name: f.dataType for f in declared.fields}
    schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in header.fields])
    if unreadable:
        schema = schema.add(unreadable, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", unreadable)
    return reader.option("inferSchema", False).schema(schema).option("enforceSchema", False).csv(path)
