"""CSV files whose values look different from file to file, read with one type per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a value looks like, a bit each. Types join upwards: whole numbers of growing width, then fractions; days, then
# moments; anything else together is text.
_BOOLEAN, _INT, _LONG, _WIDE, _DOUBLE, _DATE, _MOMENT, _TEXT = (1 << k for k in range(8))
_KINDS = {
    _BOOLEAN: T.BooleanType(),
    _INT: T.IntegerType(),
    _LONG: T.LongType(),
    _WIDE: T.DecimalType(38, 0),
    _DOUBLE: T.DoubleType(),
    _DATE: T.DateType(),
    _MOMENT: T.TimestampNTZType(),
    _TEXT: T.StringType(),
}
_CHAINS = ((_INT, _LONG, _WIDE, _DOUBLE), (_DATE, _MOMENT), (_BOOLEAN,))


def _looks(value: Column) -> Column:
    """The bit of the narrowest type that holds a value as written; null for no value."""
    whole, day = value.rlike(r"^[+-]?\d+$"), value.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    number = value.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    moment = value.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,6})?)?$")
    return (
        F.when(value.isNull(), None)
        .when(whole & value.try_cast("int").isNotNull(), _INT)
        .when(whole & value.try_cast("bigint").isNotNull(), _LONG)
        .when(whole & value.try_cast("decimal(38,0)").isNotNull(), _WIDE)
        .when(number & ~whole, _DOUBLE)
        .when(day & value.try_cast("date").isNotNull(), _DATE)
        .when(moment & value.try_cast("timestamp_ntz").isNotNull(), _MOMENT)
        .when(F.lower(value).isin("true", "false"), _BOOLEAN)
        .otherwise(_TEXT)
    )


def joined_type(looks: int) -> T.DataType | None:
    """The narrowest type that holds all values seen, given by their bits; None where there were none."""
    for chain in _CHAINS:
        if looks and not looks & ~sum(chain):
            return _KINDS[max(bit for bit in chain if looks & bit)]
    return T.StringType() if looks else None


def widened(known: T.DataType, looks: int) -> T.DataType:
    """The type that holds both a column of ``known`` type and the values seen; text where no number or date does."""
    bits = [bit for bit, kind in _KINDS.items() if kind == known]
    if not looks:
        return known
    if bits:
        return joined_type(looks | bits[0])
    whole = looks & ~(_INT | _LONG) == 0
    if isinstance(known, T.DecimalType) and whole and known.precision - known.scale >= 19:
        return known
    return T.DoubleType() if isinstance(known, T.DecimalType) and not looks & ~sum(_CHAINS[0]) else T.StringType()


def scan_merged(
    spark: SparkSession, paths: Sequence[str], known: T.StructType | None = None, delimiter: str = ","
) -> tuple[list[DataFrame], T.StructType]:
    """The files of each path with the types that hold the values of all, and the schema they share.

    Columns are matched by name; one that a file lacks is null for it. Types come from one aggregation over all values
    of all files, a bit per column and kind, so no file decides for the others and their order does not matter. ``known``,
    the schema of a table that holds earlier files, is widened by what was seen: what the table holds fits the
    result, and so do the files. A column without a value in any file keeps its known type, else it is text.
    """
    reader = spark.read.option("header", True).option("sep", delimiter)
    files = [reader.csv(path) for path in paths]
    names = list(dict.fromkeys([*(known.names if known else []), *(c for f in files for c in f.columns)]))
    full = [f.select(*(F.col(c) if c in f.columns else F.lit(None).cast("string").alias(c) for c in names)) for f in files]
    together = full[0]
    for f in full[1:]:
        together = together.unionByName(f)
    looks = together.agg(*(F.bit_or(_looks(F.col(c))).alias(c) for c in names)).first()
    held = {f.name: f.dataType for f in known.fields} if known else {}
    schema = T.StructType(
        [
            T.StructField(c, widened(held[c], looks[c] or 0) if c in held else joined_type(looks[c] or 0) or T.StringType())
            for c in names
        ]
    )
    typed = [f.select(*(F.col(c.name).try_cast(c.dataType).alias(c.name) for c in schema.fields)) for f in full]
    return typed, schema
