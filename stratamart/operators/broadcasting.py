"""Deciding by counted size whether a join side is sent to every executor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Session setting with the largest join side to broadcast, and its value where it is not set.
SETTING = "spark.stratamart.broadcastBytes"
BROADCAST_BYTES = 256 * 1024 * 1024

# Bytes of one row in a broadcast hash table besides its fields: row header, key and pointers.
_ROW_OVERHEAD = 40


def fits_broadcast(df: DataFrame, limit: int | None = None, no_more_than: DataFrame | None = None) -> bool:
    """Whether counted rows at a fixed width per row stay within ``limit`` bytes.

    Without ``limit`` the session setting holds. Columns without a fixed width give no bound, so
    such a side never passes. Counting a stored table reads only its file footers; where ``df``
    takes work to count, ``no_more_than`` names a table with at least as many rows to count instead.
    """
    if limit is None:
        limit = int(df.sparkSession.conf.get(SETTING, str(BROADCAST_BYTES)))
    width = _row_width(df.schema)
    if width is None:
        return False
    return (df if no_more_than is None else no_more_than).count() * width <= limit


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df`` hinted for broadcast when it fits; otherwise as it is, for Spark to shuffle.

    In the shuffled join the adaptive planner splits the partition of a hot key on the
    preserved (left) side over several tasks.
    """
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def _row_width(schema: T.StructType) -> int | None:
    fields = [f.dataType for f in schema.fields]
    if not all(_is_fixed(kind) for kind in fields):
        return None
    return _ROW_OVERHEAD + 8 * len(fields)


def _is_fixed(kind: T.DataType) -> bool:
    if isinstance(kind, T.DecimalType):
        return kind.precision <= 18
    return isinstance(kind, (T.IntegralType, T.DateType, T.DoubleType, T.FloatType, T.BooleanType))
