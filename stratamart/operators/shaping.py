"""Column shaping and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from stratamart.functions.names import full_name
from stratamart.model import FULL_NAME, NAME_PARTS


def move_after(df: DataFrame, column: str, anchor: str) -> DataFrame:
    """Place ``column`` right behind ``anchor`` and keep the order of the rest."""
    rest = [c for c in df.columns if c != column]
    cut = rest.index(anchor) + 1
    return df.select(*rest[:cut], column, *rest[cut:])


def merge_names(df: DataFrame, key: str, parts: Sequence[str] = NAME_PARTS) -> DataFrame:
    """Replace the name parts by one full name, placed behind the key."""
    named = df.withColumn(FULL_NAME, full_name(parts)).drop(*parts)
    return move_after(named, FULL_NAME, key)


def stack(*batches: DataFrame) -> DataFrame:
    """All rows of all batches, duplicates kept, columns matched by name."""
    return reduce(DataFrame.unionByName, batches)
