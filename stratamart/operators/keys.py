"""Surrogate keys: dense, in natural-key order, and the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.workspace import materialize

# monotonically_increasing_id() keeps the partition number above these bits, the row below.
_ROW_BITS = 33


def number_rows(df: DataFrame, key: str, sk: str, after: int = 0) -> DataFrame:
    """Add ``sk``: ``after`` + 1, + 2, ... in the order of ``key``, meant to be unique.

    One range shuffle sorts the table over all tasks; should rows share a key after all, a hash
    of the whole row orders them and lets the shuffle part them. Each row's partition and
    position are written out before they are used, since a second run of the shuffle may draw
    other range bounds. A running sum over one count per partition then turns positions into
    ranks, so neither the driver nor any single task sees the rows.
    """
    order = [F.col(key), F.xxhash64(*df.columns)]
    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "keys",
    ).withColumn("_slice", F.shiftright("_place", _ROW_BITS))

    # One row per shuffle partition: small whatever the size of the table.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_slice")
        .agg(F.count("*").alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    position = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    rank = F.col("_start") + position + 1 + after
    return placed.join(F.broadcast(starts), "_slice").select(*df.columns, rank.cast("bigint").alias(sk))


def extend_keys(known: DataFrame, df: DataFrame, key: str, sk: str) -> DataFrame:
    """Rows of ``df`` with their surrogate key: the known one, or the next free ones for new keys.

    ``known`` holds one row per natural key.
    """
    known = known.select(key, sk)
    joined = materialize(df.join(known, key, "left").select(*df.columns, sk), "known")
    fresh = joined.filter(F.col(sk).isNull()).drop(sk)
    return joined.filter(F.col(sk).isNotNull()).unionByName(number_rows(fresh, key, sk, highest(known, sk)))


def highest(df: DataFrame, sk: str) -> int:
    """The highest key given out so far, 0 for none."""
    return df.agg(F.max(sk)).first()[0] or 0
