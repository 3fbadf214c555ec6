"""Naming the rows in which two layers differ."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.workspace import materialize

# Rows that a leaf of the tree aims at, the most leaves, and children of a node.
LEAF_ROWS = 1024
MOST_LEAVES = 1 << 20
FANOUT = 32


def _row_hash(columns: list[str]) -> Column:
    # A hash passes over nulls, so which values are null is hashed too.
    return F.xxhash64(*columns, *(F.col(c).isNull() for c in columns))


def leaf_digests(table: DataFrame, key: str, columns: list[str], leaves: int) -> DataFrame:
    """Count and hash sum of the rows in each range of key hashes; combined per task before the shuffle."""
    leaf = _leaf(F.col(key), leaves).alias("leaf")
    return table.groupBy(leaf).agg(F.count("*").alias("n"), F.sum(_row_hash(columns).cast("decimal(38,0)")).alias("total"))


def _leaf(key: Column, leaves: int) -> Column:
    """Ranges of the upper bits of the key's hash."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - int(math.log2(leaves))).cast("int") if leaves > 1 else F.lit(0)


def differing_leaves(left: DataFrame, right: DataFrame, leaves: int) -> list[int]:
    """Leaves whose digests differ, found from the root down: children are looked at only where their parent differs.

    A level of the tree is a few bytes per node, worked out from stored leaf digests; what comes to the driver is the nodes
    that differ, on the way down and at last as leaves.
    """
    width = 1
    while width * FANOUT < leaves:
        width *= FANOUT
    suspect: list[int] | None = None
    while True:
        def level(table: DataFrame, side: int, width: int = width) -> DataFrame:
            node = F.floor(F.col("leaf") / width).cast("int").alias("node")
            rows = table.select(node, "n", "total")
            if suspect is not None:
                rows = rows.filter(F.floor(F.col("node") / FANOUT).cast("int").isin(suspect))
            sign = F.lit(side).cast("decimal(38,0)")
            return rows.select("node", (F.col("n") * side).alias("n"), (F.col("total") * sign).cast("decimal(38,0)").alias("total"))

        both = level(left, 1).unionByName(level(right, -1)).groupBy("node").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        suspect = sorted(r.node for r in both.filter("n != 0 OR total != 0").collect())
        if width == 1 or not suspect:
            return suspect
        width = max(1, width // FANOUT)


def differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys whose rows are not the same in two layers: the key, ``regra``, and how many rows each layer has of it.

    ``falta``: only the left layer has the key; ``sobra``: only the right one; ``difere``: both, with other values or another
    number of rows. Columns that both have are compared, nulls as values, rows as a multiset. Null keys are one key.

    Of all rows only digests cross the network, one per task and leaf; rows meet by key only for leaves that differ.
    """
    columns = [c for c in left.columns if c in right.columns]
    left, right = left.select(*columns), right.select(*columns)
    # One pass over each side: digests of the finest leaves, from which the row counts and coarser leaves follow.
    finest = [materialize(leaf_digests(table, key, columns, MOST_LEAVES), "digests") for table in (left, right)]
    rows = max(int(d.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) for d in finest)
    leaves = 1 << max(0, min(MOST_LEAVES, max(1, rows // LEAF_ROWS)).bit_length() - 1)
    shift = int(math.log2(MOST_LEAVES)) - int(math.log2(leaves))
    stored = [
        d.groupBy(F.shiftrightunsigned("leaf", shift).alias("leaf")).agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))
        for d in finest
    ]
    suspect = differing_leaves(*stored, leaves)

    def of_key(table: DataFrame, side: str) -> DataFrame:
        some = table.filter(_leaf(F.col(key), leaves).isin(suspect)) if suspect else table.limit(0)
        rows = some.groupBy(key).agg(F.count("*").alias("n"), F.sum(_row_hash(columns).cast("decimal(38,0)")).alias("total"))
        return rows.select(F.col(key).alias(f"_{side}"), F.col("n").alias(f"{side}_n"), F.col("total").alias(f"{side}_total"))

    met = of_key(left, "esquerda").join(of_key(right, "direita"), F.col("_esquerda").eqNullSafe(F.col("_direita")), "full_outer")
    rule = F.when(F.col("direita_n").isNull(), "falta").when(F.col("esquerda_n").isNull(), "sobra").otherwise("difere")
    same = F.col("esquerda_n").eqNullSafe(F.col("direita_n")) & F.col("esquerda_total").eqNullSafe(F.col("direita_total"))
    return met.filter(~same).select(
        F.coalesce("_esquerda", "_direita").alias(key),
        rule.alias("regra"),
        F.coalesce("esquerda_n", F.lit(0)).alias("esquerda"),
        F.coalesce("direita_n", F.lit(0)).alias("direita"),
    )
