"""Connected components of an edge list, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.workspace import new_folder, remove

MOST_ROUNDS = 60


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Tie every vertex's neighbours to the smallest vertex of its neighbourhood.

    ``large``: the larger neighbours only, over edges in both directions; otherwise the smaller ones
    and the vertex itself. Minimum per vertex is combined before the shuffle, and joined back, so
    that no vertex's neighbours are ever gathered.
    """
    if large:
        around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    tied = around.join(lowest, "a")
    if large:
        out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``component`` (its smallest vertex) of every vertex of an edge (a, b).

    Edges with a null end or with equal ends tie nothing and are left out. Each round is written to
    the shared folder; it ends when a round changes nothing.
    """
    spark = edges.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = new_folder(spark, "edges")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    now, path = written(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    for _ in range(MOST_ROUNDS):
        # Nothing reads a round once the next one is written.
        (now, path), last = written(_stars(_stars(now, large=True), large=False)), path
        remove(spark, last)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct()
            )
        before = seen
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
