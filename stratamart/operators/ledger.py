"""What a fact was made from: digests of stored months and the versions that were looked up."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.model import MONTH, SALE_DATE, SALES_PARTITIONS, YEAR, Dimension
from stratamart.operators.lookup import Dimensions, open_ended
from stratamart.operators.validity import lookup_valid

# Columns of the image of a dimension that facts were looked up in.
IMAGE = ("dimensao", "chave", "sk", "_from", "_to")


def _files(spark: SparkSession, paths: Sequence[str], by_folder: bool = False) -> DataFrame:
    """Names and lengths of the data files of tables, listed by Spark; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    found = files.option("recursiveFileLookup", not by_folder).load(list(paths))
    return found.drop("content", "modificationTime").withColumn("_name", F.element_at(F.split("path", "/"), -1))


def _digest() -> Column:
    """Written files never change, and their names are never given twice: other files, another content."""
    total = F.sum(F.xxhash64("_name", "length").cast("decimal(38,0)"))
    return F.concat_ws(":", F.count("*"), total).alias("digest")


def month_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per stored month of a sales table a digest of the files that hold it."""
    files = _files(spark, [path], by_folder=True)
    if not set(SALES_PARTITIONS) <= set(files.columns):  # no file, so no folder to take them from
        files = files.withColumns({c: F.lit(None) for c in SALES_PARTITIONS})
    kinds = {c: F.col(c).cast("int") for c in SALES_PARTITIONS}
    return files.withColumns(kinds).groupBy(*SALES_PARTITIONS).agg(_digest())


def table_digest(spark: SparkSession, paths: Sequence[str]) -> str:
    """One digest of the files of several tables."""
    return _files(spark, paths).agg(_digest()).first()[0]


def looked_up(dimensions: Dimensions) -> DataFrame:
    """The image of the dimensions that decides which surrogate key a sale gets: a row per version."""
    images = [
        open_ended(rows, spec).select(
            F.lit(spec.table).alias("dimensao"), F.col(spec.key).cast("string").alias("chave"),
            F.col(spec.sk).cast("bigint").alias("sk"), "_from", "_to",
        )
        for spec, rows in dimensions
    ]
    out = images[0]
    for image in images[1:]:
        out = out.unionByName(image)
    return out


def changed_keys(before: DataFrame, now: DataFrame) -> DataFrame:
    """Keys of which a version was added, ended, moved or taken away between two images; one shuffle of both."""
    signed = before.withColumn("_sign", F.lit(-1)).unionByName(now.withColumn("_sign", F.lit(1)))
    differing = signed.groupBy(*IMAGE).agg(F.sum("_sign").alias("_sign")).filter("_sign != 0")
    return differing.select("dimensao", "chave").distinct()


def months_of_changed_lookups(sales: DataFrame, before: DataFrame, now: DataFrame, specs: Iterable[Dimension]) -> DataFrame:
    """Months with a sale whose surrogate key is another by the image ``now`` than by ``before``.

    Of the sales only the key and the date are read, and only sales of a changed key are looked up in both images.
    """
    changed = changed_keys(before, now)
    found = []
    for spec in specs:
        kind = sales.schema[spec.key].dataType
        key = F.col("chave").cast(kind).alias(spec.key)
        keys = changed.filter(F.col("dimensao") == spec.table).select(key)
        rows = sales.select(spec.key, SALE_DATE, *SALES_PARTITIONS).join(keys, spec.key, "left_semi")
        for image, name in ((before, "_was"), (now, "_is")):
            versions = image.filter(F.col("dimensao") == spec.table).select(key, "_from", "_to", F.col("sk").alias(name))
            # Only versions of changed keys can be met.
            versions = versions.join(keys, spec.key, "left_semi")
            rows = lookup_valid(rows, versions, spec.key, SALE_DATE, "_from", "_to", fits=False)
        found.append(rows.filter(~F.col("_was").eqNullSafe(F.col("_is"))).select(*SALES_PARTITIONS))
    out = found[0]
    for months in found[1:]:
        out = out.unionByName(months)
    return out.distinct()


LEDGER = T.StructType(
    [T.StructField(YEAR, T.IntegerType()), T.StructField(MONTH, T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in ("silver", "gold", "dimensoes")]
)


def compare_months(ledger: DataFrame, silver: DataFrame, fact: DataFrame) -> DataFrame:
    """Per month in any of the three: whether it differs from the ledger by its sales, or by the stored fact itself.

    ``guardado`` tells whether silver has the month. A row per month: bounded by the calendar.
    """

    def side(table: DataFrame, name: str, digest: str = "digest") -> DataFrame:
        return table.select(*SALES_PARTITIONS, F.lit(name).alias("_side"), F.col(digest).alias("_digest"))

    rows = side(silver, "silver").unionByName(side(fact, "fact"))
    rows = rows.unionByName(side(ledger, "silver_then", "silver")).unionByName(side(ledger, "fact_then", "gold"))
    one = {n: F.max(F.when(F.col("_side") == n, F.col("_digest"))) for n in ("silver", "fact", "silver_then", "fact_then")}
    months = rows.groupBy(*SALES_PARTITIONS).agg(*(c.alias(n) for n, c in one.items()))
    return months.select(
        *SALES_PARTITIONS,
        F.col("silver").isNotNull().alias("guardado"),
        F.col("fact").isNotNull().alias("em_fato"),
        (~F.col("silver").eqNullSafe(F.col("silver_then"))).alias("vendas_mudaram"),
        (~F.col("fact").eqNullSafe(F.col("fact_then"))).alias("fato_mudou"),
    )
