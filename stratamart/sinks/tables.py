"""Writing stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.workspace import exists, remove, rename

_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


class SchemaMismatch(ValueError):
    """Rows do not fit the table they were to be appended to."""


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").save(path)


def switch(df: DataFrame, path: str, fmt: str = "parquet", by: Sequence[str] = ()) -> None:
    """Replace a table, stored by the columns ``by`` if any, by rows that may be read from it.

    The new version is complete beside the table before the old one is renamed away and the new one takes its
    place; the old one goes last. A run that dies in between leaves a complete version that
    :func:`recover` finds. Renaming a folder is one step on file systems that have folders.
    """
    spark = df.sparkSession
    following, previous = _versions(path)
    remove(spark, following)
    remove(spark, previous)
    (gather(df, by).write.partitionBy(*by) if by else df.write).format(fmt).save(following)
    if exists(spark, path):
        rename(spark, path, previous)
    rename(spark, following, path)
    remove(spark, previous)


def recover(spark: SparkSession, path: str) -> None:
    """Put back the table that a :func:`switch` had taken away and not yet replaced."""
    _, previous = _versions(path)
    if not exists(spark, path) and exists(spark, previous):
        rename(spark, previous, path)


def _versions(path: str) -> tuple[str, str]:
    return f"{path}__following", f"{path}__previous"


def partition_path(path: str, by: Sequence[str], values: Sequence) -> str:
    """Where a table's partition is stored, for values that need no escaping; null as Spark names it."""
    parts = (f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(by, values, strict=True))
    return "/".join((path, *parts))


def overwrite_partitioned(
    df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", clustered: bool = False
) -> None:
    """Replace the whole table; ``clustered`` as for :func:`gather`."""
    by = resolve(df, by)
    gather(df, by, clustered).write.format(fmt).partitionBy(*by).mode("overwrite").save(path)


def replace_partitions(
    df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", clustered: bool = False
) -> None:
    """Overwrite only the storage partitions that ``df`` has rows for."""
    by = resolve(df, by)
    (
        gather(df, by, clustered)
        .write.format(fmt)
        .partitionBy(*by)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .save(path)
    )


def append_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    fmt: str = "parquet",
    target: T.StructType | None = None,
) -> None:
    """Append rows, after fitting them to the schema of an existing ``target``.

    Parquet takes files of differing types into one folder without complaint and fails on the
    next read, hence the check before the write.
    """
    if target is not None:
        df = fit(df, target)
    by = resolve(df, by)
    gather(df, by).write.format(fmt).partitionBy(*by).mode("append").save(path)


def gather(df: DataFrame, by: Sequence[str], clustered: bool = False) -> DataFrame:
    """Bring rows of one storage partition together before a partitioned write.

    Without it each task writes a file into every partition it meets. The rebalance hint lets
    the adaptive planner split a partition that holds much of the table over many tasks and
    merge small ones, each task aiming at ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.

    ``clustered`` rows need no shuffle: they come straight from a scan of a table stored by the
    same partitions, so that each task meets only the few its files belong to.
    """
    return df if clustered else df.hint("rebalance", *by)


def resolve(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The given column names in the spelling of ``df``; folder names follow it."""
    spelled = {c.lower(): c for c in df.columns}
    unknown = [n for n in names if n.lower() not in spelled]
    if unknown:
        raise SchemaMismatch(f"no such column: {', '.join(unknown)}")
    return [spelled[n.lower()] for n in names]


def fit(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` with the target's columns, order and types; refuses what could lose values."""
    have = {f.name.lower(): f for f in df.schema.fields}
    want = {f.name.lower(): f for f in target.fields}
    if have.keys() != want.keys():
        raise SchemaMismatch(
            f"columns differ: missing {sorted(want.keys() - have.keys())}, "
            f"unexpected {sorted(have.keys() - want.keys())}"
        )
    narrowed = [
        f"{f.name} {have[n].dataType.simpleString()} -> {f.dataType.simpleString()}"
        for n, f in want.items()
        if not _widens(have[n].dataType, f.dataType)
    ]
    if narrowed:
        raise SchemaMismatch(f"types differ: {', '.join(narrowed)}")
    return df.select(*(F.col(have[n].name).cast(f.dataType).alias(f.name) for n, f in want.items()))


def _widens(source: T.DataType, target: T.DataType) -> bool:
    if source == target:
        return True
    if source in _INTEGERS and target in _INTEGERS:
        return _INTEGERS.index(source) < _INTEGERS.index(target)
    if isinstance(source, T.DecimalType) and isinstance(target, T.DecimalType):
        return source.scale <= target.scale and (
            source.precision - source.scale <= target.precision - target.scale
        )
    return False
