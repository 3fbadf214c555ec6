"""Appending a batch as a whole: rows are staged, published by renaming, and a load that broke off is finished.

A batch is written beside the table, in ``<table>__staged/<load>.writing``. When it is complete its folder is renamed to
``<table>__staged/<load>``: from that step on the batch counts as loaded, and :func:`finish_loads` moves its files into
the table's storage partitions and then removes the folder. File names are unique, so moving can be taken up again
wherever it stopped. A folder that is still ``.writing`` was never complete and is dropped; its batch has not been
loaded and can be loaded again. Whoever reads the table to decide what to load finishes loads first.

Every load that counts leaves a record of one line in ``<table>__loads``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratamart.sinks.tables import fit, gather, resolve
from stratamart.workspace import exists, listed, make_folder, remove, rename, write_text

_WRITING = ".writing"
_RECORD = "_load.json"
LOADS = T.StructType(
    [
        T.StructField("carga", T.StringType()),
        T.StructField("tabela", T.StringType()),
        T.StructField("lotes", T.ArrayType(T.StringType())),
        T.StructField("marca", T.StringType()),
    ]
)


def staging_of(path: str) -> str:
    return f"{path}__staged"


def loads_of(path: str) -> str:
    return f"{path}__loads"


def append_staged(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    fmt: str = "parquet",
    target: T.StructType | None = None,
    record: dict | None = None,
) -> str:
    """Append rows as one load, after fitting them to an existing ``target``; returns the load's name.

    The table holds all rows of the load or, until the load is finished, some or none of them; it never keeps a part.
    """
    finish_loads(df.sparkSession, path)
    load = stage(df, path, by, fmt, target, record)
    finish_loads(df.sparkSession, path)
    return load


def stage(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    fmt: str = "parquet",
    target: T.StructType | None = None,
    record: dict | None = None,
) -> str:
    """Write a batch beside the table, complete, to be published by :func:`finish_loads`."""
    spark = df.sparkSession
    if target is not None:
        df = fit(df, target)
    by = resolve(df, by)
    load = uuid.uuid4().hex
    staged = f"{staging_of(path)}/{load}"
    gather(df, by).write.format(fmt).partitionBy(*by).save(f"{staged}{_WRITING}")
    line = {"carga": load, "tabela": path.rsplit("/", 1)[-1], **(record or {})}
    # Inside the folder, so that it comes to count by the same renaming.
    write_text(spark, f"{staged}{_WRITING}/{_RECORD}", json.dumps(line, default=str))
    rename(spark, f"{staged}{_WRITING}", staged)
    return load


def finish_loads(spark: SparkSession, path: str, replaced: Sequence[str] = ()) -> list[str]:
    """Publish staged loads that are complete, drop those that are not; returns the loads published now.

    Storage partitions in ``replaced`` take the place of the table's own, instead of adding files to them.
    """
    staging = staging_of(path)
    if not exists(spark, staging):
        return []
    published = []
    for name, _ in listed(spark, staging):
        folder = f"{staging}/{name}"
        if name.endswith(_WRITING):
            remove(spark, folder)
            continue
        _publish(spark, folder, path, replaced)
        record = f"{folder}/{_RECORD}"
        if exists(spark, record):
            make_folder(spark, loads_of(path))
            rename(spark, record, f"{loads_of(path)}/{name}.json")
        remove(spark, folder)
        published.append(name)
    return published


def _publish(spark: SparkSession, folder: str, path: str, replaced: Sequence[str]) -> None:
    """Move a load's partitions into the table: whole folders where the table has none, else file by file.

    A partition that replaces another is still in the load until it has been moved, so a load that broke off in between
    moves it then. Those come last: what left the replaced partition is in the table before it goes.
    """
    for partition in sorted(_leaves(spark, folder), key=lambda p: p in replaced):
        source, target = f"{folder}/{partition}", f"{path}/{partition}"
        if partition in replaced:
            remove(spark, target)
        if not exists(spark, target):
            make_folder(spark, target.rsplit("/", 1)[0])
            rename(spark, source, target)
            continue
        for name, _ in listed(spark, source):
            if not name.startswith((".", "_")):
                rename(spark, f"{source}/{name}", f"{target}/{name}")


def _leaves(spark: SparkSession, folder: str, below: str = "") -> Iterator[str]:
    """Folders of storage partitions, relative to ``folder``."""
    inner = [name for name, is_folder in listed(spark, f"{folder}/{below}" if below else folder) if is_folder and "=" in name]
    if not inner and below:
        yield below
    for name in inner:
        yield from _leaves(spark, folder, f"{below}/{name}" if below else name)


def loads(spark: SparkSession, path: str) -> DataFrame:
    """The records of a table's finished loads."""
    if not exists(spark, loads_of(path)):
        return spark.createDataFrame([], LOADS)
    return spark.read.schema(LOADS).json(loads_of(path))


def forget_loads(spark: SparkSession, path: str) -> None:
    """Before a table is replaced as a whole: nothing staged for the old one may come into the new one."""
    remove(spark, staging_of(path))
    remove(spark, loads_of(path))
