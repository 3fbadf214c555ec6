"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: list[str] = []
_written: dict[str, object] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver may leave it unset: then a
    temporary folder of this process is used. Anywhere else its absence is an error, as
    executors would write where others cannot read. The session itself is not changed.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local_folder:
            _local_folder.append(tempfile.mkdtemp(prefix="stratamart-"))
        folder = _local_folder[0]
    return folder.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other run uses; removed when this process ends."""
    path = f"{shared_folder(spark)}/stratamart/{purpose}-{uuid.uuid4().hex}"
    _written[path] = spark
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file system client; one that is absent is no error."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _written.pop(path, None)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def rename(spark: SparkSession, path: str, to: str) -> None:
    jvm = spark._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, target):
        raise OSError(f"cannot rename {path} to {to}")


def make_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def listed(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Names in a folder, and whether each is a folder itself."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return sorted((f.getPath().getName(), f.isDirectory()) for f in found)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


@atexit.register
def _clear() -> None:
    """What results may still have been reading while the process ran."""
    for path, spark in list(_written.items()):
        try:
            remove(spark, path)
        except Exception:  # the session has ended before: nothing can be reached any more
            _written.clear()
            return


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of what was written.

    For values that must stay the same when a task is run again, and for costly results that
    are read several times. Unlike a cache the files outlive lost executors, and unlike a
    checkpoint they are columnar, so later reads prune columns.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
