"""Joining rows to the version of another table that was valid on their date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.operators.broadcasting import fits_broadcast


def lookup_valid(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    limit: int | None = None,
    no_more_than: DataFrame | None = None,
    fits: bool | None = None,
) -> DataFrame:
    """Left join: add the columns of the version of ``key`` with ``start <= at < end``.

    Null bounds are open. Versions of one key must not overlap, so every row stays one row.

    Versions that pass :func:`fits_broadcast`, or that the caller has found to (``fits``), are broadcast.
    Otherwise Spark shuffles both sides on the key, and the adaptive planner splits the rows of a hot
    key over tasks, as they are the preserved side. The rows are the same either way.
    """
    payload = [c for c in versions.columns if c not in (key, start, end)]
    v = versions.select(
        F.col(key).alias("_key"), F.col(start).alias("_start"), F.col(end).alias("_end"), *payload
    )
    date = F.col(at)
    inside = (
        (F.col(key) == F.col("_key"))
        & (F.col("_start").isNull() | (F.col("_start") <= date))
        & (F.col("_end").isNull() | (date < F.col("_end")))
    )
    if fits_broadcast(v, limit, no_more_than) if fits is None else fits:
        v = F.broadcast(v)
    return rows.join(v, inside, "left").select(*rows.columns, *payload)


def intervals(changes: DataFrame, key: str, since: str, value: str) -> DataFrame:
    """Turn dated changes of ``value`` into versions ``[since, _until)``, the last one open.

    Changes are first reduced to one per key and day, the highest value winning, with partial
    maxima before the shuffle. What the window then sorts per key is bounded by the calendar.
    """
    if not isinstance(changes.schema[since].dataType, T.DateType):
        raise TypeError(f"{since} must be a date, so that a key's versions are bounded by days")
    daily = changes.filter(F.col(since).isNotNull()).groupBy(key, since).agg(F.max(value).alias(value))
    following = F.lead(since).over(Window.partitionBy(key).orderBy(since))
    return daily.withColumn("_until", following)

