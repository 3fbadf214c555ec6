"""Dimension rows with surrogate keys and type 2 history."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions.dates import load_day, open_end
from stratamart.model import ACTIVE, VALID_FROM, VALID_TO, Dimension
from stratamart.operators.keys import highest, number_rows
from stratamart.workspace import materialize


def with_history_columns(df: DataFrame, load_date: date | str | None = None) -> DataFrame:
    """Mark every row as the active version, valid from the load date on."""
    return df.withColumns(
        {VALID_FROM: load_day(load_date), VALID_TO: open_end(), ACTIVE: F.lit(1)}
    )


def first_load(df: DataFrame, spec: Dimension, load_date: date | str | None = None) -> DataFrame:
    """Source rows as a new dimension."""
    return with_history_columns(number_rows(df, spec.key, spec.sk), load_date)


def merge_changes(
    dimension: DataFrame,
    source: DataFrame,
    spec: Dimension,
    load_date: date | str | None = None,
    last_sk: int | None = None,
) -> DataFrame:
    """The dimension after a load of ``source``, its full current extract.

    Only active versions are needed: without the ended ones the result is the active versions and those that
    the load ends. ``last_sk`` is then the highest surrogate key given out, which an ended version may have.

    * Unchanged keys, and keys the extract no longer has, keep their active version.
    * A changed key's active version ends on the load date, exclusive, and a new version with a
      new surrogate key starts on it. If the active version started on the load date its
      attributes are replaced instead, so no version is valid for zero days.
    * New keys get their first version.

    An extract with a null or repeated key is refused, and so is a load date before the newest
    active version began: its older attributes would replace newer ones.

    Attributes are compared null-safely. Ended versions are passed through without a shuffle;
    active ones meet the extract in one full outer join on the unique key, whose result is
    written once because kept, ended and new rows are all read from it.
    """
    tracked = [c for c in dimension.columns if c not in (spec.key, spec.sk, VALID_FROM, VALID_TO, ACTIVE)]
    if load_date is None:  # several queries follow; midnight must not fall between them
        load_date = dimension.sparkSession.range(1).select(F.current_date()).first()[0]
    require_extract(dimension, source, spec)
    _require_later_load(dimension, load_date, spec)
    day = load_day(load_date)
    is_active = F.col(ACTIVE) == 1

    active = dimension.filter(is_active).select(
        spec.key, spec.sk, VALID_FROM, VALID_TO, F.struct(*tracked).alias("_old"), F.lit(True).alias("_held")
    )
    extract = source.select(spec.key, F.struct(*tracked).alias("_new"), F.lit(True).alias("_sent"))
    held, sent = F.col("_held").isNotNull(), F.col("_sent").isNotNull()
    changed = held & sent & _any_differs(tracked)
    pairs = materialize(
        active.join(extract, spec.key, "full_outer")
        .withColumn("_replaced", changed & (F.col(VALID_FROM) == day))
        .withColumn("_ended", changed & (F.col(VALID_FROM) < day))
        .withColumn("_new", F.when(~held | F.col("_replaced") | F.col("_ended"), F.col("_new")))
        .drop("_sent"),
        "scd2",
    )

    after = {c: F.when(F.col("_replaced"), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")) for c in tracked}
    kept = pairs.filter(held).select(
        spec.key,
        *(after[c].alias(c) for c in tracked),
        spec.sk,
        VALID_FROM,
        F.when(F.col("_ended"), day).otherwise(F.col(VALID_TO)).alias(VALID_TO),
        F.when(F.col("_ended"), 0).otherwise(1).alias(ACTIVE),
    )
    opened = pairs.filter(~held | F.col("_ended")).select(
        spec.key, *(F.col(f"_new.{c}").alias(c) for c in tracked)
    )
    numbered = number_rows(opened, spec.key, spec.sk, after=highest(dimension, spec.sk) if last_sk is None else last_sk)
    fresh = with_history_columns(numbered, load_date)
    closed = dimension.filter(~F.coalesce(is_active, F.lit(False)))
    return closed.unionByName(kept).unionByName(fresh).select(*dimension.columns)


def require_extract(dimension: DataFrame, source: DataFrame, spec: Dimension) -> None:
    """Refuse an extract with other columns than the dimension, or with null or repeated keys."""
    tracked = [c for c in dimension.columns if c not in (spec.key, spec.sk, VALID_FROM, VALID_TO, ACTIVE)]
    _require_same_columns(tracked, source, spec)
    _require_unique_keys(source, spec)


def _any_differs(columns: Iterable[str]) -> Column:
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    return differs


def _require_same_columns(tracked: list[str], source: DataFrame, spec: Dimension) -> None:
    expected, given = {spec.key, *tracked}, set(source.columns)
    if expected != given:
        raise ValueError(
            f"extract of {spec.table} lacks {sorted(expected - given)} and adds {sorted(given - expected)}"
        )


def _require_unique_keys(source: DataFrame, spec: Dimension) -> None:
    """Counted per key, so no key's rows are gathered."""
    counts = source.groupBy(spec.key).count()
    nulls, repeated = counts.agg(
        F.count_if(F.col(spec.key).isNull()), F.count_if(F.col(spec.key).isNotNull() & (F.col("count") > 1))
    ).first()
    if nulls or repeated:
        raise ValueError(f"extract of {spec.table}: {'null keys' if nulls else f'{repeated} keys repeated'} in {spec.key}")


def _require_later_load(dimension: DataFrame, load_date: date | str, spec: Dimension) -> None:
    newest = F.max(F.when(F.col(ACTIVE) == 1, F.col(VALID_FROM)))
    earlier, newest = dimension.agg(newest > load_day(load_date), newest).first()
    if earlier:
        raise ValueError(f"load date {load_date} is before {newest}, when a version of {spec.table} began")
