"""History from dated states that come in any order: backdated extracts and feeds of changes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.functions.dates import load_day, open_end
from stratamart.model import ACTIVE, VALID_FROM, VALID_TO, Dimension
from stratamart.operators.keys import highest, number_rows
from stratamart.workspace import materialize


def tracked_columns(dimension: DataFrame, spec: Dimension) -> list[str]:
    return [c for c in dimension.columns if c not in (spec.key, spec.sk, VALID_FROM, VALID_TO, ACTIVE)]


def last_of_day(feed: DataFrame, spec: Dimension, at: str, order: str) -> DataFrame:
    """The states that a feed of changes leaves: per key and day the last one by ``order``, dated ``data_inicio``.

    Combined before the shuffle, so a key with a third of all changes crosses as one row per task and day.
    Changes of equal order are decided by their values. Changes without a key or a time are left out.
    """
    values = [c for c in feed.columns if c not in (spec.key, at, order)]
    dated = feed.filter(F.col(spec.key).isNotNull() & F.col(at).isNotNull())
    last = dated.groupBy(spec.key, F.col(at).cast("date").alias(VALID_FROM)).agg(
        F.max(F.struct(F.col(at).alias("_at"), F.col(order).alias("_order"), *values)).alias("_last")
    )
    return last.select(spec.key, VALID_FROM, *(F.col(f"_last.{c}").alias(c) for c in values))


def differing_states(dimension: DataFrame, extract: DataFrame, spec: Dimension, load_date: date | str) -> DataFrame:
    """Rows of an extract that are not what the dimension holds for their key on the load date, dated by it.

    A key has one version on a day at most, so this is a join on the key.
    """
    day = load_day(load_date)
    tracked = tracked_columns(dimension, spec)
    held = dimension.filter((F.col(VALID_FROM) <= day) & (day < F.col(VALID_TO)))
    held = held.select(spec.key, F.struct(*tracked).alias("_held"))
    joined = extract.select(spec.key, F.struct(*tracked).alias("_sent")).join(held, spec.key, "left")
    changed = joined.filter(~F.col("_sent").eqNullSafe(F.col("_held")))
    return changed.select(spec.key, day.alias(VALID_FROM), *(F.col(f"_sent.{c}").alias(c) for c in tracked))


def insert_states(dimension: DataFrame, states: DataFrame, spec: Dimension, seen: DataFrame | None = None) -> DataFrame:
    """The dimension with states worked into the histories of their keys, wherever their dates fall.

    A state (key, ``data_inicio``, attributes; one per key and day) holds until the next thing known of its key: another
    state, the start of a version, or a day on which the key was seen (``seen``: key, ``data_inicio``) with the value the
    history has for it. So a state put in between two sightings of an older value ends at the second one, and the
    older value goes on from there. Versions are then the islands of equal consecutive values: a state that
    equals what came before it starts none, one that equals the version after it moves that version's start. A state on the
    first day of a version replaces its attributes. Versions keep their surrogate keys, new ones get the next ones.

    Any order of the same loads gives the same history, but for the numbers of new keys, if ``seen`` has every day on
    which a load had the key. Histories of keys without a state pass through; the others are sorted per key, a row per version
    and day seen, so they are bounded by the calendar.
    """
    key, sk = spec.key, spec.sk
    tracked = tracked_columns(dimension, spec)
    value = F.struct(*tracked)
    keys = states.select(key).distinct()

    def event(of: DataFrame, rank: int, known: Column, number: Column) -> DataFrame:
        return of.select(key, F.col(VALID_FROM).alias("_at"), known.alias("_value"), number.alias(sk), F.lit(rank).alias("_rank"))

    none = F.lit(None).cast(dimension.schema[sk].dataType)
    events = event(dimension.join(keys, key, "left_semi"), 1, value, F.col(sk))
    if seen is not None:
        days = seen.select(key, VALID_FROM).distinct().join(keys, key, "left_semi")
        unknown = F.lit(None).cast(events.schema["_value"].dataType)
        events = events.unionByName(event(days, 0, unknown, none))
        until = Window.partitionBy(key).orderBy("_at", F.desc("_rank"))
        events = events.withColumn("_value", F.last("_value", ignorenulls=True).over(until)).filter("_value IS NOT NULL")
    events = events.unionByName(event(states, 2, value, none))

    daily = events.groupBy(key, "_at").agg(F.max_by("_value", "_rank").alias("_value"), F.max(sk).alias(sk))
    ordered = Window.partitionBy(key).orderBy("_at")
    starts = ~F.coalesce(F.lag("_value").over(ordered).eqNullSafe(F.col("_value")), F.lit(False))
    first = F.row_number().over(ordered) == 1
    islands = daily.withColumn("_start", starts | first).withColumn("_island", F.sum(F.col("_start").cast("int")).over(ordered))
    versions = islands.groupBy(key, "_island").agg(
        F.min("_at").alias(VALID_FROM),
        F.min_by("_value", "_at").alias("_value"),
        F.min_by(sk, F.when(F.col(sk).isNotNull(), F.col("_at"))).alias(sk),
    )
    following = F.lead(VALID_FROM).over(Window.partitionBy(key).orderBy(VALID_FROM))
    # Written once: kept and new versions are both read from it, and keys are numbered.
    dated = materialize(versions.withColumn("_next", following), "history").select(
        key, *(F.col(f"_value.{c}").alias(c) for c in tracked), sk, VALID_FROM,
        F.coalesce("_next", open_end()).alias(VALID_TO), F.when(F.col("_next").isNull(), 1).otherwise(0).alias(ACTIVE),
    )
    fresh = number_rows(dated.filter(F.col(sk).isNull()).drop(sk), key, sk, after=highest(dimension, sk))
    rest = dimension.join(keys, key, "left_anti")
    out = rest.unionByName(dated.filter(F.col(sk).isNotNull())).unionByName(fresh)
    return out.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in dimension.schema.fields))
