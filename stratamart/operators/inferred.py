"""Members that sales name before their source does."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions.dates import load_day, open_end
from stratamart.model import ACTIVE, VALID_FROM, VALID_TO, Dimension
from stratamart.operators.history import tracked_columns
from stratamart.operators.keys import highest, number_rows


def inferred_members(dimension: DataFrame, facts: DataFrame, spec: Dimension, load_date: date | str | None = None) -> DataFrame:
    """A row for each key that facts use and the dimension does not have: its own surrogate key, nothing else known.

    Keys are counted out per task before the shuffle, so a key with a third of all facts crosses as one row per task.
    """
    used = facts.select(spec.key).filter(F.col(spec.key).isNotNull()).distinct()
    unknown = used.join(dimension.select(spec.key).distinct(), spec.key, "left_anti")
    numbered = number_rows(unknown, spec.key, spec.sk, after=highest(dimension, spec.sk))
    given = {spec.key: F.col(spec.key), spec.sk: F.col(spec.sk), VALID_FROM: load_day(load_date), VALID_TO: open_end(), ACTIVE: F.lit(1)}
    return numbered.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in dimension.schema.fields))


def is_inferred(dimension: DataFrame, spec: Dimension) -> Column:
    """Whether nothing but the key is known of a version."""
    known = F.lit(False)
    for c in tracked_columns(dimension, spec):
        known = known | F.col(c).isNotNull()
    return ~known


def take_over(dimension: DataFrame, extract: DataFrame, spec: Dimension) -> DataFrame:
    """The dimension with inferred members of the extract filled in: same surrogate key, same validity.

    What is known of such a key was true all the time, so it is no change. All other rows pass as they are, and only
    inferred ones meet the extract.
    """
    tracked = tracked_columns(dimension, spec)
    open_members = dimension.filter(is_inferred(dimension, spec) & (F.col(ACTIVE) == 1))
    rest = dimension.filter(~(is_inferred(dimension, spec) & F.coalesce(F.col(ACTIVE) == 1, F.lit(False))))
    sent = extract.select(F.col(spec.key).alias("_key"), F.struct(*tracked).alias("_sent"))
    filled = open_members.join(sent, F.col(spec.key) == F.col("_key"), "left")
    values = [F.col(f"_sent.{c}").alias(c) if c in tracked else F.col(c) for c in dimension.columns]
    return rest.unionByName(filled.select(*values))
