"""Swapping natural keys of the fact for surrogate keys of its dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.functions.dates import open_end
from stratamart.model import ACTIVE, SALE_DATE, VALID_FROM, VALID_TO, Dimension
from stratamart.operators.broadcasting import broadcast_if_small, fits_broadcast
from stratamart.operators.validity import lookup_valid

Dimensions = Iterable[tuple[Dimension, DataFrame]]


def swap_keys(fact: DataFrame, dimensions: Dimensions, limit: int | None = None) -> DataFrame:
    """Replace each natural key by the surrogate key; a key without a dimension row gets null.

    Only the two key columns of a dimension take part. All rows of it do, so the dimension must
    hold one row per natural key: see :func:`current_versions` and :func:`swap_keys_at_date`.
    """
    dimensions = list(dimensions)
    for spec, rows in dimensions:
        fact = fact.join(broadcast_if_small(rows.select(spec.key, spec.sk), limit), spec.key, "left")
    return fact.drop(*(spec.key for spec, _ in dimensions))


def current_versions(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col(ACTIVE) == 1)


def swap_keys_at_date(
    fact: DataFrame,
    dimensions: Dimensions,
    at: str = SALE_DATE,
    limit: int | None = None,
    fits: Sequence[bool] | None = None,
) -> DataFrame:
    """Like :func:`swap_keys`, with the version that was valid on the date of the fact row.

    The first version of a key counts from the beginning of time: a dimension starts on the day
    it was first loaded, which is later than the sales it has to serve. Undated rows find the
    version of a key that never changed, and null for one that did. ``fits`` is what
    :func:`fitting` has found before, for dimensions that need not be counted again.
    """
    dimensions = list(dimensions)
    for (spec, rows), small in zip(dimensions, fits or fitting(dimensions, limit), strict=True):
        fact = lookup_valid(fact, open_ended(rows, spec), spec.key, at, "_from", "_to", fits=small)
    return fact.drop(*(spec.key for spec, _ in dimensions))


def fitting(dimensions: Dimensions, limit: int | None = None) -> list[bool]:
    """Which dimensions :func:`swap_keys_at_date` broadcasts; where all are, no fact row moves.

    A dimension has as many rows as what is looked up of it, and a stored one is counted from its footers.
    """
    return [fits_broadcast(open_ended(rows, spec), limit, no_more_than=rows) for spec, rows in dimensions]


def open_ended(dimension: DataFrame, spec: Dimension) -> DataFrame:
    """Key, surrogate key and validity, with nulls for the open bounds of first and last version.

    The window sorts one row per load that changed a key, never rows of the fact.
    """
    first = F.min(VALID_FROM).over(Window.partitionBy(spec.key))
    return dimension.select(
        spec.key,
        F.when(F.col(VALID_FROM) != first, F.col(VALID_FROM)).alias("_from"),
        F.when(F.col(VALID_TO) != open_end(), F.col(VALID_TO)).alias("_to"),
        spec.sk,
    )
