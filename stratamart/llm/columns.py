"""Column helpers shared by the operators that stay in built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A run of the white space that separates plain words.
SPACE = r"[\x20\x09-\x0D]+"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, also where ``use`` names it inside a lambda.

    The optimizer may put an expression in place of a column that stands for it, and a lambda would then
    compute it again for every element.
    """
    return F.transform(F.array(value), use)[0]


def plain_words(text: Column) -> Column:
    """Runs of what is not white space, in order."""
    return F.array_remove(F.split(text, SPACE), "")


def occurrences(text: Column, pattern: str) -> Column:
    """How often a pattern that is never empty matches."""
    return F.size(F.split(text, pattern)) - 1


def join_by_size(rows: DataFrame, known: DataFrame, on: str, how: str, bytes_of: Column, most: int) -> DataFrame:
    """``rows`` joined to what is known of some keys.

    The known side, a stored table, is sent to every task if its counted bytes, ``bytes_of`` each row and
    some for its place in a hash table, are ``most`` at most; beyond that both sides are shuffled.
    """
    counted = known.agg(F.sum(bytes_of), F.count("*")).first()
    if (counted[0] or 0) + 64 * counted[1] <= most:
        known = F.broadcast(known)
    return rows.join(known, on, how)
