"""Calendar parts used as storage partitions, and validity dates of dimension rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratamart.model import OPEN_END


def year_of(column: str) -> Column:
    return F.year(column)


def month_of(column: str) -> Column:
    return F.month(column)


def load_day(load_date: date | str | None) -> Column:
    """The day a load counts as; the current day unless the caller fixes one."""
    return F.current_date() if load_date is None else F.lit(str(load_date)).cast("date")


def open_end() -> Column:
    """The end date of a row that is still valid."""
    return F.lit(OPEN_END).cast("date")


def day_literal(day: date) -> Column:
    """A date as a constant; by its text, as the earliest ones do not pass the bridge as dates."""
    return F.lit(day.isoformat()).cast("date") if type(day) is date else F.lit(day)
