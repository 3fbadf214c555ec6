"""Names of persons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratamart.model import NAME_PARTS


def full_name(parts: Sequence[str] = NAME_PARTS) -> Column:
    """The name parts with a blank between them; null parts leave no trace."""
    return F.concat_ws(" ", *parts)
