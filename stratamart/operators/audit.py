"""What a load read, kept and dropped."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.functions.dates import day_literal
from stratamart.model import SALE_DATE, UNREADABLE


def load_audit(batches: DataFrame, mark: date | None, batch: str = "lote", column: str = SALE_DATE) -> DataFrame:
    """Per batch: rows read, kept, dropped as not newer than the mark, undated; date range; mark.

    ``batches`` carries the batch name in the column ``batch``. Undated rows are dropped too
    once there is a mark. Lines that could not be read as declared are counted where the batches carry
    them. A single pass over a few columns, combined before the shuffle.
    """
    day = F.col(column)
    kept = F.lit(True) if mark is None else F.coalesce(day > day_literal(mark), F.lit(False))
    unreadable = [F.count(UNREADABLE).alias("ilegiveis")] if UNREADABLE in batches.columns else []
    return batches.groupBy(batch).agg(
        F.count("*").alias("lidas"),
        F.count_if(kept).alias("mantidas"),
        F.count_if(~kept).alias("descartadas"),
        F.count_if(day.isNull()).alias("sem_data"),
        F.min(column).alias("primeira_data"),
        F.max(column).alias("ultima_data"),
        (F.lit(None) if mark is None else day_literal(mark)).cast(batches.schema[column].dataType).alias("marca"),
        *unreadable,
    )
