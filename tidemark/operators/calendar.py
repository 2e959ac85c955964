"""Local dates of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import LOCAL_ZONE, in_range, local_date
from tidemark.schema import DATE


def with_local_date(events: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Add ``dt``, the local calendar date; the event time stays untouched."""
    return events.withColumn(DATE, local_date(F.col("event_time"), zone))


def date_range(
    dated: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Rows on the local dates ``start``..``end``, both included."""
    return dated.where(in_range(F.col(DATE), start, end))


def date_slice(dated: DataFrame, date: str) -> DataFrame:
    """Rows of one local date, without the date column."""
    return dated.where(F.col(DATE) == date).drop(DATE)


def target_dates(
    dated: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Distinct local dates in the range, in order."""
    return date_range(dated.select(DATE), start, end).distinct().orderBy(DATE)
