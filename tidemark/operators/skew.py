"""How unevenly events are spread over users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values.
SKEW_THRESHOLD = 10_000
TOP_USERS = 10


def user_event_counts(events: DataFrame) -> DataFrame:
    """Events per user; counted on the map side before the shuffle."""
    return events.groupBy("user_id").agg(F.count("*").alias("event_count"))


def busiest(user_counts: DataFrame, n: int = TOP_USERS) -> DataFrame:
    """The ``n`` largest of the counts; equal ones in order of the user ID."""
    return user_counts.orderBy(
        F.desc("event_count"), F.asc_nulls_first("user_id")
    ).limit(n)


def at_least(user_counts: DataFrame, threshold: int = SKEW_THRESHOLD) -> DataFrame:
    return user_counts.where(F.col("event_count") >= threshold)


def top_users(events: DataFrame, n: int = TOP_USERS) -> DataFrame:
    """The ``n`` busiest users."""
    return busiest(user_event_counts(events), n)


def skewed_users(events: DataFrame, threshold: int = SKEW_THRESHOLD) -> DataFrame:
    """Users with ``threshold`` events or more."""
    return at_least(user_event_counts(events), threshold)


def skewed_user_count(events: DataFrame, threshold: int = SKEW_THRESHOLD) -> DataFrame:
    return skewed_users(events, threshold).agg(F.count("*").alias("skewed_users"))
