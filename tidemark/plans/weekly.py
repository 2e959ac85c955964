"""Raw events to dated, sessionized events, and to weekly active users."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.clock import LOCAL_ZONE, WEEK_BOUNDS
from tidemark.operators.calendar import with_local_date
from tidemark.operators.metrics import wau
from tidemark.operators.sessions import SESSION_GAP, sessionize


def sessionized_events(
    raw: DataFrame, gap: int = SESSION_GAP, zone: str = LOCAL_ZONE
) -> DataFrame:
    """Session IDs first, over all events; dates after, so that a session
    crossing midnight keeps one ID."""
    return with_local_date(sessionize(raw, gap), zone)


def weekly_active_users(
    raw: DataFrame,
    gap: int = SESSION_GAP,
    low: str = WEEK_BOUNDS[0],
    high: str = WEEK_BOUNDS[1],
) -> DataFrame:
    return wau(sessionized_events(raw, gap), low, high)
