"""Time expressions that read the same under every session time zone.

``date_format`` renders in the session zone, so an ID or a date built with it
changes when a caller's session is not on UTC. These expressions go through
epoch seconds and plain dates instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400

# Fixed values.
LOCAL_ZONE = "Asia/Seoul"
WEEK_BOUNDS = ("2019-10-01", "2019-12-01")


def epoch_seconds(time: Column) -> Column:
    """Whole seconds since 1970, rounded down."""
    return F.unix_seconds(time)


def floor_to(seconds: Column, width: int) -> Column:
    """Start of the ``width``-second interval that holds ``seconds``."""
    return seconds - F.pmod(seconds, F.lit(width).cast("bigint"))


def utc_date(seconds: Column) -> Column:
    """UTC calendar day of an epoch second, as DATE."""
    return F.date_from_unix_date((floor_to(seconds, DAY) / DAY).cast("int"))


def utc_stamp(seconds: Column) -> Column:
    """Epoch second as ``yyyyMMddHHmmss`` in UTC."""
    of_day = F.pmod(seconds, F.lit(DAY).cast("bigint"))
    hour = F.floor(of_day / 3600)
    minute = F.floor(F.pmod(of_day, F.lit(3600)) / 60)
    clock = hour * 10_000 + minute * 100 + F.pmod(of_day, F.lit(60))
    return F.concat(
        F.replace(utc_date(seconds).cast("string"), F.lit("-"), F.lit("")),
        F.lpad(clock.cast("string"), 6, "0"),
    )


def local_date(time: Column, zone: str = LOCAL_ZONE) -> Column:
    """Calendar date of ``time`` in ``zone`` as ``yyyy-MM-dd`` text."""
    return utc_date(epoch_seconds(F.from_utc_timestamp(time, zone))).cast("string")


def week_start(date: Column) -> Column:
    """Monday of the week that holds ``date`` (text or DATE), as DATE."""
    return F.trunc(F.to_date(date), "week")


def week_type(monday: Column, low: str, high: str) -> Column:
    """PARTIAL where the week reaches outside ``low``..``high``, else FULL."""
    outside = (monday < F.lit(low).cast("date")) | (
        F.date_add(monday, 6) > F.lit(high).cast("date")
    )
    return F.when(outside, "PARTIAL").otherwise("FULL")


def in_range(date: Column, start: str | None = None, end: str | None = None) -> Column:
    """Inclusive date-text range; a missing end is open."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (date >= start)
    if end is not None:
        keep = keep & (date <= end)
    return keep
