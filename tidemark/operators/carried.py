"""Sessions that go on where an earlier input ended.

A user's history before some second says two things about the events after it:
when the user was last active, and where the session of that event began. Both
are kept per user and date, beside the published table. Events of later dates
are labelled with the one state per user that lies within ``gap`` of them, so
no earlier event is read again.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import DAY, LOCAL_ZONE, local_date
from tidemark.operators.sessions import SESSION_GAP, TIME, USER, _cell, _labelled, activity_cells, session_start
from tidemark.schema import DATE, SESSION_ID

STATE = (
    f"{USER} bigint, first_second bigint, first_start bigint, last_second bigint, last_start bigint,"
    f" started bigint, {DATE} string"
)


def _start_second() -> Column:
    """The epoch second that a session ID tells."""
    stamp = F.substring_index(SESSION_ID, "_", -1)
    part = lambda at, n: F.substring(stamp, at, n)
    of_day = part(9, 2).cast("bigint") * 3600 + part(11, 2).cast("bigint") * 60 + part(13, 2).cast("bigint")
    day = F.to_date(F.concat_ws("-", part(1, 4), part(5, 2), part(7, 2)))
    return F.unix_date(day).cast("bigint") * DAY + of_day


def reach(day: str, gap: int, sign: int) -> str:
    """The last date whose events can be within ``gap`` of ``day``'s, later ones
    with ``sign`` 1 and earlier ones with -1."""
    # Events of dates n days apart are more than n - 1 days apart.
    days = -(-gap // DAY)
    return (date.fromisoformat(day) + timedelta(days=sign * days)).isoformat()


def session_state(labelled: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Per user and date of labelled events: the first and last active second,
    the second each of the two events' sessions began, and how many sessions
    began (``started``) on the date."""
    seen = (
        labelled.where(F.col(SESSION_ID).isNotNull())
        .groupBy(USER, DATE, _start_second().alias("start"))
        .agg(F.min(F.unix_seconds(TIME)).alias("first"), F.max(F.unix_seconds(TIME)).alias("last"))
    )
    begun = local_date(F.timestamp_seconds("start"), zone) == F.col(DATE)
    return (
        seen.groupBy(USER, DATE)
        .agg(
            F.min("first").alias("first_second"),
            F.min("start").alias("first_start"),
            F.max("last").alias("last_second"),
            F.max("start").alias("last_start"),
            F.count_if(begun).alias("started"),
        )
        .select(USER, "first_second", "first_start", "last_second", "last_start", "started", DATE)
    )


def carried(state: DataFrame, before: str, gap: int = SESSION_GAP) -> DataFrame:
    """Per user the latest state ahead of the date ``before``, as far as it can
    reach it. Reads only the dates within ``gap``."""
    near = state.where((F.col(DATE) < before) & (F.col(DATE) >= reach(before, gap, -1)))
    latest = F.max_by(F.struct("last_second", "last_start"), "last_second").alias("state")
    return near.groupBy(USER).agg(latest).select(USER, "state.*")


def sessionize_onto(events: DataFrame, earlier: DataFrame, gap: int = SESSION_GAP) -> DataFrame:
    """Add to ``events`` the session IDs they have after the states ``earlier``
    (see :func:`carried`), all of which lie before them.

    By cell: the events go through the shuffle as two columns, and a state is
    one more row of its user, which covers the session's start to the last
    active second.
    """
    cells = activity_cells(events, gap).select(USER, "cell", "first_second", "last_second")
    states = earlier.select(
        USER,
        F.lit(None).cast("bigint").alias("cell"),  # orders first
        F.col("last_start").alias("first_second"),
        "last_second",
    )
    starts = session_start(cells.unionByName(states), "cell", "first_second", "last_second", gap)
    joined = events.withColumn("cell", _cell(gap)).join(
        starts.where(F.col("cell").isNotNull()).select(USER, "cell", "start_second"), [USER, "cell"], "left"
    )
    return _labelled(joined, events.columns)


def states_that_differ(after: DataFrame, later: DataFrame, gap: int = SESSION_GAP) -> DataFrame:
    """States of ``later`` dates whose first session is not what it is after the
    states ``after``, one per user: a session now reaches in, or from elsewhere."""
    reached = F.col("first_second") - F.col("earlier_second") < gap
    now = F.when(F.coalesce(reached, F.lit(False)), F.col("earlier_start")).otherwise(F.col("first_second"))
    ahead = after.select(
        USER, F.col("last_second").alias("earlier_second"), F.col("last_start").alias("earlier_start")
    )
    return later.join(ahead, USER, "left").where(now != F.col("first_start")).select(*later.columns)
