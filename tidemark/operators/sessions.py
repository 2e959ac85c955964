"""Gap sessionization that no single user can overload.

A session is a run of one user's events in which each event follows the one
before by less than ``gap`` whole seconds. There are two exact ways to find it:

*By window.* Partition by user, order by time, look one row back, carry the
latest start forward. One shuffle of the events; but a user's whole history is
one task's work.

*By cell.* Cut time into cells of exactly ``gap`` seconds. Two events of a user
in one cell are less than ``gap`` apart, so a cell never straddles two sessions
and its first and last second say everything about it. Group by (user, cell) to
those two numbers, run the window over a user's cells, and join the session
start back to the events on (user, cell). The grouping is partially done before
the shuffle, so copies and hot users shrink on the map side; a user has at most
``time span / gap`` cells (105,120 a year at 300 s) however many events; each
cell is one row on the right of the join, so rows never multiply, and a hot
(user, cell) on the left is split by adaptive skew handling.

:func:`sessionize` sends the few users with very many events by cell and all
others by window. :func:`sessionize_within` goes by cell for everyone: it labels
a subset of the events as if the whole history were labelled, and moves the
history through the shuffle as two columns only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import epoch_seconds, floor_to, utc_stamp
from tidemark.operators.skew import at_least, busiest, user_event_counts
from tidemark.schema import DATE, SESSION_ID

# Fixed values.
SESSION_GAP = 300
EVENT_ORDER = ("event_time", "event_type", "product_id")

# Users with HOT_EVENTS events or more go by cell, the HOT_USERS busiest of them
# if there are more. So the list is at most HOT_USERS numbers, small enough to
# broadcast, and among N events a user that is not on it has fewer than
# max(HOT_EVENTS, N / HOT_USERS).
HOT_EVENTS = 1_000_000
HOT_USERS = 100_000

USER, TIME = "user_id", "event_time"


def new_session_flag(gap_seconds: Column, gap: int = SESSION_GAP) -> Column:
    """True for a user's first event and after a silence of ``gap`` or more."""
    return gap_seconds.isNull() | (gap_seconds >= gap)


def session_id(user: Column, start_second: Column) -> Column:
    """``{user}_{yyyyMMddHHmmss}``; NULL if either part is."""
    return F.concat(user.cast("string"), F.lit("_"), utc_stamp(start_second))


def _second() -> Column:
    return epoch_seconds(F.col(TIME))


def _cell(gap: int) -> Column:
    return floor_to(_second(), gap)


def _identified() -> Column:
    """Whether an event can belong to a session: it has a user and a time."""
    return F.col(USER).isNotNull() & F.col(TIME).isNotNull()


def _labelled(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    return events.select(
        *columns, session_id(F.col(USER), F.col("start_second")).alias(SESSION_ID)
    )


def hot_users(
    user_counts: DataFrame, hot_events: int = HOT_EVENTS, limit: int = HOT_USERS
) -> DataFrame:
    """Users to keep out of per-user windows; never more than ``limit`` rows."""
    if not 0 < limit <= HOT_USERS:
        raise ValueError(f"the list of hot users is broadcast: at most {HOT_USERS} fit")
    known = user_counts.where(F.col(USER).isNotNull())
    return busiest(at_least(known, hot_events), limit).select(USER)


def _by_heat(
    events: DataFrame, user_counts: DataFrame | None, hot_events: int, limit: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split events into those of ordinary users, of hot users, and of neither."""
    if user_counts is None:
        user_counts = user_event_counts(events)
    # One partition behind a shuffle of its own: the list is complete before the
    # time limit of the broadcast starts, however long the counting takes.
    hot = F.broadcast(hot_users(user_counts, hot_events, limit).repartition(1))
    known = events.where(_identified())
    return (
        known.join(hot, USER, "left_anti"),
        known.join(hot, USER, "left_semi"),
        events.where(~_identified()),
    )


def session_start(
    ordered: DataFrame, order: str, first: str, last: str, gap: int
) -> DataFrame:
    """Add ``start_second`` to rows that each cover ``first``..``last`` seconds
    of one user's activity, going by ``order``."""
    by_user = Window.partitionBy(USER).orderBy(order)
    so_far = by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.when(new_session_flag(F.col("silence"), gap), F.col(first))
    return (
        ordered.withColumn("silence", F.col(first) - F.lag(last).over(by_user))
        .withColumn("opened", opened)
        .withColumn("start_second", F.last("opened", ignorenulls=True).over(so_far))
    )


def activity_cells(events: DataFrame, gap: int = SESSION_GAP) -> DataFrame:
    """First and last active second of every (user, cell)."""
    return (
        events.where(_identified())
        .groupBy(USER, _cell(gap).alias("cell"))
        .agg(F.min(_second()).alias("first_second"), F.max(_second()).alias("last_second"))
    )


def _label_by_window(events: DataFrame, gap: int) -> DataFrame:
    # Events at one time need no further order: a gap of zero opens nothing.
    seconds = events.withColumn("second", _second())
    return _labelled(session_start(seconds, TIME, "second", "second", gap), events.columns)


def session_cells(history: DataFrame, gap: int = SESSION_GAP) -> DataFrame:
    """``user_id, cell, start_second``: when the session of a cell's events began.

    Moves the whole history; keep it where several parts of one history are
    labelled with :func:`sessionize_by`.
    """
    cells = activity_cells(history, gap)
    starts = session_start(cells, "cell", "first_second", "last_second", gap)
    return starts.select(USER, "cell", "start_second")


def sessionize_by(events: DataFrame, cells: DataFrame, gap: int = SESSION_GAP) -> DataFrame:
    """Add to ``events`` the session IDs that ``cells`` (see :func:`session_cells`,
    with the same ``gap``) give them; cells without these events do not matter."""
    joined = events.withColumn("cell", _cell(gap)).join(cells, [USER, "cell"], "left")
    return _labelled(joined, events.columns)


def _label_by_cell(events: DataFrame, history: DataFrame, gap: int) -> DataFrame:
    return sessionize_by(events, session_cells(history, gap), gap)


def sessionize(
    events: DataFrame,
    gap: int = SESSION_GAP,
    user_counts: DataFrame | None = None,
    hot_events: int = HOT_EVENTS,
    hot_limit: int = HOT_USERS,
) -> DataFrame:
    """Add the session ID to every event.

    An event without a user or a time is kept, with a NULL ID. Pass
    ``user_counts`` if the events per user are known already. It and the limits
    only choose how a user's sessions are found, never what they are.
    """
    ordinary, hot, unidentified = _by_heat(events, user_counts, hot_events, hot_limit)
    return (
        _label_by_window(ordinary, gap)
        .unionByName(_label_by_cell(hot, hot, gap))
        .unionByName(unidentified.withColumn(SESSION_ID, F.lit(None).cast("string")))
        .select(*events.columns, SESSION_ID)
    )


def sessionize_within(
    events: DataFrame, history: DataFrame, gap: int = SESSION_GAP
) -> DataFrame:
    """Add to ``events`` the session IDs they have within ``history``.

    For labelling a part of the history, such as some dates. ``events`` must be
    contained in ``history``; one without a user or a time gets a NULL ID.
    """
    return _label_by_cell(events, history, gap)


def gap_seconds(
    events: DataFrame,
    order: Sequence[str] = EVENT_ORDER,
    user_counts: DataFrame | None = None,
    hot_events: int = HOT_EVENTS,
    hot_limit: int = HOT_USERS,
) -> DataFrame:
    """Add ``gap_seconds``: whole seconds since the user's previous event.

    NULL for a user's first event, and where the user or the time is missing.
    Events are ordered by ``order``, which must begin with the time, within a
    user, NULLs first; events equal in it by their other columns. Of exact
    copies one carries the silence before them and the others have none, so the
    rows are the same whichever way a user goes.

    Hot users' copies are counted rather than listed; the window runs over
    their distinct seconds, and the first event of a second looks its gap up.
    """
    if not order or order[0] != TIME:
        raise ValueError(f"the order must begin with {TIME}")
    ordinary, hot, unidentified = _by_heat(events, user_counts, hot_events, hot_limit)
    whole_order = [*order, *[c for c in events.columns if c not in order and c != USER]]
    by_order = Window.partitionBy(USER).orderBy(*whole_order)
    by_window = ordinary.withColumn("second", _second()).withColumn(
        "gap_seconds", F.col("second") - F.lag("second").over(by_order)
    )

    key = F.struct(*whole_order)
    by_second = Window.partitionBy(USER).orderBy("second")
    distinct = hot.groupBy(*events.columns).agg(F.count("*").alias("copies"))
    seconds = (
        distinct.groupBy(USER, _second().alias("second"))
        .agg(F.min(key).alias("head"))
        .withColumn("silence", F.col("second") - F.lag("second").over(by_second))
    )
    is_head = key.eqNullSafe(F.col("head")) & (F.col("copy") == 1)
    by_lookup = (
        distinct.withColumn("second", _second())
        .join(seconds, [USER, "second"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        .withColumn("gap_seconds", F.when(is_head, F.col("silence")).otherwise(0))
    )

    columns = [*events.columns, "gap_seconds"]
    return (
        by_window.select(*columns)
        .unionByName(by_lookup.select(*columns))
        .unionByName(
            unidentified.withColumn("gap_seconds", F.lit(None).cast("bigint")).select(*columns)
        )
    )


def cross_day_sessions(published: DataFrame) -> DataFrame:
    """Sessions whose events lie on more than one local date."""
    return (
        published.where(F.col(SESSION_ID).isNotNull())
        .groupBy(SESSION_ID)
        .agg(
            F.min(DATE).alias("first_dt"),
            F.max(DATE).alias("last_dt"),
            F.count("*").alias("event_count"),
        )
        .where(F.col("first_dt") < F.col("last_dt"))
    )
