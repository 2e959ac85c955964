"""Weekly counts from what single dates keep, without reading events again.

Distinct users of a week are united from one bitmap per date and range of user
numbers, exactly. Sessions need no distinct count at all: those of a week are
the ones that began on its dates, and, per user, the one that reached in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import LOCAL_ZONE, local_date, week_start
from tidemark.operators.sessions import USER
from tidemark.schema import DATE


def user_bitmaps(dated: DataFrame) -> DataFrame:
    """``dt, bucket, users``: per date the users that occur, as bitmaps of 32,768
    numbers each. NULL users are left out, as distinct counts do."""
    return (
        dated.where(F.col(USER).isNotNull() & F.col(DATE).isNotNull())
        .groupBy(DATE, F.bitmap_bucket_number(USER).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(USER)).alias("users"))
    )


def users_per_week(bitmaps: DataFrame) -> DataFrame:
    """``week_start, wau_by_user``: the bitmaps of a week's dates united and
    counted. A range of users is one group, so a week is many tasks."""
    weeks = bitmaps.groupBy(week_start(F.col(DATE)).alias("week_start"), "bucket").agg(
        F.bitmap_or_agg("users").alias("users")
    )
    return weeks.groupBy("week_start").agg(F.sum(F.bitmap_count("users")).alias("wau_by_user"))


def sessions_per_week(states: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """``week_start, wau_by_session`` from the states of users and dates (see
    :func:`tidemark.operators.carried.session_state`).

    A session that began on a date of the week is counted on that date. One that
    reaches in from before is the first of its user there; it may lie on several
    dates, so those users are counted once a week.
    """
    monday = week_start(F.col(DATE))
    began = week_start(local_date(F.timestamp_seconds("first_start"), zone))
    weekly = states.select(
        monday.alias("week_start"), "started", F.when(began < monday, F.col(USER)).alias("reached_by")
    )
    own = weekly.groupBy("week_start").agg(F.sum("started").alias("started"))
    reaching = (
        weekly.where(F.col("reached_by").isNotNull())
        .select("week_start", "reached_by")
        .distinct()
        .groupBy("week_start")
        .agg(F.count("*").alias("reached"))
    )
    total = F.col("started") + F.coalesce("reached", F.lit(0))
    return own.join(reaching, "week_start", "left").select("week_start", total.alias("wau_by_session"))
