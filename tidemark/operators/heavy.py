"""The busiest users without counting every user.

Users are hashed into buckets, and a bucket's events bound those of any user in
it. Bucket counts shrink to ``BUCKETS`` rows per task ahead of the shuffle, however
many users there are. The users of the fullest buckets are counted exactly; the
n-th of them is a bar, and only buckets that hold as many events as the bar can
hide a user who belongs on the list. Those are counted as well, and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import TOP_USERS, busiest, user_event_counts

BUCKETS = 65_536
# Buckets whose users are counted first.
FULLEST = 256


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")


def bucket_counts(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Events per bucket of users; such counts of parts of the events add up."""
    return events.groupBy(_bucket(buckets).alias("bucket")).agg(F.count("*").alias("bucket_count"))


def top_users(
    events: DataFrame, n: int = TOP_USERS, buckets: int = BUCKETS, fullest: int = FULLEST
) -> DataFrame:
    """``user_id, event_count`` of the ``n`` busiest users, exactly; equal counts
    in order of the user. A NULL user is one, as in ``skew.top_users``.

    Where counts are so even that most buckets reach the bar, most users are
    counted, which is what counting all of them costs.
    """
    # At most ``buckets`` rows.
    full = bucket_counts(events, buckets).orderBy(F.desc("bucket_count"), "bucket").collect()
    first = [row["bucket"] for row in full[:fullest]]
    counted = busiest(user_event_counts(events.where(_bucket(buckets).isin(first))), n).collect()
    bar = counted[-1]["event_count"] if len(counted) == n else 0
    others = [row["bucket"] for row in full[fullest:] if row["bucket_count"] >= bar]
    found = events.sparkSession.createDataFrame(counted, "user_id bigint, event_count bigint")
    if others:
        wanted = events.sparkSession.createDataFrame([(b,) for b in others], "bucket int")
        rest = events.withColumn("bucket", _bucket(buckets)).join(F.broadcast(wanted), "bucket", "left_semi")
        found = found.unionByName(user_event_counts(rest))
    return busiest(found, n)
