from __future__ import annotations

from datetime import date, timedelta

import pytest
from timing import utc
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators import calendar, metrics, skew
from tidemark.plans.weekly import sessionized_events


def test_stamp_and_local_date_equal_date_format_in_utc(spark):
    times = spark.range(-400, 4000, 1).select(
        F.timestamp_seconds(F.col("id") * 333_667 + 1).alias("t")
    )
    plain = F.from_utc_timestamp("t", "Asia/Seoul")
    wrong = times.where(
        (clock.utc_stamp(clock.epoch_seconds(F.col("t"))) != F.date_format("t", "yyyyMMddHHmmss"))
        | (clock.local_date(F.col("t")) != F.date_format(plain, "yyyy-MM-dd"))
    )
    assert wrong.isEmpty()


def test_local_date_follows_daylight_saving_of_its_zone(spark):
    frame = spark.createDataFrame(
        [(utc("2024-03-10 04:59:59"),), (utc("2024-07-01 03:59:59"),), (utc("2024-07-01 04:00:00"),)],
        "t timestamp",
    )
    dates = frame.select(clock.local_date(F.col("t"), "America/New_York")).collect()
    assert [r[0] for r in dates] == ["2024-03-09", "2024-06-30", "2024-07-01"]


def test_week_starts_on_monday_for_every_day(spark):
    first = date(2019, 1, 1)
    days = [first + timedelta(days=i) for i in range(2192)]
    frame = spark.createDataFrame([(str(d),) for d in days], "dt string")
    rows = frame.select("dt", clock.week_start(F.col("dt")).alias("w")).collect()
    for row in rows:
        day = date.fromisoformat(row.dt)
        assert row.w == day - timedelta(days=day.weekday())


@pytest.mark.parametrize(
    "monday, kind",
    [
        ("2019-09-23", "PARTIAL"),
        ("2019-09-30", "PARTIAL"),
        ("2019-10-07", "FULL"),
        ("2019-11-25", "FULL"),  # ends on the upper bound itself
        ("2019-12-02", "PARTIAL"),
    ],
)
def test_week_type_with_default_bounds(spark, monday, kind):
    column = clock.week_type(F.lit(monday).cast("date"), *clock.WEEK_BOUNDS)
    assert spark.range(1).select(column).first()[0] == kind


@pytest.mark.parametrize(
    "start, end, kept", [(None, None, 3), ("2024-01-02", None, 2), (None, "2024-01-02", 2), ("2024-01-02", "2024-01-02", 1)]
)
def test_range_is_inclusive_and_open_where_missing(spark, start, end, kept):
    frame = spark.createDataFrame([("2024-01-03",), ("2024-01-01",), ("2024-01-02",)] * 2, "dt string")
    dates = [r.dt for r in calendar.target_dates(frame, start, end).collect()]
    assert len(dates) == kept and dates == sorted(dates)
    assert calendar.date_range(frame, start, end).count() == 2 * kept


def test_date_slice_drops_the_date(spark):
    frame = spark.createDataFrame([("2024-01-03", 1), ("2024-01-01", 2)], "dt string, v int")
    assert [tuple(r) for r in calendar.date_slice(frame, "2024-01-01").collect()] == [(2,)]


def test_event_time_is_untouched(events):
    frame = events((1, "2024-01-01 16:00:00.25"))
    assert calendar.with_local_date(frame).first().event_time == frame.first().event_time


def test_wau_counts_distinct_non_null_and_splits_weeks(spark):
    rows = [
        ("2024-01-07", 1, "1_a"),  # Sunday
        ("2024-01-08", 1, "1_a"),  # Monday, same session: counts in both weeks
        ("2024-01-08", 1, "1_b"),
        ("2024-01-09", 2, "2_a"),
        ("2024-01-09", 2, "2_a"),
        ("2024-01-09", None, None),
    ]
    frame = spark.createDataFrame(rows, "dt string, user_id bigint, generated_session_id string")
    result = metrics.wau(frame, "2024-01-01", "2024-01-13")
    assert [f.dataType.simpleString() for f in result.schema] == ["date", "bigint", "bigint", "string"]
    assert [tuple(r) for r in result.collect()] == [
        (date(2024, 1, 1), 1, 1, "FULL"),
        (date(2024, 1, 8), 2, 3, "PARTIAL"),
    ]


def test_wau_scans_two_columns_of_the_published_table(spark, tmp_path, events):
    from tidemark.sources import publish

    path = f"file://{tmp_path}/t"
    publish.write_dates(sessionized_events(events((1, "2024-01-01 00:00:00"))), path)
    plan = metrics.wau(publish.read_events(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint,generated_session_id:string>" in plan
    assert plan.count("FileScan") == 1


def test_partition_stats(spark):
    rows = [
        ("2024-01-01", 5, "view", "5_a"),
        ("2024-01-01", 5, "view", "5_a"),
        ("2024-01-01", 3, None, "3_a"),
        ("2024-01-01", None, "cart", None),
        ("2024-01-02", None, None, None),
    ]
    frame = spark.createDataFrame(
        rows, "dt string, user_id bigint, event_type string, generated_session_id string"
    )
    one, two = metrics.partition_stats(frame).orderBy("dt").collect()
    assert one.asDict() == {
        "dt": "2024-01-01",
        "row_count": 4,
        "user_id_distinct": 2,
        "user_id_nulls": 1,
        "user_id_min": 3,
        "user_id_max": 5,
        "event_type_distinct": 2,
        "event_type_nulls": 1,
        "generated_session_id_distinct": 2,
        "generated_session_id_nulls": 1,
    }
    assert (two.row_count, two.user_id_distinct, two.user_id_nulls, two.user_id_max) == (1, 0, 1, None)


def test_skew_report(events):
    frame = events(*[(u, "2024-01-01 00:00:00") for u in [1] * 3 + [2] * 5 + [3] * 3 + [None] * 4])
    assert [tuple(r) for r in skew.top_users(frame, 3).collect()] == [(2, 5), (None, 4), (1, 3)]
    assert {r.user_id for r in skew.skewed_users(frame, 3).collect()} == {1, 2, 3, None}
    assert skew.skewed_user_count(frame, 4).first()[0] == 2
    assert skew.skewed_user_count(frame, 6).first()[0] == 0
    plan = skew.top_users(frame)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
