from __future__ import annotations

import random
from datetime import timedelta

import pytest
from timing import utc
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import sessions
from tidemark.operators.calendar import with_local_date
from tidemark.operators.skew import user_event_counts
from tidemark.schema import RAW_EVENTS
from tidemark.sources.raw import read_activity_table

NEVER_HOT, ALWAYS_HOT = {"hot_events": 10**9}, {"hot_events": 1}
WAYS = [NEVER_HOT, ALWAYS_HOT]


def ids(frame):
    return [r.generated_session_id for r in frame.orderBy("product_id").collect()]


def label(frame, way, gap=300):
    if way == "within":
        return sessions.sessionize_within(frame, frame, gap)
    return sessions.sessionize(frame, gap, **way)


@pytest.fixture(params=[NEVER_HOT, ALWAYS_HOT, "within"], ids=["window", "cell", "within"])
def way(request):
    return request.param


@pytest.mark.parametrize("seconds, count", [(299, 1), (300, 2), (301, 2)])
def test_gap_of_exactly_the_timeout_opens_a_session(events, way, seconds, count):
    later = utc("2024-01-01 00:02:11") + timedelta(seconds=seconds)
    frame = events((1, "2024-01-01 00:02:11"), (1, later.isoformat()[:19]))
    assert len(set(ids(label(frame, way)))) == count


def test_gap_counts_whole_seconds(events, way):
    frame = events((1, "2024-01-01 00:00:00.9"), (1, "2024-01-01 00:05:00.1"))
    assert ids(label(frame, way)) == ["1_20240101000000", "1_20240101000500"]


def test_equal_times_share_a_session(events, way):
    frame = events((1, "2024-01-01 10:00:00"), (1, "2024-01-01 10:00:00"))
    assert ids(label(frame, way)) == ["1_20240101100000"] * 2


def test_short_gaps_chain_over_cells(events, way):
    times = [utc("2024-01-01 00:00:00") + timedelta(seconds=299 * i) for i in range(50)]
    frame = events(*[(1, t.isoformat()[:19]) for t in times])
    assert set(ids(label(frame, way))) == {"1_20240101000000"}


def test_session_crosses_utc_midnight(events, way):
    frame = events((5, "2024-01-01 23:58:00"), (5, "2024-01-02 00:02:59"))
    assert set(ids(label(frame, way))) == {"5_20240101235800"}


def test_session_crosses_local_midnight(events, way):
    frame = events((5, "2024-01-01 14:59:59"), (5, "2024-01-01 15:00:00"))
    rows = with_local_date(label(frame, way)).orderBy("product_id").collect()
    assert [r.dt for r in rows] == ["2024-01-01", "2024-01-02"]
    assert {r.generated_session_id for r in rows} == {"5_20240101145959"}


def test_before_1970(events, way):
    frame = events((5, "1969-12-31 23:59:58.5"), (5, "1970-01-01 00:00:01"), (5, "1969-12-31 23:00:00"))
    assert ids(label(frame, way)) == ["5_19691231235958"] * 2 + ["5_19691231230000"]


def test_missing_time_or_user_gives_no_id(events, way):
    frame = events(
        (1, None), (1, "2024-01-01 00:00:00"), (None, "2024-01-01 00:00:10"), (None, None)
    )
    assert ids(label(frame, way)) == [None, "1_20240101000000", None, None]


def test_columns_and_order_are_kept(events, way):
    frame = events((1, "2024-01-01 00:00:00"))
    assert label(frame, way).columns == [*RAW_EVENTS.names, "generated_session_id"]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul", "America/New_York"])
def test_session_zone_does_not_matter(events, way, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    frame = with_local_date(label(events((3, "2019-10-01 08:00:00")), way))
    row = frame.first()
    assert (row.generated_session_id, row.dt) == ("3_20191001080000", "2019-10-01")


def brute_force(rows, gap):
    """Session start per row position, by walking each user's events in order."""
    starts, last, start = {}, {}, {}
    for i, (user, second) in sorted(enumerate(rows), key=lambda r: (r[1][1], r[0])):
        if user not in last or second - last[user] >= gap:
            start[user] = second
        last[user] = second
        starts[i] = f"{user}_{start[user]}"
    return [starts[i] for i in range(len(rows))]


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    gap=st.sampled_from([1, 7, 300, 43_200]),
    seed=st.integers(0, 2**32),
    users=st.integers(1, 5),
)
def test_every_way_equals_brute_force(spark, gap, seed, users):
    rng = random.Random(seed)
    clock, rows = dict.fromkeys(range(users), 0), []
    for _ in range(120):
        user = rng.randrange(users)
        clock[user] += rng.choice([0, 1, gap - 1, gap - 1, gap, gap + 1, rng.randrange(3 * gap + 1)])
        rows.append((user, clock[user]))
    rng.shuffle(rows)
    start = utc("2023-12-31 20:00:00")
    frame = spark.createDataFrame(
        [
            (start + timedelta(seconds=s), "view", i, None, None, None, None, u, None)
            for i, (u, s) in enumerate(rows)
        ],
        RAW_EVENTS,
    )
    expected = []
    for session in brute_force(rows, gap):
        user, second = session.split("_")
        expected.append(f"{user}_{start + timedelta(seconds=int(second)):%Y%m%d%H%M%S}")
    some_hot = {"hot_events": 120 // users, "hot_limit": 2}
    for way in (NEVER_HOT, ALWAYS_HOT, some_hot, "within"):
        assert ids(label(frame, way, gap)) == expected


@pytest.mark.parametrize("gap", [300, 43_200])
def test_ways_agree_on_the_test_data(spark, gap):
    frame = read_activity_table(spark, "/root/testdata/sf0.001")
    by_window = sessions.sessionize(frame, gap, **NEVER_HOT)
    for way in (ALWAYS_HOT, {"hot_events": 70}, "within"):
        other = label(frame, way, gap)
        assert by_window.exceptAll(other).isEmpty()
        assert other.exceptAll(by_window).isEmpty()


def test_part_of_a_history_gets_the_ids_of_the_whole(spark):
    history = with_local_date(read_activity_table(spark, "/root/testdata/sf0.001"))
    part = F.col("dt") == "2024-01-15"
    whole = sessions.sessionize(history, 43_200).where(part)
    alone = sessions.sessionize_within(history.where(part), history, 43_200)
    assert whole.exceptAll(alone).isEmpty() and alone.exceptAll(whole).isEmpty()
    assert not alone.isEmpty()


def test_rows_of_a_session_are_close_and_sessions_apart(spark):
    frame = read_activity_table(spark, "/root/testdata/sf0.001")
    gapped = sessions.gap_seconds(frame, hot_events=70)
    labelled = sessions.sessionize(frame, 43_200).join(
        gapped.select("product_id", "gap_seconds"), "product_id"
    )
    inside = F.concat("user_id", F.lit("_"), F.date_format("event_time", "yyyyMMddHHmmss"))
    first = F.col("generated_session_id") == inside
    far = sessions.new_session_flag(F.col("gap_seconds"), 43_200)
    assert labelled.where(first != far).isEmpty()
    assert labelled.count() == frame.count()


@pytest.mark.parametrize("hot", WAYS, ids=["window", "lookup"])
def test_gap_seconds(spark, hot):
    order = [
        # time, type, product; NULLs sort first among equal times
        ("2024-01-01 00:00:00.5", None, 1, None),
        ("2024-01-01 00:00:00.5", "a", 2, 0),
        ("2024-01-01 00:00:00.9", "a", 3, 0),
        ("2024-01-01 00:00:02.1", "b", None, 2),
        ("2024-01-01 00:00:02.1", "b", 4, 0),
        ("2024-01-01 00:10:02", "a", 5, 600),
    ]
    frame = spark.createDataFrame(
        [(utc(t), kind, p, i, None, None, None, 1, None) for i, (t, kind, p, _) in enumerate(order)]
        + [(None, "a", 9, 90, None, None, None, 1, None)]
        + [(utc("2024-01-01 00:00:01"), "a", 9, 91, None, None, None, None, None)],
        RAW_EVENTS,
    )
    rows = sessions.gap_seconds(frame, **hot).orderBy("category_id").collect()
    assert [r.gap_seconds for r in rows] == [g for *_, g in order] + [None, None]


@pytest.mark.parametrize("hot", WAYS, ids=["window", "lookup"])
def test_of_exact_copies_one_carries_the_silence(spark, hot):
    row = ("view", 1, 7, None, None, 1.0, 5, None)
    times = ["2024-01-01 00:00:00", *["2024-01-01 00:10:00"] * 3, "2024-01-01 00:10:01"]
    frame = spark.createDataFrame([(utc(t), *row) for t in times], RAW_EVENTS)
    gaps = [r.gap_seconds for r in sessions.gap_seconds(frame, **hot).collect()]
    assert sorted(gaps, key=lambda g: (g is not None, g)) == [None, 0, 0, 1, 600]


def test_an_order_that_does_not_begin_with_the_time_is_refused(events):
    with pytest.raises(ValueError, match="event_time"):
        sessions.gap_seconds(events((1, "2024-01-01 00:00:00")), order=("product_id",))


def test_hot_list_is_bounded_and_takes_the_busiest(events):
    with pytest.raises(ValueError, match="broadcast"):
        sessions.hot_users(events((1, "2024-01-01 00:00:00")), 1, sessions.HOT_USERS + 1)
    rows = [(u, "2024-01-01 00:00:00") for u in range(10) for _ in range(u + 1)]
    counts = user_event_counts(events(*rows, *[(None, "2024-01-01 00:00:00")] * 20))
    assert [r.user_id for r in sessions.hot_users(counts, 4, 3).collect()] == [9, 8, 7]
    assert sessions.hot_users(counts, 9, 100).count() == 2


def plan_of(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot_cell(spark):
    """A third of 60,000 events are one user's within five minutes."""
    n = F.col("id")
    hot = n % 3 == 0
    second = F.when(hot, n % 290).otherwise(n * 37 % 2_000_000)
    return spark.range(0, 60_000, 1, 16).select(
        F.timestamp_seconds(second + 1_704_067_200).alias("event_time"),
        F.lit("view").alias("event_type"),
        n.cast("int").alias("product_id"),
        F.xxhash64("id").alias("category_id"),
        F.lit(None).cast("string").alias("category_code"),
        F.sha2(n.cast("string"), 256).alias("brand"),
        F.lit(1.0).alias("price"),
        F.when(hot, 7).otherwise(1000 + n % 2000).alias("user_id"),
        F.lit(None).cast("string").alias("user_session"),
    )


def test_hot_cell_is_split_over_tasks(hot_cell, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="64",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128k",
    )
    labelled = sessions.sessionize_within(hot_cell, hot_cell)
    assert "SortMergeJoin(skew=true)" in plan_of(labelled)
    assert labelled.exceptAll(sessions.sessionize(hot_cell, **NEVER_HOT)).isEmpty()


def test_hot_user_reaches_no_window_as_events(hot_cell):
    cells = sessions.activity_cells(hot_cell.where("user_id = 7"))
    assert cells.count() == 1
    routed = sessions.sessionize(hot_cell, hot_events=5_000)
    assert routed.count() == 60_000
    assert routed.exceptAll(sessions.sessionize(hot_cell, **NEVER_HOT)).isEmpty()


def test_without_hot_users_only_one_shuffle_of_events_remains(hot_cell):
    plan = plan_of(sessions.sessionize(hot_cell, hot_events=10**6))
    final = plan.split("+- == Initial Plan ==")[0]
    assert "SortMergeJoin" not in final
    wide = [line for line in final.splitlines() if "Exchange hashpartitioning(user_id" in line]
    assert len(wide) <= 2  # the events, and the counts of hot_users


def test_cross_day_sessions(events):
    frame = with_local_date(
        sessions.sessionize(
            events(
                (5, "2024-01-01 14:59:59"),
                (5, "2024-01-01 15:00:00"),
                (6, "2024-01-01 14:59:59"),
                (None, "2024-01-01 15:00:00"),
            )
        )
    )
    assert [tuple(r) for r in sessions.cross_day_sessions(frame).collect()] == [
        ("5_20240101145959", "2024-01-01", "2024-01-02", 2)
    ]
