from __future__ import annotations

import pytest
from timing import utc

from tidemark.operators import ledger
from tidemark.schema import LEDGER
from tidemark.sources.ledger_store import LedgerStore

DAY = "2024-01-01"
START, END = utc("2024-02-01 00:00:00"), utc("2024-02-01 01:00:00")


@pytest.fixture
def store(spark, tmp_path):
    store = LedgerStore.at(f"file://{tmp_path}/ledger")
    store.create(spark)
    return store


def of(spark, column, kind, **values):
    rows = [(d.replace("_", "-").removeprefix("d"), v) for d, v in values.items()]
    return spark.createDataFrame(rows, f"partition_date string, {column} {kind}")


def dates(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "partition_date string")


def state(store, spark, day=DAY):
    return store.current(spark).where(f"partition_date = '{day}'").first()


def test_new_store_is_empty_and_creating_again_keeps_rows(store, spark):
    assert store.current(spark).isEmpty() and store.next_seq(spark) == 1
    store.append(ledger.begin(dates(spark, DAY), "r1", START, 1))
    store.create(spark)
    assert store.log(spark).schema == LEDGER
    assert store.log(spark).count() == 1 and store.next_seq(spark) == 2


def test_life_of_a_date(store, spark):
    store.append(ledger.begin(dates(spark, DAY), "r1", START, 1))
    row = state(store, spark)
    assert (row.status, row.run_id, row.end_time, row["record_count"], row.error_message) == (
        "IN_PROGRESS", "r1", None, None, None
    )
    store.append(ledger.succeed(store.current(spark), of(spark, "record_count", "bigint", d2024_01_01=7), END, 2))
    row = state(store, spark)
    assert (row.status, row.run_id, row["record_count"], row.error_message) == ("SUCCESS", "r1", 7, None)
    assert row.end_time > row.start_time
    store.append(ledger.fail(store.current(spark), of(spark, "error_message", "string", d2024_01_01="gone"), END, 3))
    row = state(store, spark)
    assert (row.status, row.run_id, row["record_count"], row.error_message) == ("FAILED", "r1", 7, "gone")
    store.append(ledger.begin(dates(spark, DAY), "r2", END, 4))
    row = state(store, spark)
    assert (row.status, row.run_id, row.end_time, row["record_count"], row.error_message) == (
        "IN_PROGRESS", "r2", None, None, None
    )
    assert store.log(spark).count() == 4


def test_unknown_dates_are_not_closed(store, spark):
    current = store.current(spark)
    assert ledger.succeed(current, of(spark, "record_count", "bigint", d2024_01_01=1), END, 1).isEmpty()
    assert ledger.fail(current, of(spark, "error_message", "string", d2024_01_01="x"), END, 1).isEmpty()


@pytest.mark.parametrize("text, kept", [("x" * 1001, 1000), ("x" * 1000, 1000), ("x", 1), (None, None)])
def test_error_text_is_cut(store, spark, text, kept):
    store.append(ledger.begin(dates(spark, DAY), "r1", START, 1))
    errors = spark.createDataFrame([(DAY, text)], "partition_date string, error_message string")
    store.append(ledger.fail(store.current(spark), errors, END, 2))
    message = state(store, spark).error_message
    assert (None if message is None else len(message)) == kept


@pytest.mark.parametrize(
    "status, recorded, there, action, sizes_ignored",
    [
        (None, None, None, "BUILD", "BUILD"),
        (None, None, 5, "BUILD", "BUILD"),
        ("SUCCESS", 5, 5, "SKIP", "SKIP"),
        ("SUCCESS", 4, 4, "REBUILD_GREW", "SKIP"),
        ("SUCCESS", None, 5, "REBUILD_GREW", "SKIP"),
        ("SUCCESS", 5, None, "REBUILD_MISSING", "REBUILD_MISSING"),
        ("IN_PROGRESS", None, 5, "REBUILD_STALE", "REBUILD_STALE"),
        ("IN_PROGRESS", None, None, "REBUILD_STALE", "REBUILD_STALE"),
        ("FAILED", None, 5, "REBUILD_FAILED", "REBUILD_FAILED"),
        ("ODD", None, 5, "BUILD", "BUILD"),
    ],
)
def test_plan(spark, status, recorded, there, action, sizes_ignored):
    counts = "dt string, record_count bigint"
    targets = spark.createDataFrame([(DAY, 5)], counts)
    published = spark.createDataFrame([] if there is None else [(DAY, there)], counts)
    rows = [] if status is None else [(DAY, status, "r1", START, None, recorded, None, 1, None)]
    current = ledger.current(spark.createDataFrame(rows, LEDGER))
    for detect, expected in ((True, action), (False, sizes_ignored)):
        plan = ledger.plan(targets, current, published, detect).collect()
        assert [r.action for r in plan] == [expected]


@pytest.mark.parametrize(
    "recorded, found, action",
    [("a", "a", "SKIP"), ("a", "b", "REBUILD_CHANGED"), (None, "b", "SKIP"), ("a", None, "SKIP")],
)
def test_plan_sees_other_rows_of_equal_number(spark, recorded, found, action):
    targets = spark.createDataFrame([(DAY, 5, found)], "dt string, record_count bigint, content string")
    published = spark.createDataFrame([(DAY, 5)], "dt string, record_count bigint")
    row = (DAY, "SUCCESS", "r1", START, None, 5, None, 1, recorded)
    current = ledger.current(spark.createDataFrame([row], LEDGER))
    assert [r.action for r in ledger.plan(targets, current, published).collect()] == [action]
    assert [r.action for r in ledger.plan(targets, current, published, False).collect()] == ["SKIP"]


def test_a_folded_log_has_the_latest_change_of_every_date(store, spark, monkeypatch):
    other = "2024-01-02"
    store.append(ledger.begin(dates(spark, DAY, other), "r1", START, 1))
    store.append(ledger.succeed(store.current(spark), of(spark, "record_count", "bigint", d2024_01_01=7), END, 2))
    before = sorted(store.current(spark).collect())
    with monkeypatch.context() as lost:  # the driver goes after the new file is there
        lost.setattr("tidemark.sources.ledger_store.remove_files", lambda spark, paths: 0)
        store.fold(spark)
    assert store.log(spark).count() == 5 and sorted(store.current(spark).collect()) == before
    assert store.fold(spark) > 1
    assert sorted(store.log(spark).collect()) == before and store.next_seq(spark) == 3
    assert store.fold(spark) == 0
    store.append(ledger.begin(dates(spark, other), "r2", END, store.next_seq(spark)))
    assert state(store, spark, other).run_id == "r2" and state(store, spark).status == "SUCCESS"


def test_an_empty_log_and_one_in_a_path_with_spaces_fold(spark, tmp_path):
    store = LedgerStore.at(f"file://{tmp_path}/my ledger%20x")
    store.create(spark)
    store.fold(spark)
    assert store.current(spark).isEmpty()
    for seq in (1, 2):
        store.append(ledger.begin(dates(spark, DAY), f"r{seq}", START, seq))
    assert store.fold(spark) >= 2
    assert [r.run_id for r in store.log(spark).collect()] == ["r2"]
    with pytest.raises(ValueError):
        LedgerStore("jdbc", {}).fold(spark)
