"""Folders that follow one another, versions, manifests, claims, and daily states."""

from __future__ import annotations

import random
import uuid
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

from tidemark.operators import carried, content, heavy, ledger, mergeable, metrics, scan, sessions, skew
from tidemark.operators.calendar import with_local_date
from tidemark.plans import extend, pipeline
from tidemark.schema import DATE, RAW_EVENTS
from tidemark.sources import catalog, claims, publish, raw, versions
from tidemark.sources.ledger_store import LedgerStore

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"


@pytest.fixture(autouse=True)
def narrow(conf):
    """Small tables need few tasks."""
    conf(spark__sql__shuffle__partitions="2")


class Table:
    def __init__(self, spark, root: Path):
        self.spark, self.root, self.turn = spark, root, 0
        self.output = f"file://{root}/out"
        self.store = LedgerStore.at(f"file://{root}/ledger")

    def add(self, *rows, gap: int = 300, lines: str = ""):
        """A folder of (user, UTC time) pairs, taken in."""
        self.turn += 1
        folder = self.root / f"in{self.turn}"
        folder.mkdir()
        body = "".join(f"{t},view,{i},5,c,b,1.5,{u},s\n" for i, (u, t) in enumerate(rows))
        (folder / "a.csv").write_text(HEADER + body + lines)
        return extend.extend(
            self.spark,
            input_dir=f"file://{folder}",
            output_dir=self.output,
            store=self.store,
            checkpoint_dir=f"file://{self.root}/checkpoint",
            gap=gap,
        )

    def ids(self):
        rows = versions.read_manifest(self.spark, self.output).collect()
        return sorted((r.dt, r.generated_session_id or "") for r in rows)


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, tmp_path)


def test_sessions_go_on_over_the_edge_of_folders(table):
    table.add(("1", "2019-10-31 14:58:00 UTC"), ("2", "2019-10-31 14:00:00 UTC"))
    done = table.add(("1", "2019-10-31 15:01:00 UTC"), ("2", "2019-10-31 15:01:00 UTC"))
    assert (done.written, done.relabelled, done.unchanged) == (["2019-11-01"], [], [])
    assert table.ids() == [
        ("2019-10-31", "1_20191031145800"), ("2019-10-31", "2_20191031140000"),
        ("2019-11-01", "1_20191031145800"), ("2019-11-01", "2_20191031150100"),
    ]


def test_a_shared_date_gets_the_rows_of_both_and_a_second_delivery_adds_nothing(table):
    table.add(("1", "2019-10-31 23:59:00 UTC"), ("1", "2019-10-31 23:59:00 UTC"))
    rows = [("1", "2019-11-01 00:01:00 UTC"), ("3", "2019-11-01 05:00:00 UTC")]
    assert table.add(*rows).written == ["2019-11-01"]
    expected = [("2019-11-01", "1_20191031235900")] * 3 + [("2019-11-01", "3_20191101050000")]
    assert table.ids() == expected
    again = table.add(*rows)
    assert (again.written, again.unchanged) == ([], ["2019-11-01"])
    assert table.ids() == expected
    state = table.store.current(table.spark).collect()
    assert [(r.partition_date, r.status, r["record_count"]) for r in state] == [("2019-11-01", "SUCCESS", 4)]


def test_late_folder_renames_later_dates_as_far_as_it_goes(table):
    gap = 26 * 3600
    days = [("1", f"2019-10-{d:02} 15:30:00 UTC") for d in range(2, 7)]
    table.add(*days, ("2", "2019-10-03 16:00:00 UTC"), ("3", "2019-10-09 16:00:00 UTC"), gap=gap)
    done = table.add(("1", "2019-10-01 15:10:00 UTC"), gap=gap)
    assert done.written == ["2019-10-02"]
    assert done.relabelled == [f"2019-10-{d:02}" for d in range(3, 8)]
    assert [i for _, i in table.ids() if i.startswith("1_")] == ["1_20191001151000"] * 6


def test_a_change_passes_over_dates_of_other_users(table):
    gap = 2 * 86_400
    table.add(("1", "2019-10-01 05:00:00 UTC"), ("2", "2019-10-02 05:00:00 UTC"), ("1", "2019-10-03 04:00:00 UTC"), gap=gap)
    done = table.add(("1", "2019-10-01 01:00:00 UTC"), gap=gap)
    assert (done.written, done.relabelled) == (["2019-10-01"], ["2019-10-03"])
    assert [i for _, i in table.ids() if i.startswith("1_")] == ["1_20191001010000"] * 3


def test_any_cut_of_the_events_gives_the_same_sessions(table, spark, events):
    draw, start = random.Random(6), datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(str(draw.randrange(4)), start + timedelta(seconds=draw.randrange(6 * 86_400))) for _ in range(150)]
    parts = [[], [], []]
    for row in rows:
        parts[draw.randrange(3)].append(row)
    gap = 5 * 3600
    for part in parts:
        table.add(*[(u, t.strftime("%Y-%m-%d %H:%M:%S UTC")) for u, t in part], gap=gap)
    whole = events(*[(int(u), t.isoformat()[:19]) for u, t in rows])
    expected = with_local_date(sessions.sessionize(whole, gap)).collect()
    assert table.ids() == sorted((r.dt, r.generated_session_id) for r in expected)
    states = extend.read_states(spark, table.output).collect()
    again = carried.session_state(versions.read_manifest(spark, table.output)).collect()
    key = lambda r: (r["user_id"], r["dt"])
    assert sorted((r.asDict() for r in states), key=key) == sorted((r.asDict() for r in again), key=key)


def test_rows_without_user_or_time_and_damaged_lines(table, spark):
    lines = "2019-10-01 00:00:00 UTC,view,many,5,c,b,1.5,4,s\n"
    done = table.add(("", "2019-10-01 00:00:00 UTC"), ("1", ""), lines=lines)
    assert (done.undated_rows, done.rejected_lines) == (1, 1)
    assert spark.read.text(done.rejected_path).first()[0] == lines.strip()
    assert spark.read.schema(RAW_EVENTS).parquet(done.undated_path).count() == 1
    assert table.ids() == [("2019-10-01", ""), ("2019-10-01", "4_20191001000000")]


def test_an_empty_folder_changes_nothing(table):
    assert table.add().written == []
    table.add(("1", "2019-10-01 00:00:00 UTC"))
    assert table.add().written == [] and len(table.ids()) == 1


@pytest.mark.parametrize("step", ["write_version", "write_states", "commit_manifest"])
def test_a_failed_run_leaves_the_old_rows(table, monkeypatch, step):
    table.add(("1", "2019-10-01 00:00:00 UTC"))
    before = table.ids()

    def broken(*_, **__):
        raise RuntimeError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(versions, step, broken)
        with pytest.raises(RuntimeError, match="no space"):
            table.add(("1", "2019-10-01 00:01:00 UTC"))
    assert table.ids() == before
    (state,) = table.store.current(table.spark).collect()
    assert (state.status, state.error_message) == (ledger.FAILED, "no space")
    assert not list((table.root / "checkpoint").glob("stages/extend/*"))
    table.add(("1", "2019-10-01 00:01:00 UTC"))
    assert table.ids() == [("2019-10-01", "1_20191001000000")] * 2


def test_a_second_run_is_refused_meanwhile(table, spark):
    table.add(("1", "2019-10-01 00:00:00 UTC"))
    with claims.claim(spark, table.output, "first"):
        assert claims.holder(spark, table.output) == "first"
        with pytest.raises(claims.AlreadyClaimed, match="first"):
            table.add(("1", "2019-10-02 00:00:00 UTC"))
    assert claims.holder(spark, table.output) is None
    table.add(("1", "2019-10-02 00:00:00 UTC"))
    assert len(table.ids()) == 2


def test_only_states_near_the_folder_are_read(table, spark):
    table.add(*[("1", f"2019-10-{d:02} 00:00:00 UTC") for d in range(1, 29)])
    runs = versions.current_runs(spark, table.output)
    near = {d: r for d, r in runs.items() if d >= carried.reach("2019-10-29", 300, -1)}
    assert list(near) == ["2019-10-28"]
    plan = extend.read_states(spark, table.output, near)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2019-10-28" in plan


@pytest.mark.parametrize("gap, days", [(1, 1), (86_400, 1), (86_401, 2), (172_800, 2)])
def test_reach(gap, days):
    assert carried.reach("2024-03-01", gap, -1) == (datetime(2024, 3, 1) - timedelta(days=days)).strftime("%Y-%m-%d")


# --- versions ----------------------------------------------------------------


@pytest.fixture
def labelled(events):
    rows = [(u, f"2024-01-0{d} 0{u}:00:00") for d in (1, 2, 3) for u in (1, 2, 3)]
    return with_local_date(sessions.sessionize(events(*rows)))


def counts(frame):
    return {r[DATE]: r["record_count"] for r in metrics.daily_counts(frame).collect()}


def test_a_version_replaces_dates_or_nothing(spark, labelled, tmp_path):
    root, name = f"file://{tmp_path}/t", f"default.versions_{uuid.uuid4().hex}"
    catalog.ensure_table(spark, root, name)
    versions.publish_version(labelled, root, name, counts(labelled))
    first = sorted(map(tuple, catalog.read_table(spark, name).collect()), key=str)
    assert len(first) == 9
    for expected in ({**counts(labelled), "2024-01-09": 1}, {"2024-01-01": 3}):
        with pytest.raises(versions.CountsDiffer):
            versions.publish_version(labelled, root, name, expected)
    assert sorted(map(tuple, catalog.read_table(spark, name).collect()), key=str) == first
    one = labelled.where("dt = '2024-01-02' and user_id = 1")
    versions.publish_version(one, root, name, {"2024-01-02": 1})
    assert counts(catalog.read_table(spark, name)) == {"2024-01-01": 3, "2024-01-02": 1, "2024-01-03": 3}
    spark.sql(f"DROP TABLE {name}")


def test_a_manifest_shows_committed_runs_only(spark, labelled, tmp_path):
    root = f"file://{tmp_path}/m"
    versions.create_manifest(spark, root)
    assert versions.read_manifest(spark, root).count() == 0 and versions.current_runs(spark, root) == {}
    versions.publish_to_manifest(labelled, root, counts(labelled), "a")
    part = labelled.where("user_id = 2")
    versions.write_version(part, root, counts(part), "b")  # never committed
    assert counts(versions.read_manifest(spark, root)) == counts(labelled)
    one = labelled.where("dt = '2024-01-02' and user_id = 1")
    versions.publish_to_manifest(one, root, {"2024-01-02": 1}, "c")
    assert versions.current_runs(spark, root) == {"2024-01-01": "a", "2024-01-02": "c", "2024-01-03": "a"}
    assert counts(versions.read_manifest(spark, root, "2024-01-02", "2024-01-03")) == {"2024-01-02": 1, "2024-01-03": 3}
    assert {r[DATE]: r["record_count"] for r in versions.manifest_counts(spark, root).collect()} == counts(
        versions.read_manifest(spark, root)
    )


def test_replaced_and_unfinished_runs_are_removed_and_the_rest_stays(spark, labelled, tmp_path):
    root = f"file://{tmp_path}/m"
    versions.publish_to_manifest(labelled, root, counts(labelled), "a")
    versions.publish_to_manifest(labelled, root, counts(labelled), "b")
    one = labelled.where("dt = '2024-01-02' and user_id = 1")
    versions.publish_to_manifest(one, root, {"2024-01-02": 1}, "c")
    versions.write_version(one, root, {"2024-01-02": 1}, "unfinished")
    before = sorted(versions.read_manifest(spark, root).collect(), key=str)
    assert versions.remove_replaced(spark, root) == ["a", "unfinished"]
    assert sorted(versions.read_manifest(spark, root).collect(), key=str) == before
    assert versions.remove_replaced(spark, root) == []
    versions.create_manifest(spark, f"file://{tmp_path}/new")
    assert versions.remove_replaced(spark, f"file://{tmp_path}/new") == []


# --- fingerprints ------------------------------------------------------------


def test_fingerprints_know_rows_and_copies_but_no_order(spark, events):
    rows = [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00"), (None, "2024-01-01 01:00:00")]
    found = lambda frame: content.fingerprints(with_local_date(frame)).first()["content"]
    one = events(*rows)
    assert found(one) == found(one.orderBy("product_id", ascending=False).repartition(3))
    others = [one.union(one), one.withColumn("user_id", one["user_id"] + 1), one.limit(2)]
    # A value that goes over into the next column.
    others += [one.selectExpr("event_time", "event_type", "product_id", "category_id", "brand as category_code", "'x' as brand", "price", "user_id", "user_session")]
    others += [one.selectExpr("event_time", "event_type", "product_id", "category_id", "'x' as category_code", "brand", "price", "user_id", "user_session")]
    assert len({found(f) for f in [one, *others]}) == 6


def test_merged_keeps_the_larger_number_of_copies(spark):
    def build(*values):
        return spark.createDataFrame([(v,) for v in values], "v int")

    found = content.merged(build(1, 1, 2, None), build(1, 3, 3, None, None), ["v"])
    assert sorted((r.v for r in found.collect()), key=str) == sorted([1, 1, 2, 3, 3, None, None], key=str)


def test_other_rows_of_equal_number_are_seen(spark, tmp_path):
    (tmp_path / "in").mkdir()
    options = {
        "input_dir": f"file://{tmp_path}/in", "output_dir": f"file://{tmp_path}/out",
        "store": LedgerStore.at(f"file://{tmp_path}/ledger"), "checkpoint_dir": f"file://{tmp_path}/checkpoint",
        "table": f"default.changed_{uuid.uuid4().hex}",
    }

    def run(time: str, **more):
        (tmp_path / "in" / "a.csv").write_text(f"{HEADER}2019-10-01 {time} UTC,view,1,5,c,b,1.5,7,s\n")
        return pipeline.run(spark, **options, **more).plan[0].action

    assert run("03:00:00") == ledger.BUILD
    assert run("03:00:00") == ledger.SKIP
    assert run("02:58:00", detect_changes=False) == ledger.SKIP
    assert run("02:58:00") == ledger.KEEP_NOT_CONTAINED
    assert run("02:58:00", replace_not_contained=True) == ledger.REBUILD_CHANGED
    (row,) = publish.read_events(spark, options["output_dir"]).collect()
    assert row.generated_session_id == "7_20191001025800"
    assert run("02:58:00") == ledger.SKIP


# --- scan, heavy hitters, weekly counts --------------------------------------


@pytest.mark.parametrize("gap, slice_cells", [(1, 1), (1, 8_192), (40, 2), (40, 7), (300, 1), (300, 2)])
def test_scan_equals_the_window(events, gap, slice_cells):
    draw, start = random.Random(gap), datetime(2024, 1, 1)
    rows = [(draw.randrange(3), (start + timedelta(seconds=draw.randrange(3_000))).isoformat()) for _ in range(200)]
    frame = events(*rows, (None, "2024-01-01 00:00:00"), (1, None))
    one = scan.sessionize_by_scan(frame, gap, slice_cells)
    other = sessions.sessionize(frame, gap)
    assert one.columns == other.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_scan_of_nothing_and_bad_slices(events):
    assert scan.sessionize_by_scan(events().where("false"), 5).count() == 0
    with pytest.raises(ValueError):
        scan.sessionize_by_scan(events(), 5, 0)


@pytest.mark.parametrize("buckets, fullest", [(1, 1), (4, 1), (1_000, 2), (1_000, 100)])
def test_heavy_users_equal_counting_all(events, buckets, fullest):
    draw = random.Random(buckets + fullest)
    rows = [(draw.choice([None, *range(12), *[3] * 9, *[7] * 9]), "2024-01-01 00:00:00") for _ in range(300)]
    frame = events(*rows)
    for n in (1, 10, 50):
        assert heavy.top_users(frame, n, buckets, fullest).collect() == skew.top_users(frame, n).collect()


def test_weekly_counts_from_daily_tables(events):
    draw, start = random.Random(9), datetime(2024, 1, 5)
    rows = [
        (draw.choice([None, -5, 0, 1, 32_768, 32_769, 2**40]), (start + timedelta(minutes=draw.randrange(20 * 1440))).isoformat())
        for _ in range(300)
    ]
    for gap in (300, 12 * 3600, 4 * 86_400):
        labelled = with_local_date(sessions.sessionize(events(*rows), gap))
        weeks = {r.week_start: (r.wau_by_user, r.wau_by_session) for r in metrics.wau(labelled).collect()}
        users = {r.week_start: r.wau_by_user for r in mergeable.users_per_week(mergeable.user_bitmaps(labelled)).collect()}
        found = mergeable.sessions_per_week(carried.session_state(labelled))
        assert {w: (users[w], r) for w, r in found.collect()} == weeks


def test_csv_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        HEADER + "2019-10-01 00:00:00 UTC,view,1,5,c,b,1.5,7,s\n" + "yesterday,view,2,5,c,b,1.5,7,s\n" + "2019-10-01 00:00:00 UTC,view\n"
    )
    raw.read_raw_csv_with_rejects(spark, f"file://{tmp_path}/a.csv").write.parquet(f"file://{tmp_path}/staged")
    rows = spark.read.parquet(f"file://{tmp_path}/staged").collect()
    assert len(rows) == 3
    assert sorted(r[raw.REJECTED] or "" for r in rows) == ["", "2019-10-01 00:00:00 UTC,view", "yesterday,view,2,5,c,b,1.5,7,s"]
