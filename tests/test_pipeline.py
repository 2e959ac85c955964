from __future__ import annotations

import re
import uuid
from pathlib import Path

import pytest

from tidemark.operators import ledger
from tidemark.plans import pipeline
from tidemark.schema import EVENTS
from tidemark.sources import catalog, publish
from tidemark.sources.ledger_store import LedgerStore

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"


class Job:
    def __init__(self, spark, root: Path):
        self.spark, self.root = spark, root
        (root / "in").mkdir()
        self.table = f"default.job_{uuid.uuid4().hex}"
        self.output = f"file://{root}/out"
        self.store = LedgerStore.at(f"file://{root}/ledger")

    def add(self, name: str, *rows: tuple[str, str]) -> None:
        """Rows are (user, UTC time); both may be empty."""
        lines = [f"{t},view,{i},5,c,b,1.5,{u},s\n" for i, (u, t) in enumerate(rows)]
        (self.root / "in" / name).write_text(HEADER + "".join(lines))

    def run(self, **options):
        return pipeline.run(
            self.spark,
            input_dir=f"file://{self.root}/in",
            output_dir=self.output,
            store=self.store,
            checkpoint_dir=f"file://{self.root}/checkpoint",
            table=self.table,
            **options,
        )

    def actions(self, **options):
        return {r.dt: r.action for r in self.run(**options).plan}

    def ids(self):
        rows = publish.read_events(self.spark, self.output).collect()
        return sorted((r.dt, r.generated_session_id or "") for r in rows)

    def states(self):
        rows = self.store.current(self.spark).collect()
        return {r.partition_date: (r.status, r["record_count"], r.error_message) for r in rows}

    def remove_date(self, date: str) -> None:
        for file in (self.root / "out" / f"dt={date}").glob("*"):
            file.unlink()
        for file in (self.root / "out" / f"dt={date}").glob(".*"):
            file.unlink()

    def files(self):
        return {f"{p.parent.name}/{p.name}" for p in (self.root / "out").glob("dt=*/*.parquet")}


@pytest.fixture
def job(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.add(
        "oct.csv",
        ("1", "2019-10-01 14:58:00 UTC"),
        ("1", "2019-10-01 15:02:00 UTC"),  # next local day, same session
        ("2", "2019-10-02 01:00:00 UTC"),
        ("2", "2019-10-02 01:05:00 UTC"),  # new session
        ("3", "2019-10-03 01:00:00 UTC"),
        ("", "2019-10-03 02:00:00 UTC"),
        ("3", "no time"),
    )
    return job


ALL = {"2019-10-01": "BUILD", "2019-10-02": "BUILD", "2019-10-03": "BUILD"}
IDS = [
    ("2019-10-01", "1_20191001145800"),
    ("2019-10-02", "1_20191001145800"),
    ("2019-10-02", "2_20191002010000"),
    ("2019-10-02", "2_20191002010500"),
]


def test_first_run(spark, job, caplog):
    summary = job.run(skew_threshold=2)
    assert {r.dt: r.action for r in summary.plan} == ALL
    rows = publish.read_events(spark, job.output)
    assert rows.schema == EVENTS and rows.count() == 6
    assert [i for i in job.ids() if i[0] < "2019-10-03"] == IDS
    assert job.states() == {
        "2019-10-01": ("SUCCESS", 1, None),
        "2019-10-02": ("SUCCESS", 3, None),
        "2019-10-03": ("SUCCESS", 2, None),
    }
    # rows in = rows out + set aside
    assert summary.undated_rows == 1
    assert spark.read.parquet(summary.undated_path).first().user_id == 3
    assert summary.skewed_users == 3
    assert [r["event_count"] for r in summary.top_users] == [2, 2, 2, 1]
    assert catalog.read_table(spark, job.table).count() == 6
    # the staged copy is gone
    assert not list((job.root / "checkpoint").glob("stages/*"))
    stats = spark.read.parquet(f"{job.output}-statistics").orderBy("dt").collect()
    assert [(r.dt, r.row_count, r.user_id_distinct, r.run_id) for r in stats] == [
        ("2019-10-01", 1, 1, summary.run_id),
        ("2019-10-02", 3, 2, summary.run_id),
        ("2019-10-03", 2, 1, summary.run_id),
    ]


def test_second_run_skips_everything(job):
    job.run()
    def everything():
        return sorted(p for p in job.root.rglob("*") if p.is_file())

    before = everything()
    assert set(job.actions().values()) == {"SKIP"}
    assert everything() == before  # nothing staged, set aside, logged or published


def test_counts_read_only_the_dates_asked_for(spark, job):
    job.run()
    counts = publish.published_counts(spark, job.output, ["2019-10-02"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*dt#\d+ = 2019-10-02", plan)
    assert [tuple(r) for r in counts.collect()] == [("2019-10-02", 3)]


PART_OF_DATE = [
    ("fewer rows", [("2", "2019-10-02 01:00:00 UTC")]),
    ("as many", [("9", f"2019-10-02 0{i}:00:00 UTC") for i in range(3)]),
    ("more rows", [("9", f"2019-10-02 0{i}:00:00 UTC") for i in range(5)]),
]


@pytest.mark.parametrize("rows", [r for _, r in PART_OF_DATE], ids=[n for n, _ in PART_OF_DATE])
def test_published_rows_are_never_replaced_by_an_input_without_them(job, rows):
    job.run()
    before, ids, states = job.files(), job.ids(), job.states()
    (job.root / "in" / "oct.csv").unlink()
    job.add("nov.csv", *rows, ("3", "2019-10-05 01:00:00 UTC"))
    summary = job.run()
    assert summary.dates("KEEP_NOT_CONTAINED") == ["2019-10-02"]
    assert summary.dates("BUILD") == ["2019-10-05"]
    assert before <= job.files() and [i for i in job.ids() if i[0] < "2019-10-05"] == ids
    assert {d: s for d, s in job.states().items() if d < "2019-10-05"} == states


def test_not_contained_rows_are_replaced_if_asked(job):
    job.run()
    (job.root / "in" / "oct.csv").unlink()
    job.add("nov.csv", ("2", "2019-10-02 01:00:00 UTC"))
    assert job.actions(replace_not_contained=True) == {"2019-10-02": "REBUILD_GREW"}
    assert [i for i in job.ids() if i[0] == "2019-10-02"] == [("2019-10-02", "2_20191002010000")]


def test_late_event_renames_its_session_on_later_dates(job):
    job.run()
    job.add("late.csv", ("1", "2019-10-01 14:55:00 UTC"))
    assert job.actions() == {
        "2019-10-01": "REBUILD_GREW", "2019-10-02": "REBUILD_SESSION", "2019-10-03": "SKIP",
    }
    assert {i for _, i in job.ids() if i[:2] == "1_"} == {"1_20191001145500"}
    assert set(job.actions().values()) == {"SKIP"}


def test_late_event_reaches_over_many_dates(job):
    job.add("long.csv", *[("7", f"2019-10-0{d} {h:02}:00:00 UTC") for d in (1, 2, 3, 4) for h in range(24)])
    job.run(gap=3601)
    job.add("late.csv", ("7", "2019-09-30 23:30:00 UTC"))
    changed = job.run(gap=3601)
    assert changed.dates("REBUILD_GREW") == ["2019-10-01"]
    assert changed.dates("REBUILD_SESSION") == ["2019-10-02", "2019-10-03", "2019-10-04", "2019-10-05"]
    assert {i for _, i in job.ids() if i[:2] == "7_"} == {"7_20190930233000"}


def test_change_over_many_dates_moves_the_history_once(job, monkeypatch):
    hours = [("7", f"2019-10-{d:02} {h:02}:00:00 UTC") for d in range(1, 10) for h in range(24)]
    job.add("long.csv", *hours)
    job.run(gap=3601)
    job.add("late.csv", ("7", "2019-09-30 23:30:00 UTC"))
    calls = []
    for name in ("session_cells", "sessionize_by", "sessionize_within"):
        true = getattr(pipeline, name)
        monkeypatch.setattr(pipeline, name, lambda *a, name=name, true=true: (calls.append(name), true(*a))[1])
    changed = job.run(gap=3601)
    assert changed.dates("REBUILD_SESSION") == [f"2019-10-{d:02}" for d in range(2, 11)]
    # Nine dates in passes of one, two, four and the last two.
    assert calls == ["session_cells"] + 4 * ["sessionize_by"]
    assert {i for _, i in job.ids() if i[:2] == "7_"} == {"7_20190930233000"}
    assert not (job.root / "checkpoint" / "stages" / job.table).exists()


def test_date_that_differs_is_left_where_no_change_reaches_it(job):
    job.add("more.csv", ("2", "2019-10-04 01:00:00 UTC"), ("2", "2019-10-04 01:30:00 UTC"))
    job.run()
    job.add("late.csv", ("9", "2019-10-01 01:00:00 UTC"))
    # The wider gap joins sessions of the 2nd and of the 4th, none of the 3rd.
    assert job.actions(gap=3601) == {
        "2019-10-01": "REBUILD_GREW", "2019-10-02": "REBUILD_SESSION", "2019-10-03": "SKIP", "2019-10-04": "SKIP",
    }


def test_dates_with_rows_the_others_lack(spark):
    def rows(*listed):
        return spark.createDataFrame(listed, "a int, b string, dt string")

    some = rows(
        (1, "x", "same"), (None, "x", "same"), (1, None, "same"),
        (1, "x", "copies"), (1, "x", "copies"), (2, "x", "copies"),
        (1, "x", "fewer"), (1, "x", "fewer and other"), (1, "x", "more"), (1, "x", "more"), (1, "x", "absent"),
        (1, None, "nulls"), (None, "1", "nulls"), (1, "x", None), (3, "x", "twice"), (3, "x", "twice"),
    )
    others = rows(
        (1, None, "same"), (1, "x", "same"), (None, "x", "same"),
        (1, "x", "copies"), (2, "x", "copies"), (2, "x", "copies"),
        (1, "x", "fewer"), (1, "x", "fewer"), (2, "x", "fewer and other"), (2, "x", "fewer and other"),
        (1, "x", "more"), (1, "x", "only here"), (None, "1", "nulls"), (None, None, "nulls"), (1, "x", None),
        (3, "x", "twice"), (4, "x", "twice"), (4, "x", "twice"),
    )
    lacking = some.exceptAll(others).select("dt").distinct().collect()
    expected = {"copies", "fewer and other", "more", "absent", "nulls", "twice"}
    assert pipeline._exceeding(some, others, ["a", "b"]) == {r.dt for r in lacking} == expected
    assert pipeline._exceeding(some, some.limit(0), ["a", "b"]) == {r.dt for r in some.collect()}
    assert pipeline._exceeding(some.limit(0), some, ["a", "b"]) == set()


def test_missing_date_alone_is_rebuilt(spark, job):
    job.run()
    before, ids = job.files(), job.ids()
    job.remove_date("2019-10-02")
    assert job.actions() == {"2019-10-01": "SKIP", "2019-10-02": "REBUILD_MISSING", "2019-10-03": "SKIP"}
    assert job.ids() == ids
    assert len(before & job.files()) == len(before) - 1
    messages = job.store.log(spark).where("status = 'FAILED'").collect()
    assert [(m.partition_date, m.error_message, m["record_count"]) for m in messages] == [
        ("2019-10-02", "Output files missing after SUCCESS", 3)
    ]


def test_date_that_grew_is_rebuilt_unless_sizes_are_ignored(job):
    job.run()
    job.add("late.csv", ("2", "2019-10-02 01:03:00 UTC"), ("9", "2019-10-04 01:00:00 UTC"))
    skipped = job.actions(detect_growth=False)
    assert skipped["2019-10-02"] == "SKIP" and skipped["2019-10-04"] == "BUILD"
    assert job.actions()["2019-10-02"] == "REBUILD_GREW"
    # the late event joins the two sessions of user 2
    assert [i for d, i in job.ids() if d == "2019-10-02" and i[0] == "2"] == ["2_20191002010000"] * 3


def test_range_limits_the_dates_but_not_the_history(job):
    assert job.actions(start_date="2019-10-02", end_date="2019-10-02") == {"2019-10-02": "BUILD"}
    assert job.ids() == IDS[1:]
    assert set(job.states()) == {"2019-10-02"}


def test_unfinished_run_is_restarted(spark, job):
    old = str(uuid.uuid4())
    job.store.create(spark)
    day = spark.createDataFrame([("2019-10-01",)], "partition_date string")
    job.store.append(ledger.begin(day, old, pipeline._now(), 1))
    # Left by two drivers that were killed, one of them before the ledger knew.
    for run in (old, str(uuid.uuid4())):
        pipeline.stage_rows(spark, spark.range(3), f"file://{job.root}/checkpoint/stages/{job.table}", run)
    assert len(list((job.root / "checkpoint" / "stages" / job.table).glob("*/*.parquet"))) >= 2
    job.spark = spark.newSession()  # knows no table of the old one
    assert job.actions() == {**ALL, "2019-10-01": "REBUILD_STALE"}
    assert not (job.root / "checkpoint" / "stages" / job.table).exists()
    log = job.store.log(spark).where("partition_date = '2019-10-01'").orderBy("seq").collect()
    assert [(r.status, r.error_message) for r in log] == [
        ("IN_PROGRESS", None),
        ("FAILED", "Restarted after IN_PROGRESS"),
        ("IN_PROGRESS", None),
        ("SUCCESS", None),
    ]


def test_failure_is_recorded_and_raised_and_then_repaired(spark, job, monkeypatch):
    with monkeypatch.context() as patch:
        def broken(*_):
            raise OSError("disk full " * 200)

        patch.setattr(publish, "write_dates", broken)
        with pytest.raises(OSError):
            job.run()
    states = job.states()
    assert {s for s, *_ in states.values()} == {"FAILED"}
    assert {len(m) for *_, m in states.values()} == {1000}
    assert not list((job.root / "checkpoint").glob("stages/*"))
    assert set(job.actions().values()) == {"REBUILD_FAILED"}
    assert {s for s, *_ in job.states().values()} == {"SUCCESS"}


def test_lost_rows_are_noticed(spark, job, monkeypatch):
    write = publish.write_dates
    monkeypatch.setattr(
        publish, "write_dates", lambda frame, path: write(frame.where("user_id <> 1"), path)
    )
    with pytest.raises(RuntimeError, match="2019-10-01"):
        job.run()
    assert {s for s, *_ in job.states().values()} == {"FAILED"}


def test_nothing_in_range(job):
    assert job.run(start_date="2020-01-01").plan == []
    assert job.states() == {}


@pytest.mark.parametrize(
    "options",
    [
        {"start_date": "2019-10-3"},
        {"end_date": "yesterday"},
        {"start_date": "2019-10-03", "end_date": "2019-10-02"},
        {"gap": 0},
        {"skew_threshold": 0},
    ],
)
def test_bad_parameters(job, options):
    with pytest.raises(ValueError):
        job.run(**options)


def test_session_zone_does_not_matter(job, conf):
    conf(spark__sql__session__timeZone="America/New_York")
    job.run()
    assert [i for i in job.ids() if i[0] < "2019-10-03"] == IDS
