"""The batch job for folders that follow one another, such as monthly ones.

:func:`tidemark.plans.pipeline.run` wants the whole history in its input. Here a
folder holds what has arrived since: its rows are added to what is published,
a date that two folders share gets the rows of both, and sessions go on over
the edge. The table is read by its manifest, and what earlier dates mean for
later ones is kept beside it as one state per user and date, so a run reads the
folder, the published dates between its first and its last one, and states
within ``gap`` of them. It never reads the history.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import LOCAL_ZONE
from tidemark.operators import ledger
from tidemark.operators.calendar import with_local_date
from tidemark.operators.carried import STATE, carried, reach, session_state, sessionize_onto, states_that_differ
from tidemark.operators.content import fingerprints, merged
from tidemark.operators.sessions import SESSION_GAP
from tidemark.plans.pipeline import drop_stages
from tidemark.schema import DATE, RAW_EVENTS, SESSION_ID
from tidemark.session import shared_dir, shuffle_width
from tidemark.sources import versions
from tidemark.sources.claims import claim
from tidemark.sources.ledger_store import LedgerStore
from tidemark.sources.raw import REJECTED, read_raw_csv_with_rejects

log = logging.getLogger(__name__)

_ROWS = [*RAW_EVENTS.names, DATE]


@dataclass(frozen=True)
class Extension:
    """What a run did: the dates it wrote because of their rows, and later ones
    because a session now reaches into them from elsewhere."""

    run_id: str
    written: list[str]
    relabelled: list[str]
    unchanged: list[str]
    undated_rows: int
    undated_path: str | None
    rejected_lines: int
    rejected_path: str | None


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _of(frame: DataFrame, dates: list[str]) -> DataFrame:
    return frame.where(F.col(DATE).isin(dates))


class _Stage:
    """Tables of one run in the shared folder, deleted by path at its end."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.written = spark, folder, 0

    def __call__(self, frame: DataFrame) -> DataFrame:
        self.written += 1
        path = f"{self.folder}/{self.written}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)


def read_states(spark: SparkSession, output_dir: str, runs: dict[str, str] | None = None) -> DataFrame:
    """States of users and dates beside a table, all or those of ``runs``."""
    if runs is None:
        runs = versions.current_runs(spark, output_dir)
    return versions.read_states(spark, output_dir, STATE, runs)


def extend(
    spark: SparkSession,
    *,
    input_dir: str | list[str],
    output_dir: str,
    store: LedgerStore,
    checkpoint_dir: str | None = None,
    gap: int = SESSION_GAP,
    zone: str = LOCAL_ZONE,
) -> Extension:
    """Add a folder of raw CSV files to the table at ``output_dir``.

    A date that is published already keeps its rows and gets those of the folder
    on top, each as often as it occurs where it occurs more often: a folder
    delivered twice adds nothing. All dates from the folder's first to its last
    one are labelled again, after the states that reach them, and so is any
    later date whose sessions that changes, however far it goes on.

    The run's files are counted before its manifest row makes them the table:
    whatever fails, readers keep the old rows, and the ledger says FAILED. Rows
    without a time have no date and are set aside. Lines with a damaged cell are
    rows, with NULL in its place, and are listed besides as they were. Read the
    table with :func:`tidemark.sources.versions.read_manifest`. A run holds a claim
    on the table: a second one raises meanwhile. All runs that fill a table have
    one ``gap`` and ``zone``.
    """
    if gap <= 0:
        raise ValueError("gap must be positive")
    output = output_dir.rstrip("/")
    folder = (checkpoint_dir or shared_dir(spark)).rstrip("/")
    run_id = uuid.uuid4().hex
    stages = f"{folder}/stages/extend/{run_id}"
    stage = _Stage(spark, stages)
    versions.create_manifest(spark, output)
    with claim(spark, output, run_id):
        store.create(spark)
        try:
            raw = stage(with_local_date(read_raw_csv_with_rejects(spark, input_dir), zone))
            rejected, rejected_path = raw.where(F.col(REJECTED).isNotNull()), None
            if rejected_lines := rejected.count():
                rejected_path = f"{folder}/rejected/{run_id}"
                rejected.select(REJECTED).write.text(rejected_path)
                log.warning("%d damaged lines are in %s", rejected_lines, rejected_path)
            staged = raw.drop(REJECTED)
            arrived = {r[DATE]: r for r in fingerprints(staged).collect()}  # one row per date
            undated_path = None
            undated_rows = arrived.pop(None)["record_count"] if None in arrived else 0
            if undated_rows:
                undated_path = f"{folder}/undated/{run_id}"
                staged.where(F.col(DATE).isNull()).drop(DATE).write.parquet(undated_path)
                log.warning("%d rows without a time are in %s", undated_rows, undated_path)
            with shuffle_width(spark, sum(r["record_count"] for r in arrived.values())):
                dates = _extend(spark, staged, sorted(arrived), output, store, run_id, gap, zone, stage)
            return Extension(run_id, *dates, undated_rows, undated_path, rejected_lines, rejected_path)
        finally:
            drop_stages(spark, stages)


def _extend(
    spark: SparkSession,
    staged: DataFrame,
    dates: list[str],
    output: str,
    store: LedgerStore,
    run_id: str,
    gap: int,
    zone: str,
    stage: _Stage,
) -> tuple[list[str], list[str], list[str]]:
    """The dates written, labelled again, and unchanged."""
    runs = versions.current_runs(spark, output)
    window = sorted({*dates, *(d for d in runs if dates and dates[0] <= d <= dates[-1])})
    both = [d for d in dates if d in runs]
    published = versions.read_manifest(spark, output, window[0], window[-1]) if both or window != dates else None
    events = _of(staged, [d for d in dates if d not in runs]).select(*_ROWS)
    if published is not None:
        events = events.unionByName(_of(published, [d for d in window if d not in dates]).select(*_ROWS))
        events = events.unionByName(merged(_of(published, both), _of(staged, both), _ROWS))
    events = stage(events)
    content = {r[DATE]: r for r in fingerprints(events).collect()}  # one row per date
    known = store.current(spark).select("partition_date", "content").collect()  # dates
    recorded = {r["partition_date"]: r["content"] for r in known}
    changed = [d for d in dates if d not in runs or content[d]["content"] != recorded.get(d)]
    unchanged = [d for d in dates if d not in changed]
    if not changed:
        log.warning("nothing new on %s", ", ".join(dates) or "any date")
        return [], [], unchanged

    def near(first: str, last: str) -> dict[str, str]:
        return {d: run for d, run in runs.items() if first <= d <= last}

    # States of the dates ahead of the window that can reach into it.
    states = read_states(spark, output, near(reach(window[0], gap, -1), window[0]))
    states = states.where(F.col(DATE) < window[0])
    labelled = sessionize_onto(events, carried(states, window[0], gap), gap)
    labelled = stage(labelled.select(*_ROWS, SESSION_ID))
    fresh = stage(session_state(labelled, zone))
    # From here on dates are looked at one by one, as far as a change goes on.
    relabelled, last = [], window[-1]
    looked_at = window[-1]
    while following := sorted(d for d in runs if looked_at < d <= reach(last, gap, 1)):
        looked_at = following[0]
        kept = _kept_states(spark, output, runs, last, looked_at, gap)
        before = carried(states.unionByName(fresh).unionByName(kept), looked_at, gap)
        own = read_states(spark, output, {looked_at: runs[looked_at]})
        if states_that_differ(before, own, gap).isEmpty():
            continue
        rows = versions.read_manifest(spark, output, looked_at, looked_at).select(*_ROWS)
        more = stage(sessionize_onto(rows, before, gap).select(*_ROWS, SESSION_ID))
        fresh = stage(fresh.unionByName(session_state(more, zone)))
        labelled = labelled.unionByName(more)
        relabelled.append(looked_at)
        last = looked_at
    for row in fingerprints(labelled.where(F.col(DATE) > window[-1])).collect():
        content[row[DATE]] = row
    _commit(spark, labelled, fresh, content, output, store, run_id)
    return window, relabelled, unchanged


def _kept_states(spark: SparkSession, output: str, runs: dict[str, str], last: str, day: str, gap: int) -> DataFrame:
    """Unchanged states between the last date labelled and ``day``."""
    between = {d: run for d, run in runs.items() if max(last, reach(day, gap, -1)) < d < day}
    return read_states(spark, output, between)


def _commit(
    spark: SparkSession,
    labelled: DataFrame,
    states: DataFrame,
    content: dict,
    output: str,
    store: LedgerStore,
    run_id: str,
) -> None:
    seq = store.next_seq(spark)
    rows = [(d, r["record_count"], r["content"]) for d, r in sorted(content.items())]
    counts = spark.createDataFrame(rows, "partition_date string, record_count bigint, content string")
    store.append(ledger.begin(counts.select("partition_date"), run_id, _now(), seq))
    try:
        expected = {d: r["record_count"] for d, r in content.items()}
        written = versions.write_version(labelled, output, expected, run_id)
        versions.write_states(states, output, run_id)
        versions.commit_manifest(spark, output, written, run_id)
        store.append(ledger.succeed(store.current(spark), counts, _now(), seq + 1))
    except Exception as error:
        try:
            errors = counts.select("partition_date", F.lit(str(error)).alias("error_message"))
            store.append(ledger.fail(store.current(spark), errors, _now(), seq + 2))
        except PySparkException as second:
            log.error("could not record the failure: %s", second)
        raise
