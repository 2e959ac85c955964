"""The batch job: raw CSV files to a published, resumable, dated table."""

from __future__ import annotations

import logging
import uuid
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.functions.clock import DAY, LOCAL_ZONE
from tidemark.operators import ledger
from tidemark.operators.calendar import date_range, with_local_date
from tidemark.operators.carried import reach
from tidemark.operators.content import fingerprints
from tidemark.operators.metrics import daily_counts, partition_stats
from tidemark.operators.sessions import SESSION_GAP, session_cells, sessionize, sessionize_by, sessionize_within
from tidemark.operators.skew import SKEW_THRESHOLD, at_least, busiest, user_event_counts
from tidemark.schema import DATE, RAW_EVENTS, SESSION_ID
from tidemark.session import shared_dir, shuffle_width
from tidemark.sources import catalog, publish
from tidemark.sources.ledger_store import LedgerStore
from tidemark.sources.raw import read_raw_csv

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunSummary:
    """What a run did. The lists hold one row per date, and ten users."""

    run_id: str
    plan: list[Row]
    top_users: list[Row]
    skewed_users: int
    undated_rows: int
    undated_path: str | None

    def dates(self, *actions: str) -> list[str]:
        return [row[DATE] for row in self.plan if row["action"] in actions]


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _stages(folder: str, table: str) -> str:
    """Where the runs that fill ``table`` keep their staged input."""
    return f"{folder}/stages/{table}"


def stage_rows(spark: SparkSession, raw: DataFrame, stages: str, run_id: str) -> DataFrame:
    """Write the parsed input once, as Parquet in the shared folder.

    The job passes over its input several times with one to three columns.
    From here those passes prune columns and row groups, parse no text, and
    survive the loss of executors.
    """
    path = f"{stages}/{run_id}"
    raw.write.parquet(path)
    return spark.read.schema(raw.schema).parquet(path)


def drop_stages(spark: SparkSession, stages: str) -> None:
    """Delete what any run has staged for a table; failure only logs.

    Runs that fill one table do not overlap, so whatever lies there is left
    over, also from a driver that was killed before its ledger knew of the run.
    Goes by path, so it needs no catalog.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(stages)
    try:
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(path):
            files.delete(path, True)
    except Py4JJavaError as error:
        log.warning("stages in %s stay: %s", stages, error)


def _check_range(start: str | None, end: str | None) -> None:
    for name, value in (("start_date", start), ("end_date", end)):
        if value is not None:
            datetime.strptime(value, "%Y-%m-%d")
            if len(value) != 10:
                raise ValueError(f"{name} is not yyyy-MM-dd: {value}")
    if start is not None and end is not None and start > end:
        raise ValueError(f"start_date {start} lies after end_date {end}")


def run(
    spark: SparkSession,
    *,
    input_dir: str | list[str],
    output_dir: str,
    store: LedgerStore,
    checkpoint_dir: str | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    skew_threshold: int = SKEW_THRESHOLD,
    gap: int = SESSION_GAP,
    zone: str = LOCAL_ZONE,
    table: str = catalog.TABLE,
    detect_growth: bool = True,
    detect_changes: bool = True,
    replace_not_contained: bool = False,
    analyze: bool = True,
    statistics_dir: str | None = None,
) -> RunSummary:
    """Publish every local date of the input that is not published yet.

    The whole input is read, so sessions are exact at the edges of the date
    range; only the dates that need work are labelled and written. A date's
    SUCCESS is recorded last, with the rows counted in what was written; that
    check comes after the old files are gone. On error the dates of the run are
    recorded as FAILED and the error is raised.

    No published row is lost: a date whose output holds rows that this input
    lacks is kept as it is (``KEEP_NOT_CONTAINED``) and listed in the summary,
    unless ``replace_not_contained``. If work on a date changes sessions that
    run on into finished dates of the input and range, those are written anew
    (``REBUILD_SESSION``). A finished date whose input has as many rows as recorded
    but other ones is found by a fingerprint of all columns (``REBUILD_CHANGED``);
    ``detect_changes=False`` compares counts only, which reads one column.

    A run without work writes nothing. With work, rows without a time, which
    have no date, are set aside, and with ``analyze`` the statistics of the
    dates written are appended to ``statistics_dir`` (default: beside the
    output). Runs that fill one table must not overlap.
    """
    _check_range(start_date, end_date)
    if gap <= 0 or skew_threshold <= 0:
        raise ValueError("gap and skew_threshold must be positive")
    folder = (checkpoint_dir or shared_dir(spark)).rstrip("/")
    output = output_dir.rstrip("/")
    statistics = (statistics_dir or f"{output}-statistics").rstrip("/")
    run_id = str(uuid.uuid4())

    store.create(spark)
    publish.ensure_root(spark, output)
    catalog.ensure_table(spark, output, table)
    stages = _stages(folder, table)
    drop_stages(spark, stages)
    try:
        raw = with_local_date(read_raw_csv(spark, input_dir), zone)
        # One row per date: from one column, or a fingerprint of all of them.
        daily = (fingerprints(raw) if detect_changes else daily_counts(raw)).collect()
        rows = sum(row["record_count"] for row in daily)
        targets = [row for row in daily if row[DATE] is not None]
        plan = (
            ledger.plan(
                date_range(
                    spark.createDataFrame(
                        [(row[DATE], row["record_count"], row["content"] if detect_changes else None) for row in targets],
                        f"{DATE} string, record_count bigint, content string",
                    ),
                    start_date,
                    end_date,
                ),
                store.current(spark),
                publish.published_counts(spark, output, [row[DATE] for row in targets]),
                detect_growth,
            )
            .orderBy(DATE)
            .collect()
        )
        undated_rows = sum(row["record_count"] for row in daily if row[DATE] is None)
        work = any(row["action"] != ledger.SKIP for row in plan)
        staged = stage_rows(spark, raw, stages, run_id) if work else raw

        with shuffle_width(spark, rows):
            # Read three times: for the busiest, the skewed and the hot users.
            user_counts = user_event_counts(staged).persist(StorageLevel.MEMORY_AND_DISK)
            cells = None
            try:
                if work and not replace_not_contained:
                    plan = _kept_where_not_contained(staged, plan, output)
                if any(row["action"] in _WORK for row in plan):
                    plan, cells = _with_changed_sessions(
                        staged, plan, output, gap, lambda rows: stage_rows(spark, rows, stages, f"{run_id}-cells")
                    )
                todo = [row for row in plan if row["action"] in _WORK]
                undated_path = f"{folder}/undated/{run_id}" if todo and undated_rows else None
                if undated_path:
                    _set_aside_undated(staged, undated_rows, undated_path)
                summary = RunSummary(
                    run_id=run_id,
                    plan=plan,
                    top_users=busiest(user_counts).collect(),
                    skewed_users=at_least(user_counts, skew_threshold).count(),
                    undated_rows=undated_rows,
                    undated_path=undated_path,
                )
                if summary.skewed_users:
                    log.warning("%d users have %d events or more", summary.skewed_users, skew_threshold)
                if kept := summary.dates(ledger.KEEP_NOT_CONTAINED):
                    log.warning("kept, for the input lacks rows of them: %s", ", ".join(kept))
                catalog.register_dates(
                    spark, summary.dates(ledger.SKIP, ledger.KEEP_NOT_CONTAINED), output, table
                )
                if todo:
                    labelled = _label(staged, todo, gap, rows, user_counts, cells)
                    _publish(spark, labelled, todo, summary, output, store, table)
                    if analyze:
                        dates = [row[DATE] for row in todo]
                        _append_statistics(spark, output, dates, run_id, statistics)
                        catalog.analyze_dates(spark, dates, table)
                else:
                    log.warning("nothing to do in %s", input_dir)
            finally:
                user_counts.unpersist()
    finally:
        drop_stages(spark, stages)
    return summary


_WORK = (
    ledger.BUILD,
    ledger.REBUILD_GREW,
    ledger.REBUILD_CHANGED,
    ledger.REBUILD_MISSING,
    ledger.REBUILD_STALE,
    ledger.REBUILD_FAILED,
    ledger.REBUILD_SESSION,
)


def _with_action(plan: list[Row], dates: set[str], action: str) -> list[Row]:
    return [
        Row(**{**row.asDict(), "action": action}) if row[DATE] in dates else row for row in plan
    ]


def _not_contained(staged: DataFrame, dates: list[str], output: str) -> set[str]:
    """Those of the dates whose published rows are not all in the input.

    Both sides are pruned to the dates; copies count.
    """
    wanted = F.col(DATE).isin(dates)
    columns = [*RAW_EVENTS.names, DATE]
    published = publish.read_dates(staged.sparkSession, output, dates)
    lost = published.select(*columns).exceptAll(staged.where(wanted).select(*columns))
    return {row[DATE] for row in lost.select(DATE).distinct().collect()}  # dates


def _kept_where_not_contained(staged: DataFrame, plan: list[Row], output: str) -> list[Row]:
    dates = [r[DATE] for r in plan if r["action"] != ledger.SKIP and r["published_count"] is not None]
    if not dates:
        return plan
    return _with_action(plan, _not_contained(staged, dates, output), ledger.KEEP_NOT_CONTAINED)


def _exceeding(some: DataFrame, others: DataFrame, columns: list[str]) -> set[str]:
    """The dates of which ``some`` has rows that ``others`` lacks; copies count.

    Fingerprints tell it without moving rows: of more rows some are lacking, and
    of as many rows unless the fingerprints are equal. Only where ``some`` has
    fewer rows of a date are they compared themselves.
    """
    found = fingerprints(some, columns).withColumn("side", F.lit(0))
    found = found.unionByName(fingerprints(others, columns).withColumn("side", F.lit(1)))
    sides: list[dict[str, Row]] = [{}, {}]
    for row in found.collect():  # two rows per date
        sides[row["side"]][row[DATE]] = row
    exceeding, fewer = set(), []
    for day, row in sides[0].items():
        other = sides[1].get(day)
        if other is None or row["record_count"] > other["record_count"]:
            exceeding.add(day)
        elif row["record_count"] < other["record_count"]:
            fewer.append(day)
        elif row["content"] != other["content"]:
            exceeding.add(day)
    if fewer:
        wanted, whole = F.col(DATE).isin(fewer), [*columns, DATE]
        lacking = some.where(wanted).select(*whole).exceptAll(others.where(wanted).select(*whole))
        exceeding |= {row[DATE] for row in lacking.select(DATE).distinct().collect()}  # dates
    return exceeding


def _near(dates: set[str], known: set[str], gap: int) -> set[str]:
    """Those of ``dates`` that a change on one of the ``known`` dates can reach."""
    ahead = sorted(known)
    return {d for d in dates if bisect_left(ahead, reach(d, gap, -1)) < bisect_left(ahead, d)}


def _cells_of(cells: DataFrame, dates: list[str], gap: int) -> DataFrame:
    """The cells that events of the dates, sorted, can lie in."""
    first, last = (date.fromisoformat(d).toordinal() - date(1970, 1, 1).toordinal() for d in (dates[0], dates[-1]))
    # A local date lies within the UTC days from the one before to the one after.
    return cells.where(F.col("cell").between((first - 1) * DAY - gap, (last + 2) * DAY))


def _with_changed_sessions(
    staged: DataFrame, plan: list[Row], output: str, gap: int, keep: Callable[[DataFrame], DataFrame]
) -> tuple[list[Row], DataFrame | None]:
    """The plan with finished dates to rebuild whose session IDs have changed.

    A change reaches a date only from one whose events can lie within ``gap`` of
    its own. So the finished dates that near to one with work are compared, and
    from each that differs those near to it. Dates kept because the input lacks
    rows of them may differ from the input as well, and count as reached.

    The history goes through one shuffle, however far a change reaches: its
    session cells are written by ``keep`` and returned, if any date was compared.
    Dates are compared in passes that look twice as far ahead each time, as if
    every date differed, so passes grow with the logarithm of the dates.
    """
    finished = {row[DATE] for row in plan if row["action"] == ledger.SKIP}
    reached = {row[DATE] for row in plan if row["action"] != ledger.SKIP}
    columns = ["user_id", "event_time", SESSION_ID]
    looked_at: set[str] = set()
    # Those that differ, reached or not, and those reached.
    differing: set[str] = set()
    changed: set[str] = set()
    cells, steps = None, 1
    while True:
        while more := _near(differing - changed, reached, gap):
            changed |= more
            reached |= more
        asked: set[str] = set()
        for _ in range(steps):
            more = _near(finished - looked_at - asked, reached | asked, gap)
            if not more:
                break
            asked |= more
        if not asked:
            return _with_action(plan, changed, ledger.REBUILD_SESSION), cells
        looked_at |= asked
        steps *= 2
        if cells is None:
            cells = keep(session_cells(staged, gap))
        days = sorted(asked)
        input_rows = staged.where(F.col(DATE).isin(days))
        now = sessionize_by(input_rows, _cells_of(cells, days, gap), gap)
        differ = _exceeding(now, publish.read_dates(staged.sparkSession, output, days), columns)
        if differ:
            # An equal number of other rows is no reason to lose the published ones.
            published = publish.read_dates(staged.sparkSession, output, sorted(differ))
            input_rows = staged.where(F.col(DATE).isin(sorted(differ)))
            differ -= _exceeding(published, input_rows, RAW_EVENTS.names)
        differing |= differ


def _append_statistics(
    spark: SparkSession, output: str, dates: list[str], run_id: str, path: str
) -> None:
    """Append the dates' counts, distinct values and bounds to a Parquet table."""
    written = publish.read_dates(spark, output, dates)
    stats = partition_stats(written).withColumn("run_id", F.lit(run_id))
    stats.coalesce(1).write.mode("append").parquet(path)  # one row per date


def _set_aside_undated(staged: DataFrame, rows: int, path: str) -> None:
    staged.where(F.col(DATE).isNull()).drop(DATE).write.parquet(path)
    log.warning("%d rows without a time are in %s", rows, path)


def _is_most(todo: list[Row], rows: int) -> bool:
    """Whether the dates in ``todo`` hold more than half of the input."""
    return 2 * sum(row["source_count"] for row in todo) > rows


def _label(
    staged: DataFrame, todo: list[Row], gap: int, rows: int, user_counts: DataFrame, cells: DataFrame | None
) -> DataFrame:
    """Sessionize the rows of the dates in ``todo`` within the whole input.

    If they are most of the input, all of it is labelled with one shuffle.
    Otherwise only they are shuffled in full, and the rest by two columns, or
    the session ``cells`` of the input if they are there.
    """
    wanted = F.col(DATE).isin([row[DATE] for row in todo])
    if _is_most(todo, rows):
        return sessionize(staged, gap, user_counts).where(wanted)
    if cells is not None:
        return sessionize_by(staged.where(wanted), cells, gap)
    return sessionize_within(staged.where(wanted), staged, gap)


def _publish(
    spark: SparkSession,
    labelled: DataFrame,
    todo: list[Row],
    summary: RunSummary,
    output: str,
    store: LedgerStore,
    table: str,
) -> None:
    dates = [row[DATE] for row in todo]
    seq = store.next_seq(spark)

    def of_dates(values: list, column: str, column_type: str) -> DataFrame:
        return spark.createDataFrame(
            list(zip(dates, values)), f"partition_date string, {column} {column_type}"
        )

    demoted = {
        ledger.REBUILD_MISSING: ledger.MISSING_OUTPUT,
        ledger.REBUILD_STALE: ledger.STALE_RUN,
    }
    reasons = of_dates([demoted.get(row["action"]) for row in todo], "error_message", "string")
    if summary.dates(*demoted):
        reasons = reasons.where(F.col("error_message").isNotNull())
        store.append(ledger.fail(store.current(spark), reasons, _now(), seq))
    store.append(ledger.begin(of_dates([0] * len(dates), "unused", "int"), summary.run_id, _now(), seq + 1))

    try:
        publish.write_dates(labelled, output)
        written = {
            row[DATE]: row["record_count"]
            for row in publish.published_counts(spark, output, dates).collect()
        }
        wrong = [r[DATE] for r in todo if written.get(r[DATE]) != r["source_count"]]
        if wrong:
            raise RuntimeError(f"row counts differ from the input on {', '.join(wrong)}")
        catalog.register_dates(spark, dates, output, table)
        counted = spark.createDataFrame(
            [(r[DATE], written[r[DATE]], r["content"]) for r in todo],
            "partition_date string, record_count bigint, content string",
        )
        store.append(ledger.succeed(store.current(spark), counted, _now(), seq + 2))
    except Exception as error:
        try:
            errors = of_dates([str(error)] * len(dates), "error_message", "string")
            store.append(ledger.fail(store.current(spark), errors, _now(), seq + 3))
        except PySparkException as second:
            log.error("could not record the failure: %s", second)
        raise
