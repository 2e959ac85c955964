"""

Every query reads the whole ``events`` table of the given folder. Times are
returned as whole microseconds since 1970, so that both engines compare the
same integers.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.functions import clock  # noqa: E402
from tidemark.operators import (  # noqa: E402
    calendar,
    carried,
    content,
    heavy,
    ledger,
    mergeable,
    metrics,
    scan,
    sessions,
    sketches,
    skew,
)
from tidemark.plans import extend, pipeline, weekly  # noqa: E402
from tidemark.session import scratch_path, ship_package  # noqa: E402
from tidemark.sources import catalog, publish, raw, versions  # noqa: E402
from tidemark.sources.ledger_store import LedgerStore  # noqa: E402

# Fixed values for the test data: it covers January 2024, and no user has more
# than 99 events.
WEEK_LOW, WEEK_HIGH = "2024-01-01", "2024-01-31"
SKEWED_FROM = 80
GAP_1S, GAP_5M, GAP_12H, GAP_2D = 1, 300, 12 * 3600, 2 * 86_400
CUT_TIME = "2024-01-16 03:00:00"
SLICE_DATE = "2024-01-15"
RANGE_START, RANGE_END = "2024-01-10", "2024-01-20"

# Fixed values of the derived ledger.
SEED_RUN = "seed-run"
SEED_START = datetime(2024, 2, 1, 0, 0, 0, tzinfo=timezone.utc)
SEED_END = datetime(2024, 2, 1, 1, 30, 0, tzinfo=timezone.utc)
SEED_ERROR = "disk full "
SEED_ERROR_COPIES = 150  # longer than the ledger keeps


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.read_activity_table(spark, sf_dir)


def _with_micros(events: DataFrame, *more: str) -> DataFrame:
    """The columns of an event the test data fills, times as integers."""
    return events.select(
        F.unix_micros("event_time").alias("event_us"),
        "event_type",
        "product_id",
        "category_id",
        "price",
        "user_id",
        *more,
    )


def _sessionized(spark: SparkSession, sf_dir: str, gap: int = GAP_5M) -> DataFrame:
    return weekly.sessionized_events(_events(spark, sf_dir), gap)


# --- sources and sinks -------------------------------------------------------


def _csv_copy(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = scratch_path(spark, name)
    raw.write_raw_csv(_events(spark, sf_dir), path)
    return path


def _published(spark: SparkSession, sf_dir: str, name: str, gap: int = GAP_5M) -> str:
    path = scratch_path(spark, name)
    publish.write_dates(_sessionized(spark, sf_dir, gap), path)
    return path


def raw_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_micros(raw.read_raw_csv(spark, _csv_copy(spark, sf_dir, "raw_csv_scan")))


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _published(spark, sf_dir, "publish_roundtrip")
    return _with_micros(publish.read_events(spark, path), "generated_session_id", "dt")


def published_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.published_counts(spark, _published(spark, sf_dir, "published_counts"))


def _registered(spark: SparkSession, sf_dir: str, name: str, gap: int = GAP_5M) -> str:
    """Publish, put all dates into the catalog, and return the table's name."""
    path = _published(spark, sf_dir, name, gap)
    table = _scratch_table(path)
    catalog.ensure_table(spark, path, table)
    dates = publish.published_counts(spark, path).select("dt").collect()  # one per day
    catalog.register_dates(spark, [row.dt for row in dates], path, table)
    catalog.analyze_once(spark, table)
    return table


# All tables of these queries lie in one database, which one statement drops:
# DROP DATABASE tidemark_scratch CASCADE.
SCRATCH = "tidemark_scratch"


def _scratch_table(path: str) -> str:
    return f"{SCRATCH}.t_" + path.rpartition("-")[2]


def wau_table(spark: SparkSession, sf_dir: str) -> str:
    """Name of a table to time the weekly query on."""
    return _registered(spark, sf_dir, "wau_table", GAP_12H)


def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _registered(spark, sf_dir, "catalog_table")
    return _with_micros(catalog.read_table(spark, table), "generated_session_id", "dt")


def wau_sql_on_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly query as a user types it."""
    return wau_sql(spark, _registered(spark, sf_dir, "wau_sql_on_table", GAP_12H))


def wau_sql(spark: SparkSession, table: str) -> DataFrame:
    """That query on a table that is there already."""
    return spark.sql(
        f"""
        SELECT CAST(monday AS STRING) AS week_start,
               count(DISTINCT user_id) AS wau_by_user,
               count(DISTINCT generated_session_id) AS wau_by_session,
               if(monday < DATE '{WEEK_LOW}' OR date_add(monday, 6) > DATE '{WEEK_HIGH}',
                  'PARTIAL', 'FULL') AS week_type
        FROM (SELECT *, CAST(date_trunc('WEEK', CAST(dt AS DATE)) AS DATE) AS monday FROM {table})
        GROUP BY monday ORDER BY monday
        """
    )


def wau_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _published(spark, sf_dir, "wau_published", GAP_12H)
    return _week_as_text(metrics.wau(publish.read_events(spark, path), WEEK_LOW, WEEK_HIGH))


# --- sessions ----------------------------------------------------------------


def session_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_micros(_sessionized(spark, sf_dir), "generated_session_id", "dt")


def session_ids_hot_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every user of 80 events or more taking the way of hot users."""
    labelled = sessions.sessionize(_events(spark, sf_dir), GAP_12H, hot_events=SKEWED_FROM)
    return _with_micros(calendar.with_local_date(labelled), "generated_session_id", "dt")


def session_ids_gap12h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_micros(_sessionized(spark, sf_dir, GAP_12H), "generated_session_id", "dt")


def _flags(
    spark: SparkSession, sf_dir: str, gap: int, hot_events: int = sessions.HOT_EVENTS
) -> DataFrame:
    return sessions.gap_seconds(_events(spark, sf_dir), hot_events=hot_events).select(
        "product_id",
        "user_id",
        "gap_seconds",
        sessions.new_session_flag(F.col("gap_seconds"), gap).alias("is_new_session"),
    )


def session_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir, GAP_5M)


def session_flags_hot_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir, GAP_12H, SKEWED_FROM)


def session_flags_gap12h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir, GAP_12H)


def cross_day_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.cross_day_sessions(_sessionized(spark, sf_dir, GAP_12H))


# --- dates -------------------------------------------------------------------


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.with_local_date(_events(spark, sf_dir))


def local_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_micros(_dated(spark, sf_dir), "dt")


def target_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.target_dates(_dated(spark, sf_dir))


def target_dates_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.target_dates(_dated(spark, sf_dir), RANGE_START, RANGE_END)


def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events on a range of dates, with the session IDs they have in the whole."""
    history = _dated(spark, sf_dir)
    wanted = calendar.date_range(history, RANGE_START, RANGE_END)
    return _with_micros(
        sessions.sessionize_within(wanted, history, GAP_12H), "generated_session_id", "dt"
    )


def date_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one date, with the session IDs they have in the whole."""
    history = _dated(spark, sf_dir)
    wanted = calendar.date_slice(history, SLICE_DATE)
    return _with_micros(
        sessions.sessionize_within(wanted, history, GAP_12H), "generated_session_id"
    )


# --- counts ------------------------------------------------------------------


def _week_as_text(weeks: DataFrame) -> DataFrame:
    # DATE in the library; text here, where two engines' results are compared.
    return weeks.withColumn("week_start", F.col("week_start").cast("string"))


def wau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _week_as_text(
        weekly.weekly_active_users(_events(spark, sf_dir), GAP_5M, WEEK_LOW, WEEK_HIGH)
    )


def wau_gap12h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _week_as_text(
        weekly.weekly_active_users(_events(spark, sf_dir), GAP_12H, WEEK_LOW, WEEK_HIGH)
    )


def week_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks of the events with their label under the default bounds as well."""
    monday = clock.week_start(F.col("dt"))
    weeks = _dated(spark, sf_dir).select(monday.alias("week_start")).distinct()
    return _week_as_text(
        weeks.withColumn("week_type", clock.week_type(F.col("week_start"), WEEK_LOW, WEEK_HIGH))
        .withColumn("default_week_type", clock.week_type(F.col("week_start"), *clock.WEEK_BOUNDS))
    )


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.daily_counts(_dated(spark, sf_dir))


def partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.partition_stats(_sessionized(spark, sf_dir, GAP_12H))


def user_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.user_event_counts(_events(spark, sf_dir))


def top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.top_users(_events(spark, sf_dir))


def skewed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.skewed_users(_events(spark, sf_dir), SKEWED_FROM)


def skewed_user_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.skewed_user_count(_events(spark, sf_dir), SKEWED_FROM)


# --- ledger ------------------------------------------------------------------
#
# A ledger derived from the dates of the events by day of month modulo 6:
# 0 never started; 1 finished; 2 finished with one row less than there is now;
# 3 in progress; 4 failed; 5 finished, but its output is gone.


def _dates_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.substring("dt", 9, 2).cast("int")
    return metrics.daily_counts(_dated(spark, sf_dir)).withColumn("rule", F.pmod(day, F.lit(6)))


def _counted_once(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The dates by rule as a table, for queries that use them several times."""
    path = scratch_path(spark, f"{name}-dates")
    dates = _dates_by_rule(spark, sf_dir)
    dates.coalesce(1).write.parquet(path)  # one row per date
    return spark.read.schema(dates.schema).parquet(path)


def _seed_begin(by_rule: DataFrame) -> DataFrame:
    started = by_rule.where("rule <> 0")
    dates = started.select(F.col("dt").alias("partition_date"))
    return ledger.begin(dates, SEED_RUN, SEED_START, 1)


def _seed_succeed(by_rule: DataFrame, state: DataFrame) -> DataFrame:
    counts = (
        by_rule.where(F.col("rule").isin(1, 2, 5))
        .select(
            F.col("dt").alias("partition_date"),
            (F.col("record_count") - F.when(F.col("rule") == 2, 1).otherwise(0)).alias("record_count"),
        )
    )
    return ledger.succeed(state, counts, SEED_END, 2)


def _seed_fail(by_rule: DataFrame, state: DataFrame) -> DataFrame:
    errors = (
        by_rule.where("rule in (0, 4)")  # dates never started are left out by ``fail``
        .select(
            F.col("dt").alias("partition_date"),
            F.repeat(F.lit(SEED_ERROR), SEED_ERROR_COPIES).alias("error_message"),
        )
    )
    return ledger.fail(state, errors, SEED_END, 3)


def _seeded_store(spark: SparkSession, by_rule: DataFrame, name: str) -> LedgerStore:
    store = LedgerStore.at(scratch_path(spark, name))
    store.create(spark)
    store.append(_seed_begin(by_rule))
    store.append(_seed_succeed(by_rule, store.current(spark)))
    store.append(_seed_fail(by_rule, store.current(spark)))
    return store


def _ledger_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "partition_date",
        "status",
        "run_id",
        F.unix_micros("start_time").alias("start_us"),
        F.unix_micros("end_time").alias("end_us"),
        "record_count",
        "error_message",
        "seq",
    )


def ledger_begin(spark: SparkSession, sf_dir: str) -> DataFrame:
    begun = _seed_begin(_dates_by_rule(spark, sf_dir))
    return _ledger_rows(begun).drop("end_us", "record_count", "error_message")


def ledger_succeed(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_rule = _counted_once(spark, sf_dir, "ledger_succeed")
    state = ledger.current(_seed_begin(by_rule))
    return _ledger_rows(_seed_succeed(by_rule, state)).drop("error_message")


def ledger_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_rule = _counted_once(spark, sf_dir, "ledger_fail")
    state = ledger.current(_seed_begin(by_rule))
    return _ledger_rows(_seed_fail(by_rule, state)).drop("record_count")


def ledger_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_rule = _counted_once(spark, sf_dir, "ledger_current")
    return _ledger_rows(_seeded_store(spark, by_rule, "ledger_current").current(spark))


def ledger_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of every date after the log has been folded, twice."""
    store = _seeded_store(spark, _counted_once(spark, sf_dir, "ledger_folded"), "ledger_folded")
    store.fold(spark)
    store.fold(spark)
    return _ledger_rows(store.log(spark))


def _plan(spark: SparkSession, sf_dir: str, name: str, detect_growth: bool) -> DataFrame:
    by_rule = _counted_once(spark, sf_dir, name)
    return ledger.plan(
        by_rule.drop("rule"),
        _seeded_store(spark, by_rule, name).current(spark),
        by_rule.where("rule <> 5").drop("rule"),
        detect_growth,
    ).select("dt", "source_count", "status", "recorded_count", "published_count", "action")


def ledger_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, "ledger_plan", True)


def ledger_plan_sizes_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, "ledger_plan_sizes_ignored", False)


# --- the batch job -----------------------------------------------------------


def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run over CSV files; what it published."""
    source = _csv_copy(spark, sf_dir, "batch_run")
    pipeline.run(
        spark,
        input_dir=source,
        output_dir=f"{source}-out",
        store=LedgerStore.at(f"{source}-ledger"),
        table=_scratch_table(source),
    )
    return _with_micros(publish.read_events(spark, f"{source}-out"), "generated_session_id", "dt")


def batch_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over the derived ledger and its output; every change it logged."""
    source = _csv_copy(spark, sf_dir, "batch_rerun")
    by_rule = _counted_once(spark, sf_dir, "batch_rerun")
    store = _seeded_store(spark, by_rule, "batch_rerun_ledger")
    day = F.substring("dt", 9, 2).cast("int")
    # From the files, whose times are whole seconds: published rows are theirs.
    earlier = weekly.sessionized_events(raw.read_raw_csv(spark, source))
    earlier = earlier.where(F.pmod(day, F.lit(6)) != 5)
    publish.write_dates(earlier, f"{source}-out")
    pipeline.run(
        spark,
        input_dir=source,
        output_dir=f"{source}-out",
        store=store,
        table=_scratch_table(source),
    )
    return store.log(spark).select("partition_date", "status", "record_count", "error_message")


def _second_run(
    spark: SparkSession, name: str, first: DataFrame, second: DataFrame, gap: int = GAP_5M
) -> tuple[pipeline.RunSummary, str]:
    """Two runs of the job into one table, from two folders of CSV files."""
    root = scratch_path(spark, name)
    store = LedgerStore.at(f"{root}-ledger")
    for turn, events in enumerate((first, second)):
        raw.write_raw_csv(events, f"{root}-in{turn}")
        summary = pipeline.run(
            spark,
            input_dir=f"{root}-in{turn}",
            output_dir=f"{root}-out",
            store=store,
            table=_scratch_table(root),
            gap=gap,
        )
    return summary, f"{root}-out"


def batch_rerun_part_of_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First the events up to the 15th, then a folder that begins within the
    15th and goes on to the end, with some rows of the 14th twice: no published
    row is lost, and the second folder's other dates are built."""
    dated = _dated(spark, sf_dir)
    day, hour = F.substring("dt", 9, 2).cast("int"), F.hour("event_time")
    first = dated.where(day <= 15)
    second = dated.where((day > 15) | (day == 15) & (hour >= 5))
    more = dated.where(day == 14)
    twice = more.unionByName(more.where("product_id % 7 = 0")).where("product_id % 3 > 0")
    _, output = _second_run(spark, "batch_rerun_part", first, second.unionByName(twice))
    return publish.published_counts(spark, output)


def _late_events(spark: SparkSession, sf_dir: str, name: str, gap: int) -> DataFrame:
    """First all events but every tenth, then all of them."""
    events = _events(spark, sf_dir)
    _, output = _second_run(spark, name, events.where("product_id % 10 <> 3"), events, gap)
    return _with_micros(publish.read_events(spark, output), "generated_session_id", "dt")


def batch_rerun_late_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_events(spark, sf_dir, "batch_rerun_late", GAP_5M)


def batch_rerun_late_event_gap12h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late events of one date only, which rename sessions on later dates."""
    dated = _dated(spark, sf_dir)
    early = dated.where(~((F.col("dt") == SLICE_DATE) & (F.col("product_id") % 2 == 1)))
    _, output = _second_run(spark, "batch_rerun_late12", early, dated, GAP_12H)
    return _with_micros(publish.read_events(spark, output), "generated_session_id", "dt")


def batch_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs recorded about the dates they built, each once."""
    dated = _dated(spark, sf_dir)
    first = dated.where(F.col("dt") <= SLICE_DATE)
    _, output = _second_run(spark, "batch_statistics", first, dated, GAP_5M)
    return spark.read.parquet(f"{output}-statistics").drop("run_id")


def batch_rerun_late_event_gap2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a gap of two days, over dates whose users are silent."""
    dated = _dated(spark, sf_dir)
    early = dated.where(~((F.col("dt") == SLICE_DATE) & (F.col("product_id") % 2 == 1)))
    _, output = _second_run(spark, "batch_rerun_late2d", early, dated, GAP_2D)
    return _with_micros(publish.read_events(spark, output), "generated_session_id", "dt")


# --- folders that follow one another -----------------------------------------


def _extended(spark: SparkSession, name: str, parts: list[DataFrame], gap: int) -> tuple[str, LedgerStore]:
    """A table filled from one folder of CSV files after the other."""
    root = scratch_path(spark, name)
    store = LedgerStore.at(f"{root}-ledger")
    for turn, events in enumerate(parts):
        raw.write_raw_csv(events, f"{root}-in{turn}")
        extend.extend(
            spark, input_dir=f"{root}-in{turn}", output_dir=f"{root}-out", store=store, gap=gap
        )
    return f"{root}-out", store


def _halves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All events in two, cut within a local date and within sessions."""
    events = _events(spark, sf_dir)
    early = F.col("event_time") < F.lit(CUT_TIME).cast("timestamp")
    return [events.where(early), events.where(~early)]


def batch_two_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions over the edge of two folders, the second read without the first."""
    output, _ = _extended(spark, "batch_two_folders", _halves(spark, sf_dir), GAP_12H)
    return _with_micros(versions.read_manifest(spark, output), "generated_session_id", "dt")


def batch_late_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First all events but those of one date with odd numbers, then these, then
    they again: later dates whose sessions they change are labelled anew."""
    dated = _dated(spark, sf_dir)
    late = (F.col("dt") == SLICE_DATE) & (F.col("product_id") % 2 == 1)
    parts = [dated.where(~late), dated.where(late), dated.where(late)]
    output, _ = _extended(spark, "batch_late_folder", parts, GAP_12H)
    return _with_micros(versions.read_manifest(spark, output), "generated_session_id", "dt")


def batch_two_folders_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    output, store = _extended(spark, "batch_two_folders_ledger", _halves(spark, sf_dir), GAP_12H)
    counts = versions.manifest_counts(spark, output).withColumnRenamed("record_count", "published_count")
    state = store.current(spark).withColumnRenamed("partition_date", "dt")
    return state.join(counts, "dt").select("dt", "status", "record_count", "published_count")


def publish_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second publication that loses rows is refused; the table afterwards."""
    path = scratch_path(spark, "publish_rollback")
    table = _scratch_table(path)
    catalog.ensure_table(spark, path, table)
    labelled = _sessionized(spark, sf_dir, GAP_12H)
    expected = {r["dt"]: r["record_count"] for r in metrics.daily_counts(labelled).collect()}
    versions.publish_version(labelled, path, table, expected)
    try:
        versions.publish_version(labelled.where("product_id % 10 <> 3"), path, table, expected)
        raise AssertionError("rows were lost unseen")
    except versions.CountsDiffer:
        return _with_micros(catalog.read_table(spark, table), "generated_session_id", "dt")


def _in_three_runs(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Half of the dates twice, the other half once, and a run that never ended."""
    path = scratch_path(spark, name)
    labelled = _sessionized(spark, sf_dir, GAP_12H)
    early = labelled.where(F.col("dt") <= SLICE_DATE)
    parts = (early.where("product_id % 2 = 0"), labelled.where(F.col("dt") > SLICE_DATE), early)
    for part in parts:
        expected = {r["dt"]: r["record_count"] for r in metrics.daily_counts(part).collect()}
        versions.publish_to_manifest(part, path, expected)
    publish.write_dates(early, f"{path}/{versions.VERSIONS}/run=unfinished")
    return path


def publish_manifest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _in_three_runs(spark, sf_dir, "publish_manifest")
    return _with_micros(versions.read_manifest(spark, path), "generated_session_id", "dt")


def publish_replaced_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of the versions' folders once the replaced runs are removed."""
    path = _in_three_runs(spark, sf_dir, "publish_replaced")
    versions.remove_replaced(spark, path)
    left = publish.read_events(spark, f"{path}/{versions.VERSIONS}")
    return _with_micros(left, "generated_session_id", "dt")


def published_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rows of all dates and of one that is not there, by their folders."""
    path = _published(spark, sf_dir, "published_dates", GAP_12H)
    dates = [row["dt"] for row in calendar.target_dates(_dated(spark, sf_dir)).collect()]  # one per day
    return _with_micros(publish.read_dates(spark, path, [*dates, "1999-01-01"]), "generated_session_id", "dt")


def ledger_plan_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dates finished; since then on every third day one row has another time."""
    dated = _dated(spark, sf_dir)
    name = "ledger_plan_content"
    store = LedgerStore.at(scratch_path(spark, name))
    store.create(spark)
    counted = content.fingerprints(dated).withColumnRenamed("dt", "partition_date")
    store.append(ledger.begin(counted.select("partition_date"), SEED_RUN, SEED_START, 1))
    store.append(ledger.succeed(store.current(spark), counted, SEED_END, 2))
    first = Window.partitionBy("dt").orderBy("product_id")
    other = (F.row_number().over(first) == 1) & (F.substring("dt", 9, 2).cast("int") % 3 == 0)
    moved = dated.withColumn("event_time", F.when(other, F.col("event_time") - F.expr("interval 1 microsecond")).otherwise(F.col("event_time")))
    now = content.fingerprints(moved)
    return ledger.plan(now, store.current(spark), metrics.daily_counts(dated)).select(
        "dt", "source_count", "recorded_count", "action"
    )


# --- one user, many tasks; many users, few counts ----------------------------


def session_ids_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions by the two-level scan at the shortest gap."""
    labelled = scan.sessionize_by_scan(_events(spark, sf_dir), GAP_1S)
    return _with_micros(calendar.with_local_date(labelled), "generated_session_id", "dt")


def session_ids_scan_gap12h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in slices of two cells, which sessions go through."""
    labelled = scan.sessionize_by_scan(_events(spark, sf_dir), GAP_12H, slice_cells=2)
    return _with_micros(calendar.with_local_date(labelled), "generated_session_id", "dt")


def top_users_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy.top_users(_events(spark, sf_dir), fullest=16)


def stats_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a range from a written table of daily sketches: counts, and
    whether the estimates are within the stated error of the distinct values."""
    path = scratch_path(spark, "stats_of_range")
    labelled = _sessionized(spark, sf_dir, GAP_12H)
    sketches.date_sketches(labelled).write.partitionBy("dt").parquet(path)
    found = sketches.range_statistics(calendar.date_range(spark.read.parquet(path), RANGE_START, RANGE_END))
    columns = metrics.STATISTICS_COLUMNS
    exact = calendar.date_range(labelled, RANGE_START, RANGE_END).agg(
        *[F.countDistinct(c).alias(f"{c}_exact") for c in columns]
    )
    near = [
        (F.abs(F.col(f"{c}_distinct") - F.col(f"{c}_exact")) <= F.ceil(F.col(f"{c}_exact") * sketches.ERROR)).alias(f"{c}_within")
        for c in columns
    ]
    # One row on either side.
    return found.join(exact, F.lit(True)).select("row_count", *[f"{c}_nulls" for c in columns], *near)


def raw_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per date, rows of CSV files in which every seventh line is damaged."""
    root = scratch_path(spark, "raw_csv_rejects")
    damaged = F.when(F.col("product_id") % 7 == 0, F.concat(F.lit("x"), F.col("price"))).otherwise(F.col("price").cast("string"))
    raw.write_raw_csv(_events(spark, sf_dir).withColumn("price", damaged), f"{root}-in")
    raw.read_raw_csv_with_rejects(spark, f"{root}-in").write.parquet(f"{root}-staged")
    dated = calendar.with_local_date(spark.read.parquet(f"{root}-staged"))
    rejected = F.col(raw.REJECTED).isNotNull()
    return dated.groupBy("dt").agg(
        F.count("*").alias("record_count"),
        F.count_if(rejected).alias("rejected"),
        F.count_if(rejected & F.col("price").isNull()).alias("without_price"),
    )


# --- weekly counts from what dates keep --------------------------------------


def wau_from_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly users, united from a written table of daily bitmaps."""
    path = scratch_path(spark, "wau_from_bitmaps")
    mergeable.user_bitmaps(_dated(spark, sf_dir)).write.partitionBy("dt").parquet(path)
    daily = spark.read.schema("bucket bigint, users binary, dt string").parquet(path)
    return _week_as_text(mergeable.users_per_week(daily))


def wau_sessions_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly sessions, summed from a written table of daily states."""
    path = scratch_path(spark, "wau_sessions_additive")
    carried.session_state(_sessionized(spark, sf_dir, GAP_12H)).write.partitionBy("dt").parquet(path)
    return _week_as_text(mergeable.sessions_per_week(spark.read.schema(carried.STATE).parquet(path)))


def _with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth event three times."""
    events = _events(spark, sf_dir)
    tenth = events.where("product_id % 10 = 3")
    return events.unionByName(tenth).unionByName(tenth)


def _copied_flags(spark: SparkSession, sf_dir: str, hot_events: int) -> DataFrame:
    found = sessions.gap_seconds(_with_copies(spark, sf_dir), hot_events=hot_events)
    is_new = sessions.new_session_flag(F.col("gap_seconds"), GAP_5M)
    return found.select("product_id", "user_id", "gap_seconds", is_new.alias("is_new_session"))


def session_flags_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _copied_flags(spark, sf_dir, sessions.HOT_EVENTS)


def session_flags_copies_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _copied_flags(spark, sf_dir, SKEWED_FROM)


def entry(spark: SparkSession) -> DataFrame:
    """Weekly active users and sessions of the smallest test folder."""
    return wau(spark, "/root/testdata/sf0.001")


_QUERIES = (
    raw_csv_scan,
    publish_roundtrip,
    published_counts,
    catalog_table,
    wau_published,
    wau_sql_on_table,
    session_ids,
    session_ids_gap12h,
    session_ids_hot_users,
    session_flags,
    session_flags_gap12h,
    session_flags_hot_users,
    cross_day_sessions,
    local_dates,
    target_dates,
    target_dates_in_range,
    date_range,
    date_slice,
    wau,
    wau_gap12h,
    week_types,
    daily_counts,
    partition_stats,
    user_event_counts,
    top_users,
    skewed_users,
    skewed_user_count,
    ledger_begin,
    ledger_succeed,
    ledger_fail,
    ledger_current,
    ledger_folded,
    ledger_plan,
    ledger_plan_sizes_ignored,
    batch_run,
    batch_rerun,
    batch_rerun_part_of_input,
    batch_rerun_late_event,
    batch_rerun_late_event_gap12h,
    batch_rerun_late_event_gap2d,
    batch_two_folders,
    batch_two_folders_ledger,
    batch_late_folder,
    publish_rollback,
    publish_manifest_roundtrip,
    publish_replaced_removed,
    published_dates,
    ledger_plan_content,
    session_ids_scan,
    session_ids_scan_gap12h,
    top_users_sketched,
    stats_of_range,
    raw_csv_rejects,
    wau_from_bitmaps,
    wau_sessions_additive,
    batch_statistics,
    session_flags_copies,
    session_flags_copies_hot,
)


try:  # the text operators and their pipeline are an optional part
    import corpus_pipeline
    from tidemark.llm import queries as text_queries
except ImportError:
    _HERE = os.path.dirname(os.path.abspath(__file__))
    _PARTS = ("corpus_pipeline.py", os.path.join("tidemark", "llm", "__init__.py"))
    if all(os.path.exists(os.path.join(_HERE, part)) for part in _PARTS):
        raise
    text_queries = None


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries over the ``events`` table."""
    return {query.__name__: query for query in _QUERIES}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if text_queries is None:
        return core_queries()
    text = {**text_queries.queries(), "pipeline": corpus_pipeline.run}
    return {**core_queries(), **{name: _shipped(query) for name, query in text.items()}}


def _shipped(query: Callable[[SparkSession, str], DataFrame]):
    """The query, with this package sent to the executors' Python before it runs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


# --- the same in SQL ---------------------------------------------------------

_EVENT = (
    "event_us, event_type, product_id, category_id, price, user_id"
)

_RAW = """
raw AS (
  SELECT ts, epoch_us(ts) AS event_us, epoch_us(ts) // 1000000 AS sec, event_type,
         CAST(event_id AS INTEGER) AS product_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS category_id,
         value AS price, user_id,
         strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS dt
  FROM events)"""


_COPIES = """
copies AS (
  SELECT * FROM raw UNION ALL
  SELECT raw.* FROM raw, range(2) WHERE product_id % 10 = 3)"""


def _sessions_sql(gap: int, source: str = "raw") -> str:
    return f"""WITH {_RAW}, {_COPIES},
gaps AS (
  SELECT *, sec - lag(sec) OVER (
    PARTITION BY user_id ORDER BY ts, event_type, product_id) AS gap_seconds
  FROM {source}),
flags AS (
  SELECT *, gap_seconds IS NULL OR gap_seconds >= {gap} AS is_new_session FROM gaps),
starts AS (
  SELECT *, last_value(CASE WHEN is_new_session THEN ts END IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY ts, event_type, product_id, gap_seconds DESC
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_start
  FROM flags),
sessionized AS (
  SELECT *, CAST(user_id AS VARCHAR) || '_' || strftime(session_start, '%Y%m%d%H%M%S')
    AS generated_session_id
  FROM starts)
"""


def _wau_sql(gap: int) -> str:
    return _sessions_sql(gap) + f""",
weeks AS (
  SELECT date_trunc('week', CAST(dt AS DATE)) AS monday, user_id, generated_session_id
  FROM sessionized)
SELECT CAST(CAST(monday AS DATE) AS VARCHAR) AS week_start,
       count(DISTINCT user_id) AS wau_by_user,
       count(DISTINCT generated_session_id) AS wau_by_session,
       CASE WHEN monday < DATE '{WEEK_LOW}' OR monday + INTERVAL 6 DAY > DATE '{WEEK_HIGH}'
            THEN 'PARTIAL' ELSE 'FULL' END AS week_type
FROM weeks GROUP BY monday ORDER BY monday"""


_DAILY = f"""WITH {_RAW},
daily AS (
  SELECT dt, count(*) AS record_count, CAST(substr(dt, 9, 2) AS INTEGER) % 6 AS rule
  FROM raw GROUP BY dt)
"""

_SEED_START_US = int(SEED_START.timestamp()) * 1_000_000
_SEED_END_US = int(SEED_END.timestamp()) * 1_000_000

_SEED_STATE = f"""
state AS (
  SELECT dt,
    CASE WHEN rule IN (1, 2, 5) THEN 'SUCCESS' WHEN rule = 3 THEN 'IN_PROGRESS'
         ELSE 'FAILED' END AS status,
    CASE WHEN rule IN (1, 5) THEN record_count WHEN rule = 2 THEN record_count - 1 END
      AS recorded_count,
    CASE WHEN rule = 4 THEN substr(repeat('{SEED_ERROR}', {SEED_ERROR_COPIES}), 1, 1000) END
      AS error_message,
    CASE WHEN rule <> 3 THEN {_SEED_END_US} END AS end_us,
    CASE WHEN rule = 3 THEN 1 WHEN rule = 4 THEN 3 ELSE 2 END AS seq
  FROM daily WHERE rule <> 0)
"""


def _plan_sql(grown: str) -> str:
    return _DAILY + f""", {_SEED_STATE}
SELECT d.dt, d.record_count AS source_count, s.status, s.recorded_count,
       CASE WHEN d.rule <> 5 THEN d.record_count END AS published_count,
       CASE d.rule WHEN 0 THEN 'BUILD' WHEN 1 THEN 'SKIP' WHEN 2 THEN '{grown}'
                   WHEN 3 THEN 'REBUILD_STALE' WHEN 4 THEN 'REBUILD_FAILED'
                   ELSE 'REBUILD_MISSING' END AS action
FROM daily d LEFT JOIN state s ON s.dt = d.dt"""


_STATISTICS = """SELECT dt, count(*) AS row_count,
       count(DISTINCT user_id) AS user_id_distinct,
       count(*) - count(user_id) AS user_id_nulls,
       min(user_id) AS user_id_min, max(user_id) AS user_id_max,
       count(DISTINCT event_type) AS event_type_distinct,
       count(*) - count(event_type) AS event_type_nulls,
       count(DISTINCT generated_session_id) AS generated_session_id_distinct,
       count(*) - count(generated_session_id) AS generated_session_id_nulls
FROM sessionized GROUP BY dt"""


def oracle_sql() -> dict[str, str]:
    if text_queries is None:
        return core_sql()
    more = {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {**core_sql(), **text_queries.oracle_sql(), **{k: v for k, v in more.items() if v}}


def core_sql() -> dict[str, str]:
    five, half_day = _sessions_sql(GAP_5M), _sessions_sql(GAP_12H)
    with_raw = f"WITH {_RAW}\n"
    published = f"SELECT {_EVENT}, generated_session_id, dt FROM sessionized"
    # CSV text holds whole seconds.
    truncated = _EVENT.replace("event_us", "sec * 1000000 AS event_us")
    truncated_rows = f"SELECT {truncated}, generated_session_id, dt FROM sessionized"
    flags = "SELECT product_id, user_id, gap_seconds, is_new_session FROM flags"
    users = "SELECT user_id, count(*) AS event_count FROM events GROUP BY user_id"
    counts = "SELECT dt, record_count FROM daily"
    return {
        "raw_csv_scan": f"{with_raw}SELECT {truncated} FROM raw",
        "publish_roundtrip": five + published,
        "published_counts": _DAILY + counts,
        "catalog_table": five + published,
        "wau_published": _wau_sql(GAP_12H),
        "wau_sql_on_table": _wau_sql(GAP_12H),
        "session_ids": five + published,
        "session_ids_gap12h": half_day + published,
        "session_ids_hot_users": half_day + published,
        "session_flags": five + flags,
        "session_flags_gap12h": half_day + flags,
        "session_flags_hot_users": half_day + flags,
        "cross_day_sessions": half_day
        + "SELECT generated_session_id, min(dt) AS first_dt, max(dt) AS last_dt,"
        " count(*) AS event_count FROM sessionized"
        " GROUP BY generated_session_id HAVING min(dt) < max(dt)",
        "local_dates": f"{with_raw}SELECT {_EVENT}, dt FROM raw",
        "target_dates": f"{with_raw}SELECT DISTINCT dt FROM raw ORDER BY dt",
        "target_dates_in_range": f"{with_raw}SELECT DISTINCT dt FROM raw"
        f" WHERE dt BETWEEN '{RANGE_START}' AND '{RANGE_END}' ORDER BY dt",
        "date_range": half_day
        + published
        + f" WHERE dt BETWEEN '{RANGE_START}' AND '{RANGE_END}'",
        "date_slice": half_day
        + f"SELECT {_EVENT}, generated_session_id FROM sessionized WHERE dt = '{SLICE_DATE}'",
        "wau": _wau_sql(GAP_5M),
        "wau_gap12h": _wau_sql(GAP_12H),
        "week_types": f"""WITH {_RAW},
weeks AS (SELECT DISTINCT CAST(date_trunc('week', CAST(dt AS DATE)) AS DATE) AS monday FROM raw)
SELECT CAST(monday AS VARCHAR) AS week_start,
       CASE WHEN monday < DATE '{WEEK_LOW}' OR monday + INTERVAL 6 DAY > DATE '{WEEK_HIGH}'
            THEN 'PARTIAL' ELSE 'FULL' END AS week_type,
       CASE WHEN monday < DATE '2019-10-01' OR monday + INTERVAL 6 DAY > DATE '2019-12-01'
            THEN 'PARTIAL' ELSE 'FULL' END AS default_week_type
FROM weeks""",
        "daily_counts": _DAILY + counts,
        "partition_stats": half_day
        + _STATISTICS,
        "user_event_counts": users,
        "top_users": users + " ORDER BY event_count DESC, user_id LIMIT 10",
        "skewed_users": users + f" HAVING count(*) >= {SKEWED_FROM}",
        "skewed_user_count": "SELECT count(*) AS skewed_users FROM ("
        + users
        + f" HAVING count(*) >= {SKEWED_FROM})",
        "ledger_begin": _DAILY
        + f"SELECT dt AS partition_date, 'IN_PROGRESS' AS status, '{SEED_RUN}' AS run_id,"
        f" CAST({_SEED_START_US} AS BIGINT) AS start_us, CAST(1 AS BIGINT) AS seq"
        " FROM daily WHERE rule <> 0",
        "ledger_succeed": _DAILY
        + f"SELECT dt AS partition_date, 'SUCCESS' AS status, '{SEED_RUN}' AS run_id,"
        f" CAST({_SEED_START_US} AS BIGINT) AS start_us, CAST({_SEED_END_US} AS BIGINT) AS end_us,"
        " record_count - CASE WHEN rule = 2 THEN 1 ELSE 0 END AS record_count,"
        " CAST(2 AS BIGINT) AS seq FROM daily WHERE rule IN (1, 2, 5)",
        "ledger_fail": _DAILY
        + f"SELECT dt AS partition_date, 'FAILED' AS status, '{SEED_RUN}' AS run_id,"
        f" CAST({_SEED_START_US} AS BIGINT) AS start_us, CAST({_SEED_END_US} AS BIGINT) AS end_us,"
        f" substr(repeat('{SEED_ERROR}', {SEED_ERROR_COPIES}), 1, 1000) AS error_message,"
        " CAST(3 AS BIGINT) AS seq FROM daily WHERE rule = 4",
        "ledger_current": _DAILY
        + f""", {_SEED_STATE}
SELECT dt AS partition_date, status, '{SEED_RUN}' AS run_id,
       CAST({_SEED_START_US} AS BIGINT) AS start_us, CAST(end_us AS BIGINT) AS end_us,
       recorded_count AS record_count, error_message, CAST(seq AS BIGINT) AS seq
FROM state""",
        "ledger_folded": _DAILY
        + f""", {_SEED_STATE}
SELECT dt AS partition_date, status, '{SEED_RUN}' AS run_id,
       CAST({_SEED_START_US} AS BIGINT) AS start_us, CAST(end_us AS BIGINT) AS end_us,
       recorded_count AS record_count, error_message, CAST(seq AS BIGINT) AS seq
FROM state""",
        "ledger_plan": _plan_sql("REBUILD_GREW"),
        "ledger_plan_sizes_ignored": _plan_sql("SKIP"),
        "batch_run": five
        + f"SELECT {truncated}, generated_session_id, dt FROM sessionized",
        "batch_rerun_part_of_input": _DAILY
        + counts,
        "batch_rerun_late_event": five + f"SELECT {truncated}, generated_session_id, dt FROM sessionized",
        "batch_rerun_late_event_gap12h": half_day
        + f"SELECT {truncated}, generated_session_id, dt FROM sessionized",
        "batch_rerun_late_event_gap2d": _sessions_sql(GAP_2D) + truncated_rows,
        "batch_two_folders": half_day + truncated_rows,
        "batch_late_folder": half_day + truncated_rows,
        "batch_two_folders_ledger": _DAILY
        + "SELECT dt, 'SUCCESS' AS status, record_count, record_count AS published_count FROM daily",
        "publish_rollback": half_day + published,
        "publish_manifest_roundtrip": half_day + published,
        "publish_replaced_removed": half_day + published,
        "published_dates": half_day + published,
        "ledger_plan_content": _DAILY
        + "SELECT dt, record_count AS source_count, record_count AS recorded_count,"
        " CASE WHEN CAST(substr(dt, 9, 2) AS INTEGER) % 3 = 0 THEN 'REBUILD_CHANGED' ELSE 'SKIP' END"
        " AS action FROM daily",
        "session_ids_scan": _sessions_sql(GAP_1S) + published,
        "session_ids_scan_gap12h": half_day + published,
        "top_users_sketched": users + " ORDER BY event_count DESC, user_id LIMIT 10",
        "stats_of_range": half_day
        + "SELECT count(*) AS row_count, count(*) - count(user_id) AS user_id_nulls,"
        " count(*) - count(event_type) AS event_type_nulls,"
        " count(*) - count(generated_session_id) AS generated_session_id_nulls,"
        " true AS user_id_within, true AS event_type_within, true AS generated_session_id_within"
        f" FROM sessionized WHERE dt BETWEEN '{RANGE_START}' AND '{RANGE_END}'",
        "raw_csv_rejects": f"{with_raw}SELECT dt, count(*) AS record_count,"
        " count(CASE WHEN product_id % 7 = 0 THEN 1 END) AS rejected,"
        " count(CASE WHEN product_id % 7 = 0 THEN 1 END) AS without_price FROM raw GROUP BY dt",
        "wau_from_bitmaps": f"SELECT week_start, wau_by_user FROM ({_wau_sql(GAP_12H)})",
        "wau_sessions_additive": f"SELECT week_start, wau_by_session FROM ({_wau_sql(GAP_12H)})",
        "batch_statistics": five + _STATISTICS,
        "session_flags_copies": _sessions_sql(GAP_5M, "copies") + flags,
        "session_flags_copies_hot": _sessions_sql(GAP_5M, "copies") + flags,
        "batch_rerun": _DAILY
        + f""", {_SEED_STATE}
SELECT dt AS partition_date, 'IN_PROGRESS' AS status, CAST(NULL AS BIGINT) AS record_count,
       CAST(NULL AS VARCHAR) AS error_message
FROM daily WHERE rule <> 0
UNION ALL
SELECT dt, status, recorded_count, error_message FROM state WHERE status <> 'IN_PROGRESS'
UNION ALL
SELECT dt, 'FAILED', CASE WHEN rule = 5 THEN record_count END,
       CASE rule WHEN 3 THEN 'Restarted after IN_PROGRESS'
                 ELSE 'Output files missing after SUCCESS' END
FROM daily WHERE rule IN (3, 5)
UNION ALL
SELECT dt, 'IN_PROGRESS', NULL, NULL FROM daily WHERE rule <> 1
UNION ALL
SELECT dt, 'SUCCESS', record_count, NULL FROM daily WHERE rule <> 1""",
    }
