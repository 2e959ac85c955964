"""Publishing without touching what is published: versions and manifests.

A run writes its dates to a folder of its own and counts what it wrote. Only
then is it made visible, either by pointing the table's partitions to it, or by
adding its files to a manifest that readers follow. No file is moved or
overwritten, so a run that fails at any point leaves the old rows as they were,
and stores where a move is a copy pay nothing for a commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.metrics import daily_counts
from tidemark.schema import DATE, EVENTS
from tidemark.sources import publish
from tidemark.sources.catalog import DATES_PER_STATEMENT, quoted
from tidemark.sources.files import folders, remove_files

VERSIONS, STATES, MANIFESTS = "versions", "states", "manifests"

_COLUMNS = tuple(EVENTS.names)

MANIFEST = f"{DATE} string, run_id string, path string, record_count bigint, seq bigint"


class CountsDiffer(RuntimeError):
    """What a run wrote is not what it was to write; nothing has been changed."""


def _folder(root: str, run_id: str, kind: str = VERSIONS) -> str:
    return f"{root.rstrip('/')}/{kind}/run={run_id}"


def write_version(
    dated: DataFrame, root: str, expected: Mapping[str, int], run_id: str | None = None
) -> str:
    """Write dates to a folder of the run and count them there; its path.

    Raises :class:`CountsDiffer` unless it holds ``expected`` rows of every date
    and no others. Nobody reads the folder yet, in either case.
    """
    spark = dated.sparkSession
    folder = _folder(root, run_id or uuid.uuid4().hex)
    publish.write_dates(dated, folder)
    written = {r[DATE]: r["record_count"] for r in daily_counts(_read(spark, folder)).collect()}  # dates
    wrong = sorted(d for d in written.keys() | expected.keys() if written.get(d) != expected.get(d))
    if wrong:
        raise CountsDiffer(f"row counts differ from the input on {', '.join(wrong)}")
    return folder


def _read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(folder)


def switch(spark: SparkSession, folder: str, dates: Iterable[str], table: str) -> None:
    """Point the table's partitions of ``dates`` to a version's folder.

    A date is switched by one statement, so a reader that plans a query sees its
    old rows or its new ones. Run again after a driver was lost on the way.
    """
    names = sorted(set(dates))
    for i in range(0, len(names), DATES_PER_STATEMENT):
        some = names[i : i + DATES_PER_STATEMENT]
        clauses = " ".join(
            f"PARTITION ({DATE}={quoted(d)}) LOCATION {quoted(f'{folder}/{DATE}={d}')}" for d in some
        )
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {clauses}")
    for d in names:
        spark.sql(
            f"ALTER TABLE {table} PARTITION ({DATE}={quoted(d)}) SET LOCATION {quoted(f'{folder}/{DATE}={d}')}"
        )
    spark.catalog.refreshTable(table)


def publish_version(
    dated: DataFrame, root: str, table: str, expected: Mapping[str, int], run_id: str | None = None
) -> str:
    """Replace the dates of a catalog table, or leave all as it is and raise."""
    folder = write_version(dated, root, expected, run_id)
    switch(dated.sparkSession, folder, expected, table)
    return folder


# --- manifests ---------------------------------------------------------------


def _manifests(root: str) -> str:
    return f"{root.rstrip('/')}/{MANIFESTS}"


def create_manifest(spark: SparkSession, root: str) -> None:
    """An empty manifest unless there is one."""
    spark.createDataFrame([], MANIFEST).write.mode("ignore").parquet(_manifests(root))


def commit_manifest(spark: SparkSession, root: str, folder: str, run_id: str) -> None:
    """Add a version's files: from here on they are the rows of their dates.

    One small file appears at once, with a row per data file. Runs that commit
    to one manifest must not overlap.
    """
    log = spark.read.schema(MANIFEST).parquet(_manifests(root))
    seq = log.agg(F.coalesce(F.max("seq"), F.lit(0)) + 1).first()[0]
    files = (
        _read(spark, folder)
        .groupBy(DATE, F.col("_metadata.file_path").alias("path"))
        .agg(F.count("*").alias("record_count"))
        .select(DATE, F.lit(run_id).alias("run_id"), "path", "record_count", F.lit(seq).cast("bigint").alias("seq"))
    )
    files.coalesce(1).write.mode("append").parquet(_manifests(root))


def publish_to_manifest(dated: DataFrame, root: str, expected: Mapping[str, int], run_id: str | None = None) -> str:
    """Replace dates of a table that is read by its manifest, or raise and leave it."""
    run_id = run_id or uuid.uuid4().hex
    create_manifest(dated.sparkSession, root)
    folder = write_version(dated, root, expected, run_id)
    commit_manifest(dated.sparkSession, root, folder, run_id)
    return folder


def current_files(spark: SparkSession, root: str) -> DataFrame:
    """``dt, run_id, path, record_count`` of the files that are the table now."""
    log = spark.read.schema(MANIFEST).parquet(_manifests(root))
    latest = log.groupBy(DATE).agg(F.max("seq").alias("seq"))
    return log.join(latest, [DATE, "seq"]).drop("seq")


def read_manifest(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Published events of the dates ``start``..``end``, by the manifest alone.

    Lists no folder: the paths, one per file, come from the manifest, as they
    would from a listing. Files of unfinished or replaced runs are not read.
    """
    files = current_files(spark, root)
    if start is not None:
        files = files.where(F.col(DATE) >= start)
    if end is not None:
        files = files.where(F.col(DATE) <= end)
    paths = [row["path"] for row in files.select("path").orderBy("path").collect()]
    if not paths:
        return spark.createDataFrame([], EVENTS)
    reader = spark.read.schema(StructType([*EVENTS.fields, StructField("run", StringType())])).option("basePath", f"{root.rstrip('/')}/{VERSIONS}")
    return reader.parquet(*paths).select(*_COLUMNS)


def remove_replaced(spark: SparkSession, root: str) -> list[str]:
    """Remove what no date of the table is read from any more; the runs removed.

    Those are replaced runs and runs that were never committed, so no run may be
    writing: hold the table's claim. A reader that planned its query before loses
    its files. A run that still has one date stays whole.
    """
    current = set(current_runs(spark, root).values())
    gone = set()
    for kind in (VERSIONS, STATES):
        for name in folders(spark, f"{root.rstrip('/')}/{kind}"):
            run_id = name.removeprefix("run=")
            if name != run_id and run_id not in current:
                remove_files(spark, [_folder(root, run_id, kind)])
                gone.add(run_id)
    return sorted(gone)


def manifest_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows per published date, from the manifest alone."""
    return current_files(spark, root).groupBy(DATE).agg(F.sum("record_count").alias("record_count"))


def current_runs(spark: SparkSession, root: str) -> dict[str, str]:
    """The run that every published date is from; one entry per date."""
    rows = current_files(spark, root).select(DATE, "run_id").distinct().collect()
    return {row[DATE]: row["run_id"] for row in rows}


def write_states(states: DataFrame, root: str, run_id: str) -> None:
    """Keep what a run knows of its dates besides their rows; it becomes current
    together with them, when the run is committed."""
    states.hint("rebalance", DATE).write.partitionBy(DATE).parquet(_folder(root, run_id, STATES))


def read_states(spark: SparkSession, root: str, schema: str, runs: Mapping[str, str]) -> DataFrame:
    """What the given runs, one per date, keep of those dates; reads only them."""
    paths = sorted({_folder(root, run, STATES) for run in runs.values()})
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(f"{schema}, run string").option("basePath", f"{root.rstrip('/')}/{STATES}")
    wanted = F.concat_ws(" ", DATE, "run").isin([f"{d} {run}" for d, run in runs.items()])
    # The dates alone prune; the pair decides.
    found = reader.parquet(*paths).where(F.col(DATE).isin(list(runs)) & wanted)
    return found.drop("run")
