"""The published table: Parquet files, one directory per local date."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.metrics import daily_counts
from tidemark.schema import DATE, EVENTS
from tidemark.sources.files import present


def write_dates(dated: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    """Replace exactly the dates that occur in ``dated``; leave the others.

    One job for all dates. The rebalance shuffle gives each date a few files
    of the advisory size: it splits a date that holds most of the rows over
    many tasks and merges small ones. Files are staged by Spark's committer
    and moved at commit, so a failed job changes nothing; a reader that lists
    files during the commit can still see a mix of dates.

    Dynamic overwrite needs Spark's own commit protocol with Hadoop's file
    output committers, which move files at commit. On an object store a move is
    a copy; committers that upload in place, such as the magic and the EMRFS
    ones, reject dynamic overwrite or fall back to moves. There, write
    to a file system with renames, or one date at a time to ``path/dt=...``
    with plain overwrite.
    """
    (
        dated.select(*EVENTS.names)
        .hint("rebalance", DATE)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(DATE)
        .parquet(path)
    )


def ensure_root(spark: SparkSession, path: str) -> None:
    """Create an empty published table at ``path`` unless something is there."""
    (
        spark.createDataFrame([], EVENTS)
        .write.mode("ignore")
        .partitionBy(DATE)
        .parquet(path)
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Published events. The schema is given, or ``dt`` would be read as DATE."""
    return spark.read.schema(EVENTS).parquet(path)


def read_dates(spark: SparkSession, path: str, dates: Iterable[str]) -> DataFrame:
    """Published events of some dates; other folders are not listed.

    ``dates`` are local dates as text; those that are not published give no rows.
    """
    root, wanted = path.rstrip("/"), sorted(set(dates))
    there = present(spark, [f"{root}/{DATE}={date}" for date in wanted])
    if not there:
        return spark.createDataFrame([], EVENTS)
    found = spark.read.schema(EVENTS).option("basePath", root).parquet(*there)
    return found.where(F.col(DATE).isin(wanted))


def published_counts(
    spark: SparkSession, path: str, dates: Sequence[str] | None = None
) -> DataFrame:
    """Rows per published date; a date without rows is absent.

    Reads no column, only the row counts in the file footers. With ``dates`` only
    their folders are looked at, however many others the table has.
    """
    if dates is None:
        return daily_counts(read_events(spark, path))
    return daily_counts(read_dates(spark, path, dates))
