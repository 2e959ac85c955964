"""State of every local date, kept as a log of changes.

A change is a new row; the latest row of a date is its state. Rows are one per
date and run, so every frame here is small.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schema import DATE, LEDGER

# Fixed values.
IN_PROGRESS, SUCCESS, FAILED = "IN_PROGRESS", "SUCCESS", "FAILED"
ERROR_LENGTH = 1000
MISSING_OUTPUT = "Output files missing after SUCCESS"
STALE_RUN = "Restarted after IN_PROGRESS"

# What to do about a date.
BUILD = "BUILD"
SKIP = "SKIP"
REBUILD_GREW = "REBUILD_GREW"
REBUILD_CHANGED = "REBUILD_CHANGED"
REBUILD_MISSING = "REBUILD_MISSING"
REBUILD_STALE = "REBUILD_STALE"
REBUILD_FAILED = "REBUILD_FAILED"
# Chosen by the job once it has looked at rows: a finished date whose sessions
# changed with a neighbour, and a date whose output holds rows the input lacks.
REBUILD_SESSION = "REBUILD_SESSION"
KEEP_NOT_CONTAINED = "KEEP_NOT_CONTAINED"

KEY = "partition_date"


def _row(seq: int, **values: Column) -> list[Column]:
    """All ledger columns in order; those not given are NULL."""
    values["seq"] = F.lit(seq)
    return [
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in LEDGER.fields
    ]


def current(log: DataFrame) -> DataFrame:
    """Latest change of every date."""
    state = F.struct(*[F.col(f.name) for f in LEDGER.fields if f.name != KEY])
    return (
        log.groupBy(KEY)
        .agg(F.max_by(state, "seq").alias("state"))
        .select(KEY, "state.*")
    )


def begin(dates: DataFrame, run_id: str, at: datetime, seq: int) -> DataFrame:
    """``dates`` (partition_date) enter IN_PROGRESS with nothing left over."""
    return dates.select(
        *_row(
            seq,
            partition_date=F.col(KEY),
            status=F.lit(IN_PROGRESS),
            run_id=F.lit(run_id),
            start_time=F.lit(at),
        )
    )


def succeed(state: DataFrame, counts: DataFrame, at: datetime, seq: int) -> DataFrame:
    """Dates in ``counts`` (partition_date, record_count) end in SUCCESS.

    ``counts`` may have the ``content`` of the rows, too. A date that has no state
    is left out.
    """
    if "content" not in counts.columns:
        counts = counts.withColumn("content", F.lit(None).cast("string"))
    return (
        state.drop("record_count", "content")
        .join(counts, KEY)
        .select(
            *_row(
                seq,
                partition_date=F.col(KEY),
                status=F.lit(SUCCESS),
                run_id=F.col("run_id"),
                start_time=F.col("start_time"),
                end_time=F.lit(at),
                record_count=F.col("record_count"),
                content=F.col("content"),
            )
        )
    )


def fail(state: DataFrame, errors: DataFrame, at: datetime, seq: int) -> DataFrame:
    """Dates in ``errors`` (partition_date, error_message) end in FAILED.

    The run, its start and any earlier count stay. A date that has no state is
    left out.
    """
    return (
        state.drop("error_message")
        .join(errors, KEY)
        .select(
            *_row(
                seq,
                partition_date=F.col(KEY),
                status=F.lit(FAILED),
                run_id=F.col("run_id"),
                start_time=F.col("start_time"),
                end_time=F.lit(at),
                record_count=F.col("record_count"),
                error_message=F.substring("error_message", 1, ERROR_LENGTH),
                content=F.col("content"),
            )
        )
    )


def plan(
    targets: DataFrame,
    state: DataFrame,
    published: DataFrame,
    detect_growth: bool = True,
) -> DataFrame:
    """Action for every target date.

    ``targets`` has (dt, record_count) of the input, ``published`` the same of
    the output. A finished date is skipped while its output is there and its
    input still has the recorded size; without ``detect_growth`` the size is
    not looked at. A different size is a reason to look at the rows, not yet to
    replace them: the input may be a part of what is published. Where ``targets``
    has the ``content`` of the rows (see ``content.fingerprints``) and it was
    recorded, other rows of equal number are seen as well.
    """
    if "content" not in targets.columns:
        targets = targets.withColumn("content", F.lit(None).cast("string"))
    done = F.col("status") == SUCCESS
    there = F.col("published_count").isNotNull()
    same = F.col("source_count").eqNullSafe(F.col("recorded_count"))
    changed = F.coalesce(F.col("content") != F.col("recorded_content"), F.lit(False))
    skip = done & there & (same & ~changed if detect_growth else F.lit(True))
    action = (
        F.when(F.col("status").isNull(), BUILD)
        .when(skip, SKIP)
        .when(done & there & same, REBUILD_CHANGED)
        .when(done & there, REBUILD_GREW)
        .when(done, REBUILD_MISSING)
        .when(F.col("status") == IN_PROGRESS, REBUILD_STALE)
        .when(F.col("status") == FAILED, REBUILD_FAILED)
        .otherwise(BUILD)
    )
    return (
        targets.select(DATE, F.col("record_count").alias("source_count"), "content")
        .join(
            state.select(
                F.col(KEY).alias(DATE),
                "status",
                "run_id",
                F.col("record_count").alias("recorded_count"),
                F.col("content").alias("recorded_content"),
            ),
            DATE,
            "left",
        )
        .join(
            published.select(DATE, F.col("record_count").alias("published_count")),
            DATE,
            "left",
        )
        .withColumn("action", action)
        .drop("recorded_content")
    )
