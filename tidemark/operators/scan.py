"""Sessions of one user found by many tasks: a prefix scan on two levels.

A user's cells (see :mod:`tidemark.operators.sessions`) are cut into slices of
time. Within a slice a window finds where sessions open, without knowing what
came before; a slice then says no more than its first and last second and the
last opening in it. A second window runs over a user's slices and finds the
session that reaches into each. So the longest window is one slice of cells, or
one user's slices, whichever is longer: with ``SLICE_CELLS`` = 8,192, a year at
a gap of one second is 3,850 slices where it was 31 million cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import floor_to
from tidemark.operators.sessions import SESSION_GAP, USER, _cell, _labelled, activity_cells, new_session_flag

SLICE_CELLS = 8_192


def cell_starts(cells: DataFrame, gap: int = SESSION_GAP, slice_cells: int = SLICE_CELLS) -> DataFrame:
    """Add ``start_second`` to cells, each with its ``first_second`` and
    ``last_second``."""
    if slice_cells <= 0:
        raise ValueError("a slice holds at least one cell")
    in_slice = Window.partitionBy(USER, "slice").orderBy("cell")
    so_far = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    silence = F.col("first_second") - F.lag("last_second").over(in_slice)
    # What a slice's first cell opens is not known within the slice.
    sliced = (
        cells.withColumn("slice", floor_to(F.col("cell"), gap * slice_cells))
        .withColumn("opened", F.when(silence >= gap, F.col("first_second")))
        .withColumn("own_start", F.last("opened", ignorenulls=True).over(so_far))
    )
    slices = sliced.groupBy(USER, "slice").agg(
        F.min("first_second").alias("begins"), F.max("last_second").alias("ends"), F.max("opened").alias("last_opened")
    )
    by_user = Window.partitionBy(USER).orderBy("slice")
    before = by_user.rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        slices.withColumn("head_silence", F.col("begins") - F.lag("ends").over(by_user))
        .withColumn("head_opened", F.when(new_session_flag(F.col("head_silence"), gap), F.col("begins")))
        .withColumn("left_open", F.coalesce("last_opened", "head_opened"))
        .withColumn("reaches_in", F.last("left_open", ignorenulls=True).over(before))
        .select(USER, "slice", F.coalesce("head_opened", "reaches_in").alias("head_start"))
    )
    return sliced.join(heads, [USER, "slice"]).select(
        *cells.columns, F.coalesce("own_start", "head_start").alias("start_second")
    )


def sessionize_by_scan(events: DataFrame, gap: int = SESSION_GAP, slice_cells: int = SLICE_CELLS) -> DataFrame:
    """Add the session ID to every event, whatever one user's share of them.

    The IDs are those of :func:`tidemark.operators.sessions.sessionize`; this way
    is for gaps so short that a hot user's cells are too many for one task. An
    event without a user or a time is kept, with a NULL ID.
    """
    starts = cell_starts(activity_cells(events, gap), gap, slice_cells)
    joined = events.withColumn("cell", _cell(gap)).join(
        starts.select(USER, "cell", "start_second"), [USER, "cell"], "left"
    )
    return _labelled(joined, events.columns)
