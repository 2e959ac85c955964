"""What a date's rows are, whatever their order: fingerprints and merging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schema import DATE, RAW_EVENTS


def fingerprints(dated: DataFrame, columns: Sequence[str] = tuple(RAW_EVENTS.names)) -> DataFrame:
    """``dt, record_count, content``: rows per local date and a fingerprint of them.

    The fingerprint is the sum of the rows' hashes over ``columns``, so the order
    of rows does not matter and copies count. Two sums of independent 64-bit
    hashes are kept: rows that differ have equal fingerprints once in 2^128.
    Partially summed ahead of the shuffle, which moves one row per task and date.
    """
    # Which columns are NULL is part of the row: a hash skips NULLs.
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in columns])
    wide = "decimal(38,0)"
    sums = [
        F.sum(F.xxhash64(F.lit(salt), nulls, *columns).cast(wide)).cast("string")
        for salt in ("first", "second")
    ]
    return dated.groupBy(DATE).agg(
        F.count("*").alias("record_count"), F.concat_ws(":", *sums).alias("content")
    )


def merged(one: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of either side, each as often as it occurs where it occurs more often.

    So rows delivered a second time add nothing, and copies within a delivery
    are kept. Copies are counted on the map side before the shuffle.
    """
    sides = one.select(*columns, F.lit(1).alias("left"), F.lit(0).alias("right")).unionByName(
        other.select(*columns, F.lit(0).alias("left"), F.lit(1).alias("right"))
    )
    counted = sides.groupBy(*columns).agg(F.sum("left").alias("left"), F.sum("right").alias("right"))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.greatest("left", "right")))
    return counted.select(*columns, copies.alias("copy")).drop("copy")
