"""Helpers the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# The letters that case folding touches.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Keys looked up by broadcast because they are the most frequent ones. A key
# that is not among the HOT_KEYS largest of N rows holds at most N / HOT_KEYS.
HOT_KEYS = 1_000

# Rows a Python function gets at a time.
ROWS_AT_ONCE = 256


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written once to the shared folder and read back.

    Cuts the lineage: later stages reread the files when an executor is lost.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def map_rows(rows: DataFrame, run, fields: str) -> DataFrame:
    """``mapInPandas`` for rows with a ``doc_id``, which comes out with ``fields``.

    Ids go as text: pandas would turn a batch of numbers with a NULL into
    floats, which are not exact beyond 2^53. ``run`` gets ROWS_AT_ONCE rows at a
    time, so that a task holds the results of no more.
    """
    kind = rows.schema["doc_id"].dataType

    def sliced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return run(
            batch.iloc[at : at + ROWS_AT_ONCE].reset_index(drop=True)
            for batch in batches
            for at in range(0, len(batch), ROWS_AT_ONCE)
        )

    as_text = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    found = as_text.mapInPandas(sliced, f"doc_id string, {fields}")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z; every other character stays. NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def attach(rows: DataFrame, classes: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Inner join of ``rows`` with ``classes``, which has one row per key.

    ``size`` counts a class's rows. The HOT_KEYS largest classes are looked up
    by broadcast, a list of that length at most, so that no hot key is
    shuffled; the others are joined by shuffle. Pass stored frames: both are
    read twice.
    """
    hot = F.broadcast(classes.orderBy(F.desc(size), *keys).limit(HOT_KEYS))
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(hot, keys).unionByName(cold.join(classes, keys))
