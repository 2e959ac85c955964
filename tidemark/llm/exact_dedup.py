"""Exact deduplication that no single text can overload.

Texts are equal when they are the same after A-Z became a-z. Copies are merged
in three stages, each of which groups by the whole text as well as its digest,
so that a digest alone never decides:

1. within a task, by the partial aggregation ahead of the first shuffle: a
   task sends one row per text however many copies it has read;
2. per (text, salt), the salt being the task number modulo ``salts``: the rows
   of a text that every task holds are spread over ``salts`` groups;
3. per text, over at most ``salts`` winners.

Rows then look their class up by digest. The very frequent classes are looked
up by broadcast (see ``common.attach``).

Built of DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, attach, stored

SALTS = 16

_KEYS = ["digest", "second_digest"]


def _prepared(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    content = ascii_lower(F.col(text_column))
    return docs.select(
        F.col(id_column).alias("row_id"),
        F.sha2(content, 256).alias("digest"),
        F.xxhash64(content).alias("second_digest"),
        content.alias("content"),
    )


def text_classes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", salts: int = SALTS
) -> DataFrame:
    """One row per distinct text: digest, second_digest, keep_id, group_size."""
    salted = (
        _prepared(docs, id_column, text_column)
        .withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy(*_KEYS, "content", "salt")
        .agg(F.max("row_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    # Dealt by digest alone, which also brings a digest's texts together.
    winners = (
        salted.repartition("digest")
        .groupBy(*_KEYS, "content")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )
    # Two texts that agree in both digests could not be told apart below.
    clash = F.raise_error(F.lit("different texts with equal SHA-256 and XXH64 digests"))
    return (
        winners.groupBy(*_KEYS)
        .agg(
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
            F.count("*").alias("contents"),
        )
        .withColumn(
            "group_size", F.when(F.col("contents") == 1, F.col("group_size")).otherwise(clash)
        )
        .drop("contents")
    )


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", salts: int = SALTS
) -> DataFrame:
    """Every row's class: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays. A NULL text counts as
    empty, and empty texts are copies of each other. Rows that repeat both an
    id and a text count in ``group_size`` and are kept or dropped together; a
    NULL id is kept only if no row of its text has one. An empty table gives
    an empty result; other columns of ``docs`` are not looked at.
    """
    rows = stored(
        _prepared(docs, id_column, text_column).drop("content"), "exact-rows"
    )
    classes = stored(text_classes(docs, id_column, text_column, salts), "exact-classes")
    return attach(rows, classes, _KEYS, "group_size").select(
        F.col("row_id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("row_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Rows of ``docs``, unchanged, whose text no row with a larger id has."""
    gone = (
        exact_groups(docs, id_column, text_column)
        .where(~F.col("kept"))
        .select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_sha256"))
        .distinct()
    )
    # An id may stand on several rows with different texts.
    digest = F.sha2(ascii_lower(docs[text_column]), 256)
    match = docs[id_column].eqNullSafe(gone["gone_id"]) & (digest == gone["gone_sha256"])
    return docs.join(gone, match, "left_anti")
