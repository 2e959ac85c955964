"""Shards along a Hilbert curve through several metadata dimensions.

Each dimension is cut into 2^bits steps of about equally many rows, from exact
counts of its whole values; a row's
steps are a cell of a grid, and cells are numbered along a Hilbert curve, on
which near numbers are near in every dimension. Rows are put in the order of
the curve and cut into runs of equal counts. So a file holds a small box of the
grid, and readers that filter on any of the dimensions skip most files by the
minimum and maximum in the footers.

A row's place is the number of rows before it in the order of curve, checksum of
the text, id, and a number of its own. The rows are put in that order by ranges of
all four, which a hot cell, a group of copies or a repeated id cannot make uneven;
a place is the rows of the ranges before plus the place in its range.

Built of DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegralType, NumericType, StringType

from tidemark.llm.common import stored

SHARDS = 24
DIMENSIONS = ("source", "lang", "n_chars")
BITS = 5
ROW_BYTES = 8


def _ordered(docs: DataFrame, column: str) -> Column:
    """The column as a value whose order Spark and Python literals share."""
    kind = docs.schema[column].dataType
    if isinstance(kind, StringType):
        return docs[column]
    if isinstance(kind, (IntegralType, BooleanType)):
        return docs[column].cast("bigint")
    if isinstance(kind, NumericType):
        return docs[column].cast("double")
    return F.unix_micros(docs[column].cast("timestamp"))


def _ranged(frame: DataFrame, name: str, *keys: str) -> tuple[DataFrame, Column]:
    """``frame`` stored in the order of ``keys``, with ``at``, and per run of it
    its number ``run``.

    ``at`` is the run's number times 2^33 plus the row's place in the run. Runs
    are cut from a sample of the keys, so they are even if no key repeats.
    """
    ordered = frame.repartitionByRange(*keys).sortWithinPartitions(*keys)
    kept = stored(ordered.withColumn("at", F.monotonically_increasing_id()), name)
    return kept, F.shiftright("at", 33).alias("run")


def step_bounds(
    docs: DataFrame, dimensions: Sequence[str] = DIMENSIONS, bits: int = BITS
) -> list[list[tuple[int, Any]]]:
    """Per dimension the steps, fewer than 2^bits, and the least value of each.

    A value's step is the share of rows with a smaller value, NULL being the
    smallest, in units of 1 / 2^bits. Counted over all rows and compared whole:
    rows are counted per value, the values put in order, and their counts summed
    run by run.
    """
    return [_bounds(docs, dimension, 1 << bits) for dimension in dimensions]


def _bounds(docs: DataFrame, dimension: str, steps: int) -> list[tuple[int, Any]]:
    counted = stored(docs.groupBy(_ordered(docs, dimension).alias("value")).agg(F.count("*").alias("rows")), "values")
    ordered, run = _ranged(counted, "values-in-order", "value")
    starts, total = _starts(ordered.groupBy(run).agg(F.sum("rows").alias("rows")))
    smaller = Window.partitionBy("run").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("rows").over(smaller), F.lit(0))
    step = F.expr(f"before * {steps} div {max(total, 1)}")
    return [
        (row["step"], row["value"])
        for row in ordered.select("value", "rows", "at", run)
        .join(F.broadcast(starts), "run")
        .select("value", before.alias("before"))
        .select("value", step.alias("step"))
        .groupBy("step")
        .agg(F.min("value").alias("value"))
        .where("step > 0")
        .orderBy("step")
        .collect()  # fewer than `steps` rows
    ]


def _starts(runs: DataFrame) -> tuple[DataFrame, int]:
    """``run, start``: rows in the runs before; and the rows of all. One row per
    run, of which there are as many as shuffle partitions."""
    total, listed = 0, []
    for row in runs.orderBy("run").collect():
        listed.append((row["run"], total))
        total += row["rows"]
    return runs.sparkSession.createDataFrame(listed, "run bigint, start bigint"), total


def curve_tables(dimensions: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """What the curve does at one level, for the 2^n corners of a cube.

    The place of a corner on the level's Gray code; the corner where the part
    curve at a place starts; the axis it runs along; and corners rotated by
    0..n-1 axes to the right, one rotation after the other.
    """
    corners = 1 << dimensions
    gray = [i ^ (i >> 1) for i in range(corners)]
    place = [gray.index(c) for c in range(corners)]
    start = [gray[2 * ((w - 1) // 2)] if w else 0 for w in range(corners)]

    def trailing_ones(w: int) -> int:
        return ((w + 1) & -(w + 1)).bit_length() - 1

    axis = [0 if w == 0 else trailing_ones(w - 1 if w % 2 == 0 else w) % dimensions for w in range(corners)]
    rotated = [
        (c >> r | c << (dimensions - r)) & (corners - 1) for r in range(dimensions) for c in range(corners)
    ]
    return place, start, axis, rotated


def hilbert_index(steps: Sequence[Column], bits: int = BITS) -> Column:
    """Number of a grid cell along the Hilbert curve, from its steps."""
    n = len(steps)
    place, start, axis, rotated = (F.array(*map(F.lit, t)) for t in curve_tables(n))

    def rotate(corner: Column, by: Column) -> Column:
        return F.get(rotated, F.pmod(by, F.lit(n)) * (1 << n) + corner)

    def level(state: Column, corner: Column) -> Column:
        here = F.get(place, rotate(corner.bitwiseXOR(state["start"]), state["axis"] + 1))
        # A rotation to the left is one to the right by the rest.
        onward = rotate(F.get(start, here), F.lit(2 * n) - state["axis"] - 1)
        return F.struct(
            (state["index"] * (1 << n) + here).cast("bigint").alias("index"),
            state["start"].bitwiseXOR(onward).cast("int").alias("start"),
            F.pmod(state["axis"] + F.get(axis, here) + 1, F.lit(n)).cast("int").alias("axis"),
        )

    corners = []
    for bit in reversed(range(bits)):
        corner = F.lit(0)
        for i, step in enumerate(steps):
            corner = corner + F.shiftright(step, bit).bitwiseAND(F.lit(1)) * (1 << i)
        corners.append(corner.cast("int"))
    first = F.struct(
        F.lit(0).cast("bigint").alias("index"), F.lit(0).alias("start"), F.lit(0).alias("axis")
    )
    return F.aggregate(F.array(*corners), first, level, lambda state: state["index"])


def _step(value: Column, bounds: Sequence[tuple[int, Any]]) -> Column:
    """The step that the value lies in; NULL in the lowest."""
    step = F.lit(0)
    for number, least in bounds:  # ascending: the last one that is reached counts
        step = F.when(value >= F.lit(least), number).otherwise(step)
    return step.cast("int")


def assign(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    dimensions: Sequence[str] = DIMENSIONS,
    shards: int = SHARDS,
    bits: int = BITS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, size, text_crc32, curve, shard, slot`` and the columns ``carry``.

    Shard counts differ by one at most, and a shard's slots are 0, 1, ... in
    the order of curve, ``text_crc32`` and id, so that equal texts of a cell stand
    together. A NULL dimension is the lowest step, a NULL text has no bytes. A
    repeated row gets a place of its own. An empty table gives an empty result.
    ``size`` is the text's UTF-8 bytes plus ``ROW_BYTES``.
    """
    if len(dimensions) * bits > 18:
        raise ValueError("the curve has at most 2^18 cells")
    bounds = step_bounds(docs, dimensions, bits)
    steps = [_step(_ordered(docs, d), b) for d, b in zip(dimensions, bounds)]
    text = F.coalesce(docs[text_column], F.lit(""))
    carried = [f"carried_{i}" for i in range(len(carry))]
    rows = docs.select(
        docs[id_column].alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        hilbert_index(steps, bits).alias("curve"),
        *[docs[c].alias(name) for c, name in zip(carry, carried)],
    )
    # The row's own number ends every tie, so that no run grows with copies.
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "curve-rows")
    ordered, run = _ranged(rows, "rows-in-order", "curve", "text_crc32", "doc_id", "row")
    starts, total = _starts(ordered.groupBy(run).agg(F.count("*").alias("rows")))
    in_run = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ordered.select("*", run).join(F.broadcast(starts), "run").withColumn("place", F.col("start") + in_run)
    # The first place of a shard is the least one that falls into it.
    exact = F.expr(f"place * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {max(total, 1)} + {shards - 1}) div {shards}")
    return (
        numbered.withColumn("shard", exact)
        .withColumn("slot", F.col("place") - first)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "curve",
            F.col("shard").cast("int").alias("shard"),
            F.col("slot").cast("bigint").alias("slot"),
            *[F.col(name).alias(c) for c, name in zip(carry, carried)],
        )
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, **options) -> None:
    """Write ``docs`` as Parquet under ``path/shard=<number>``, in slot order."""
    columns = [c for c in docs.columns if c not in ("doc_id", "size", "text_crc32", "curve", "shard", "slot")]
    placed = assign(docs, shards=shards, carry=columns, **options)
    (
        placed.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
