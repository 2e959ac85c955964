"""Statistics of any range of dates from one row per date.

Distinct values are kept as HyperLogLog sketches, which unite without reading
events. With 2^LG_K registers the estimate's standard error is 1.04 / sqrt(2^LG_K);
``ERROR`` is four of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.metrics import STATISTICS_COLUMNS
from tidemark.schema import DATE

LG_K = 14
ERROR = 4 * 1.04 / 2 ** (LG_K / 2)


def date_sketches(published: DataFrame, columns: Sequence[str] = STATISTICS_COLUMNS) -> DataFrame:
    """Per date: rows, and for each column its NULLs and a sketch of its values.

    A task reduces its rows to one sketch per date and column ahead of the shuffle.
    """
    measures = [F.count("*").alias("row_count")]
    for name in columns:
        measures += [
            F.count_if(F.col(name).isNull()).alias(f"{name}_nulls"),
            F.hll_sketch_agg(name, F.lit(LG_K)).alias(f"{name}_sketch"),
        ]
    return published.groupBy(DATE).agg(*measures)


def range_statistics(sketches: DataFrame, columns: Sequence[str] = STATISTICS_COLUMNS) -> DataFrame:
    """One row for all dates of ``sketches``: rows, and for each column its NULLs
    and about how many distinct values it has, within ``ERROR``."""
    measures = [F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")]
    for name in columns:
        united = F.hll_sketch_estimate(F.hll_union_agg(f"{name}_sketch"))
        measures += [
            F.coalesce(F.sum(f"{name}_nulls"), F.lit(0)).alias(f"{name}_nulls"),
            F.coalesce(united, F.lit(0)).alias(f"{name}_distinct"),
        ]
    return sketches.agg(*measures)
