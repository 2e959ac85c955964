"""The published table in the session's catalog."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.metrics import STATISTICS_COLUMNS
from tidemark.schema import DATE, EVENTS

log = logging.getLogger(__name__)

# Fixed value: the name existing queries use.
TABLE = "ecommerce.events"

DATES_PER_STATEMENT = 200


def quoted(text: str) -> str:
    """``text`` as a SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_table(spark: SparkSession, location: str, table: str = TABLE) -> None:
    """Create database and external table over ``location`` unless they exist.

    A table of that name over another location is an error.
    """
    database = table.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENTS.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET"
        " OPTIONS (compression 'snappy')"
        f" PARTITIONED BY ({DATE}) LOCATION {quoted(location)}"
    )
    found = table_location(spark, table)
    if found is not None and _plain(found) != _plain(location):
        raise ValueError(f"table {table} lies at {found}, not at {location}")


def table_location(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _plain(location: str) -> str:
    """A path as it compares: local ones are written in several ways."""
    return re.sub("^file:/*", "/", location.rstrip("/"))


def register_dates(
    spark: SparkSession, dates: Iterable[str], location: str, table: str = TABLE
) -> None:
    """Make dates visible without listing the table's whole location."""
    names = sorted(set(dates))
    root = location.rstrip("/")
    for i in range(0, len(names), DATES_PER_STATEMENT):
        clauses = " ".join(
            f"PARTITION ({DATE}={quoted(d)}) LOCATION {quoted(f'{root}/{DATE}={d}')}"
            for d in names[i : i + DATES_PER_STATEMENT]
        )
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {clauses}")
    spark.catalog.refreshTable(table)


def read_table(spark: SparkSession, table: str = TABLE) -> DataFrame:
    return spark.table(table)


def _analyze(spark: SparkSession, table: str, rest: str) -> bool:
    try:
        spark.sql(f"ANALYZE TABLE {table} {rest}")
    except PySparkException as error:
        log.warning("no statistics for %s: %s", table, error)
        return False
    return True


def analyze_once(spark: SparkSession, table: str = TABLE) -> bool:
    """Column statistics of the whole table, for the optimizer; best effort.

    Spark keeps column statistics per table, not per partition, and scans the
    table for them, so this is for after a load of many dates.
    """
    columns = ", ".join(STATISTICS_COLUMNS)
    return _analyze(spark, table, f"COMPUTE STATISTICS FOR COLUMNS {columns}")


def analyze_dates(spark: SparkSession, dates: Iterable[str], table: str = TABLE) -> bool:
    """Row count and size of single dates; reads only those. Best effort."""
    done = [
        _analyze(spark, table, f"PARTITION ({DATE}={quoted(date)}) COMPUTE STATISTICS")
        for date in sorted(set(dates))
    ]
    return all(done)
