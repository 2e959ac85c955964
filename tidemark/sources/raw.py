"""Raw event input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.schema import RAW_EVENTS

# Fixed value: times look like ``2019-10-01 00:00:00 UTC``.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss z"


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files with a header. A cell that does not parse becomes NULL."""
    return (
        spark.read.schema(RAW_EVENTS)
        .option("header", True)
        .option("timestampFormat", TIME_FORMAT)
        .csv(path)
    )


# Where a line that does not parse is kept as it was.
REJECTED = "_corrupt_record"


def read_raw_csv_with_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The rows of :func:`read_raw_csv` and, for lines with a cell that does not
    parse or of another number of cells, the line in ``_corrupt_record``.

    Write the rows first and split them then: Spark does not read this column
    of CSV files by itself.
    """
    return (
        spark.read.schema(StructType([*RAW_EVENTS.fields, StructField(REJECTED, StringType())]))
        .option("header", True)
        .option("timestampFormat", TIME_FORMAT)
        .option("columnNameOfCorruptRecord", REJECTED)
        .csv(path)
    )


def write_raw_csv(events: DataFrame, path: str) -> None:
    """Write events in the form :func:`read_raw_csv` reads."""
    (
        events.select(*RAW_EVENTS.names)
        .write.option("header", True)
        .option("timestampFormat", TIME_FORMAT)
        .csv(path)
    )


def read_activity_table(spark: SparkSession, folder: str) -> DataFrame:
    """The ``events`` table of a test-data folder, in the raw event schema.

    The file holds times without a zone. Reading them as TIMESTAMP takes them
    for UTC whatever the session zone is, which a cast would not.
    """
    table = spark.read.schema(
        "event_id bigint, ts timestamp, user_id bigint,"
        " event_type string, value double, props string"
    ).parquet(f"{folder}/events.parquet")
    absent = F.lit(None).cast("string")
    return table.select(
        F.col("ts").alias("event_time"),
        "event_type",
        F.col("event_id").try_cast("int").alias("product_id"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("category_id"),
        absent.alias("category_code"),
        absent.alias("brand"),
        F.col("value").alias("price"),
        "user_id",
        absent.alias("user_session"),
    )
