"""Relations of the engine. All column names and types are fixed values."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

RAW_EVENTS = StructType(
    [
        StructField("event_time", TimestampType()),
        StructField("event_type", StringType()),
        StructField("product_id", IntegerType()),
        StructField("category_id", LongType()),
        StructField("category_code", StringType()),
        StructField("brand", StringType()),
        StructField("price", DoubleType()),
        StructField("user_id", LongType()),
        StructField("user_session", StringType()),
    ]
)

SESSION_ID = "generated_session_id"
DATE = "dt"

# Published events: the raw columns, the session ID, and the partition column.
EVENTS = StructType(
    RAW_EVENTS.fields
    + [StructField(SESSION_ID, StringType()), StructField(DATE, StringType())]
)

# One row per change of a date's state; ``seq`` orders the changes. ``content`` is
# the fingerprint of the rows counted, where it was taken.
LEDGER = StructType(
    [
        StructField("partition_date", StringType()),
        StructField("status", StringType()),
        StructField("run_id", StringType()),
        StructField("start_time", TimestampType()),
        StructField("end_time", TimestampType()),
        StructField("record_count", LongType()),
        StructField("error_message", StringType()),
        StructField("seq", LongType()),
        StructField("content", StringType()),
    ]
)
