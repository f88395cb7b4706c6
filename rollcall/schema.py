"""Column lists, table layouts and default parameters of the registry."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names and defaults of the registry data model.
RAW_COLUMNS = (
    "id", "first_name", "last_name", "age", "gender", "state", "party",
    "email", "registered_date", "last_voted_date", "updated_at",
)
MIN_AGE = 18
MAX_AGE = 120
PARTIES = ("Democrat", "Republican", "Independent")
GENERATIONS = ("gen_z", "millennial", "gen_x", "boomer", "silent")
DEFAULT_NAME = "UNKNOWN"
SMALL_CELL = 5
TRENDS_SINCE = "2015-01-01"

EXTRACT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

RAW_SCHEMA = T.StructType(
    EXTRACT_SCHEMA.fields
    + [
        T.StructField("load_timestamp", T.TimestampType()),
        T.StructField("source_file_hash", T.StringType()),
    ]
)

CLEANED_SCHEMA = T.StructType(
    [
        T.StructField("voter_id", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("has_invalid_age", T.BooleanType()),
        T.StructField("gender", T.StringType()),
        T.StructField("state_code", T.StringType()),
        T.StructField("state_raw", T.StringType()),
        T.StructField("party", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("is_valid_email", T.BooleanType()),
        T.StructField("registered_date", T.DateType()),
        T.StructField("last_voted_date", T.DateType()),
        T.StructField("updated_at", T.DateType()),
        T.StructField("has_missing_data", T.BooleanType()),
        T.StructField("load_timestamp", T.TimestampType()),
        T.StructField("source_file_hash", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("ingestion_id", T.StringType(), False),
        T.StructField("file_hash", T.StringType(), False),
        T.StructField("source_path", T.StringType(), False),
        T.StructField("file_row_count", T.LongType(), False),
        T.StructField("inserted_row_count", T.LongType(), False),
        T.StructField("load_status", T.StringType(), False),
        T.StructField("dag_run_id", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)
