"""The row-local layers: staged text and cleaned records. No shuffle in either."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import functions as R
from rollcall.operators.predicates import filter_null_key
from rollcall.schema import MAX_AGE, MIN_AGE


def stage(raw: DataFrame) -> DataFrame:
    """Drop rows without a key, trim the text, cast the age; dates stay text."""
    return filter_null_key(raw).select(
        R.trim_text("id").alias("voter_id"),
        R.trim_text("first_name").alias("first_name"),
        R.trim_text("last_name").alias("last_name"),
        R.safe_int_cast("age").alias("age"),
        R.trim_upper("gender").alias("gender"),
        R.trim_text("state").alias("state_raw"),
        R.trim_text("party").alias("party"),
        R.trim_lower("email").alias("email"),
        F.col("registered_date").alias("registered_date_raw"),
        F.col("last_voted_date").alias("last_voted_date_raw"),
        F.col("updated_at").alias("updated_at_raw"),
        "load_timestamp",
        "source_file_hash",
    )


def clean(
    staged: DataFrame,
    run_ts: Column | str | dt.datetime,
    min_age: int = MIN_AGE,
    max_age: int = MAX_AGE,
) -> DataFrame:
    """Standard values, parsed dates and quality flags.

    The region is looked up once, below the projection that both returns it and tests it.
    The flags read the staged age and names, before bounds and defaults replace them.
    """
    located = staged.withColumn("state_code", R.standardize_state("state_raw"))
    return located.select(
        "voter_id",
        R.default_if_null("first_name").alias("first_name"),
        R.default_if_null("last_name").alias("last_name"),
        R.bounded_or_null("age", min_age, max_age).alias("age"),
        R.out_of_range_flag("age", min_age, max_age).alias("has_invalid_age"),
        R.normalize_gender("gender").alias("gender"),
        "state_code",
        "state_raw",
        "party",
        "email",
        R.email_plausible("email").alias("is_valid_email"),
        R.parse_flexible_date("registered_date_raw").alias("registered_date"),
        R.parse_flexible_date("last_voted_date_raw").alias("last_voted_date"),
        R.parse_flexible_date("updated_at_raw").alias("updated_at"),
        R.missing_data_flag("first_name", "last_name", "age", "state_code").alias(
            "has_missing_data"
        ),
        "load_timestamp",
        "source_file_hash",
        R.as_timestamp(run_ts).alias("processed_at"),
    )
