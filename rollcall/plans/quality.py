"""Data-quality checks. Each returns the rows (or keys) that fail it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import functions as R
from rollcall.operators.aggregates import one_row
from rollcall.schema import MAX_AGE, MIN_AGE, PARTIES

# Allowed days ahead, allowed age of the newest month, and the alert limits.
DAYS_AHEAD = 30
MONTHS_BACK = 1
MISSING_PCT_LIMIT = 5
INVALID_EMAIL_LIMIT = 50
COMPLETENESS_TARGET = 95


def is_unaccepted(column: str, values: Sequence[str]) -> Column:
    """NULL passes."""
    return ~F.col(column).isin(*values)


def is_out_of_range(column: str, low: int, high: int) -> Column:
    return ~F.col(column).between(low, high)


def is_future(column: str, as_of: Column | str | dt.date, days_ahead: int = DAYS_AHEAD) -> Column:
    """More than ``days_ahead`` days after ``as_of``; NULL passes."""
    return F.col(column) > F.date_add(R.as_date(as_of), days_ahead)


def unique_failures(df: DataFrame, key: str) -> DataFrame:
    """Non-NULL keys that occur more than once, with their number of rows."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_records"))
    return counted.where("n_records > 1")


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values_failures(
    df: DataFrame, column: str = "party", values: Sequence[str] = PARTIES
) -> DataFrame:
    return df.where(is_unaccepted(column, values))


def accepted_range_failures(
    df: DataFrame,
    column: str = "age",
    low: int = MIN_AGE,
    high: int = MAX_AGE,
    where: Column | None = None,
) -> DataFrame:
    rows = df if where is None else df.where(where)
    return rows.where(is_out_of_range(column, low, high))


def future_date_failures(
    df: DataFrame, column: str, as_of: Column | str | dt.date, days_ahead: int = DAYS_AHEAD
) -> DataFrame:
    return df.where(is_future(column, as_of, days_ahead))


def equal_rowcount(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row with both counts and their difference."""
    counts = one_row(
        left.agg(F.count("*").alias("count_a")), right.agg(F.count("*").alias("count_b"))
    )
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def recency_failures(
    df: DataFrame,
    as_of: Column | str | dt.date,
    column: str = "registration_month",
    months: int = MONTHS_BACK,
) -> DataFrame:
    """One row when the newest date is more than ``months`` months before ``as_of``."""
    newest = df.agg(F.max(column).alias("most_recent"))
    dated = newest.withColumn("threshold", F.add_months(R.as_date(as_of), -months))
    return dated.where(F.col("most_recent") < F.col("threshold"))


@dataclass(frozen=True)
class RowCheck:
    """A check decided row by row: TRUE marks a failing row."""

    name: str
    fails: Column
    severity: str = "warn"


def staged_checks() -> list[RowCheck]:
    return [
        RowCheck("staged_not_null_voter_id", F.col("voter_id").isNull()),
        RowCheck("staged_accepted_values_party", is_unaccepted("party", PARTIES)),
    ]


def lasting_checks() -> list[RowCheck]:
    """Checks of cleaned records whose outcome does not depend on the day they are made."""
    age_known = F.col("age").isNotNull()
    return [
        RowCheck("cleaned_not_null_voter_id", F.col("voter_id").isNull()),
        RowCheck(
            "cleaned_accepted_range_age", age_known & is_out_of_range("age", MIN_AGE, MAX_AGE)
        ),
        RowCheck("cleaned_not_null_state_code", F.col("state_code").isNull()),
        RowCheck("cleaned_not_null_is_valid_email", F.col("is_valid_email").isNull()),
        RowCheck("cleaned_not_null_registered_date", F.col("registered_date").isNull()),
    ]


def cleaned_checks(as_of: Column | str | dt.date) -> list[RowCheck]:
    """Those, and the one that does. It looks at the registration date alone."""
    future = RowCheck("cleaned_not_future_registered_date", is_future("registered_date", as_of))
    return [*lasting_checks(), future]


def layer_totals(df: DataFrame, checks: Sequence[RowCheck], layer: str) -> DataFrame:
    """One row: failing rows of every check, repeated keys and all rows of a layer.

    Counters are added up per key, map-side first, and then over the keys: one scan and one
    shuffle for the row checks and the key check together.
    """
    by_key = df.groupBy("voter_id").agg(
        *(F.count_if(c.fails).alias(c.name) for c in checks), F.count("*").alias("n_records")
    )
    repeated = F.col("voter_id").isNotNull() & (F.col("n_records") > 1)
    return by_key.agg(
        *(F.coalesce(F.sum(c.name), F.lit(0)).alias(c.name) for c in checks),
        F.count_if(repeated).alias(f"{layer}_unique_voter_id"),
        F.coalesce(F.sum("n_records"), F.lit(0)).alias(f"{layer}_rows"),
    )


def check_report(
    staged: DataFrame, cleaned: DataFrame, trends: DataFrame, as_of: Column | str | dt.date
) -> DataFrame:
    """Every configured check as ``(check_name, severity, failures, status)``.

    Each layer is scanned once; its only shuffle carries counters per key.
    """
    return report_of_totals(
        [
            layer_totals(staged, staged_checks(), "staged"),
            layer_totals(cleaned, cleaned_checks(as_of), "cleaned"),
        ],
        trends,
        as_of,
    )


def report_of_totals(
    counted: Sequence[DataFrame], trends: DataFrame, as_of: Column | str | dt.date
) -> DataFrame:
    """The report from one-row frames that together hold the totals of both layers."""
    severity = {c.name: c.severity for c in staged_checks() + cleaned_checks(as_of)}
    recency = "trends_recency_registration_month"
    keyed = ["staged_unique_voter_id", "cleaned_unique_voter_id", recency]
    severity |= dict.fromkeys([*keyed, "cleaned_equal_rowcount"], "warn")
    newest = recency_failures(trends, as_of).agg(F.count("*").alias(recency))
    totals = one_row(*counted, newest).withColumn(
        "cleaned_equal_rowcount", F.abs(F.col("cleaned_rows") - F.col("staged_rows"))
    )
    lines = totals.select(*severity).unpivot([], list(severity), "check_name", "failures")
    level = F.coalesce(
        *(F.when(F.col("check_name") == name, F.lit(s)) for name, s in severity.items())
    )
    failed = F.col("failures") > 0
    return lines.withColumn("severity", level).select(
        "check_name",
        "severity",
        "failures",
        F.when(failed, F.col("severity")).otherwise(F.lit("pass")).alias("status"),
    )


def threshold_rules(dq: DataFrame) -> DataFrame:
    """Messages over the data-quality totals as ``(rule, level)``; silent rules give none."""
    raw = F.nullif(F.col("raw_count"), F.lit(0))
    missing = F.coalesce(F.lit(100.0) * F.col("missing_data_count") / raw, F.lit(0.0))
    below = F.col("data_completeness_pct") < COMPLETENESS_TARGET
    rules = {
        "missing_data": F.when(missing > MISSING_PCT_LIMIT, F.lit("warning")),
        "invalid_email": F.when(
            F.col("invalid_email_count") > INVALID_EMAIL_LIMIT, F.lit("info")
        ),
        "completeness": F.when(below, F.lit("error")).otherwise(F.lit("success")),
    }
    levels = dq.select(*(level.alias(rule) for rule, level in rules.items()))
    return levels.unpivot([], list(rules), "rule", "level").where(F.col("level").isNotNull())
