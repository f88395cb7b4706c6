"""Reporting views: what the dashboards and investigation queries read.

Most read marts, which are small; the issue listings read the cleaned records.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall import functions as R
from rollcall.operators.aggregates import one_row
from rollcall.operators.ordering import ascending, descending, ordered_rows, top_rows
from rollcall.operators.predicates import date_range_slice, optional_membership
from rollcall.schema import GENERATIONS, PARTIES

# Columns of the views, and their row limits.
MISSING_COLUMNS = (
    "voter_id", "first_name", "last_name", "state_code", "age", "email", "load_timestamp",
)
INVALID_AGE_COLUMNS = (
    "voter_id", "age", "first_name", "last_name", "state_code", "has_invalid_age",
)
INVALID_EMAIL_COLUMNS = ("voter_id", "email", "first_name", "last_name", "state_code")
STATE_DETAIL_COLUMNS = (
    "state_code", "total_voters", "avg_age", "democrat_pct", "republican_pct",
    "independent_pct", "email_quality_pct",
)
MONTH_COLUMNS = ("registration_month", "new_registrations", "moving_avg_registrations")
STATE_PREVIEW = ("state_code", "total_voters", "democrat_pct", "republican_pct")
PARTY_PREVIEW = ("party", "total_voters", "age_18_29", "active_voters_2024")
TOP_STATES = 10
LAST_MONTHS = 6
PREVIEW_ROWS = 5
ISSUES = {
    "Missing Data": "missing_data_count",
    "Invalid Age": "invalid_age_count",
    "Invalid Email": "invalid_email_count",
}


def _issue_rows(cleaned: DataFrame, failing: Column, columns: Sequence[str]) -> DataFrame:
    return ordered_rows(cleaned.where(failing).select(*columns), ascending("voter_id"))


def missing_data_rows(cleaned: DataFrame) -> DataFrame:
    return _issue_rows(cleaned, F.col("has_missing_data"), MISSING_COLUMNS)


def invalid_age_rows(cleaned: DataFrame) -> DataFrame:
    return _issue_rows(cleaned, F.col("has_invalid_age"), INVALID_AGE_COLUMNS)


def invalid_email_rows(cleaned: DataFrame) -> DataFrame:
    return _issue_rows(cleaned, ~F.col("is_valid_email"), INVALID_EMAIL_COLUMNS)


def top_states(states: DataFrame, n: int = TOP_STATES) -> DataFrame:
    return top_rows(states, n, descending("total_voters"), ascending("state_code"))


def last_months(trends: DataFrame, n: int = LAST_MONTHS) -> DataFrame:
    return top_rows(trends.select(*MONTH_COLUMNS), n, descending("registration_month"))


def preview(
    df: DataFrame, n: int = PREVIEW_ROWS, key: str = "voter_id", tie: Sequence[str] = ("email",)
) -> DataFrame:
    """The first rows by key, so that a repeated look shows the same rows."""
    return top_rows(df, n, ascending(key), *(ascending(c) for c in tie))


def overview_kpis(parties: DataFrame, engagement: DataFrame, states: DataFrame) -> DataFrame:
    """Headline numbers, to one decimal. ``avg_age`` is the mean of the party means,
    ``avg_age_weighted`` weighs them by the parties' people."""
    active = F.when(F.col("voter_status") == "active_2024", F.col("voter_count"))
    people = F.when(F.col("avg_age").isNotNull(), F.col("total_voters"))
    totals = one_row(
        parties.agg(
            F.sum("total_voters").alias("total_voters"),
            R.round_half_away(F.avg("avg_age"), 1).alias("avg_age"),
            R.round_half_away(F.sum(people * F.col("avg_age")) / F.sum(people), 1).alias(
                "avg_age_weighted"
            ),
        ),
        engagement.agg(F.coalesce(F.sum(active), F.lit(0)).alias("active_voters_2024")),
        states.agg(F.count_distinct("state_code").alias("states_represented")),
    )
    return totals.select(
        "total_voters",
        "active_voters_2024",
        R.pct_of("active_voters_2024", "total_voters").alias("active_pct"),
        "states_represented",
        "avg_age",
        "avg_age_weighted",
    )


def party_share(parties: DataFrame) -> DataFrame:
    """The window runs over the party rows, so a mart that is not stored is built once."""
    total = F.sum("total_voters").over(Window.partitionBy())
    return parties.select("party", "total_voters", total.alias("total")).select(
        "party", "total_voters", R.pct_of("total_voters", "total").alias("share_pct")
    )


def status_totals(engagement: DataFrame) -> DataFrame:
    totals = engagement.groupBy("voter_status").agg(F.sum("voter_count").alias("voter_count"))
    return totals.orderBy(descending("voter_count"))


def top_states_party_mix(states: DataFrame, n: int = TOP_STATES) -> DataFrame:
    """The party percentages of the largest states, one row per state and party."""
    columns = [f"{p.lower()}_pct" for p in PARTIES]
    mixed = top_states(states, n).select("state_code", "total_voters", *columns)
    long = mixed.unpivot(["state_code", "total_voters"], columns, "party", "pct")
    return long.withColumn("party", F.initcap(F.replace(F.col("party"), F.lit("_pct"), F.lit(""))))


def state_details(states: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    return optional_membership(states, "state_code", wanted).select(*STATE_DETAIL_COLUMNS)


def _position(column: str) -> Column:
    """Place of a generation in the fixed order, NULL for others."""
    return F.nullif(F.array_position(F.array(*(F.lit(g) for g in GENERATIONS)), F.col(column)), F.lit(0))


def generation_totals(crosstab: DataFrame) -> DataFrame:
    """People per known generation in the fixed order, 0 where there are none."""
    known = crosstab.sparkSession.range(1).select(
        F.explode(F.array(*(F.lit(g) for g in GENERATIONS))).alias("generation"),
        F.lit(0).cast("bigint").alias("voter_count"),
    )
    counted = crosstab.where(F.col("generation").isin(*GENERATIONS))
    stacked = counted.select("generation", "voter_count").unionByName(known)
    totals = stacked.groupBy("generation").agg(F.sum("voter_count").alias("voter_count"))
    return totals.orderBy(_position("generation"))


def gender_by_party(crosstab: DataFrame) -> DataFrame:
    with_party = crosstab.where(F.col("party").isNotNull())
    return with_party.groupBy("party", "gender").agg(F.sum("voter_count").alias("voter_count"))


def generation_by_party(crosstab: DataFrame) -> DataFrame:
    """Per party in the fixed generation order; an unknown generation becomes NULL."""
    with_party = crosstab.where(F.col("party").isNotNull())
    totals = with_party.groupBy("party", "generation").agg(F.sum("voter_count").alias("voter_count"))
    known = F.when(F.col("generation").isin(*GENERATIONS), F.col("generation"))
    named = totals.withColumn("generation", known)
    return named.orderBy(F.col("party"), _position("generation").asc_nulls_last())


def trend_slice(
    trends: DataFrame, start: str | dt.date = "2015-01-01", end: str | dt.date = "2024-12-31"
) -> DataFrame:
    sliced = date_range_slice(trends, "registration_month", start, end)
    return sliced.orderBy("registration_month")


def party_trend_long(trends: DataFrame) -> DataFrame:
    """One row per month and party."""
    suffix = "_registrations"
    columns = [f"{p.lower()}{suffix}" for p in PARTIES]
    long = trends.unpivot("registration_month", columns, "party", "registrations")
    return long.withColumn("party", F.replace(F.col("party"), F.lit(suffix), F.lit("")))


def dq_issue_breakdown(dq: DataFrame) -> DataFrame:
    """One row per issue with its share of the raw records, 0 when there are none."""
    named = dq.select("raw_count", *(F.col(c).alias(name) for name, c in ISSUES.items()))
    long = named.unpivot("raw_count", list(ISSUES), "issue_type", "issue_count")
    share = F.col("issue_count") / F.nullif(F.col("raw_count"), F.lit(0)) * F.lit(100.0)
    return long.select(
        "issue_type", "issue_count", F.coalesce(share, F.lit(0.0)).alias("issue_pct")
    )
