"""Summary tables over the cleaned records.

All group keys are short category lists, so every mart is a hash aggregate that shrinks
map-side to a few rows per task: a state or party holding a third of all records costs no
more than any other. Marts come unsorted; ``ordered_output`` sorts at the edge.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall import functions as R
from rollcall.operators.aggregates import one_row, weighted_median, weighted_mode
from rollcall.operators.ordering import ascending, descending
from rollcall.operators.predicates import (
    filter_flag,
    filter_since,
    having_min_count,
    in_half_open,
)
from rollcall.operators.windows import centered_moving_avg, running_total
from rollcall.schema import PARTIES, SMALL_CELL, TRENDS_SINCE

# The reporting cutoffs and the age bands of the party mart.
VOTED_2024 = "2024-01-01"
VOTED_2022 = "2022-01-01"
NEW_SINCE = "2020-01-01"
AGE_BANDS = {"age_18_29": (18, 29), "age_30_44": (30, 44), "age_45_64": (45, 64)}
SENIOR_AGE = 65

# Sort columns of each mart; a leading minus means descending.
MART_ORDER = {
    "state_summary": ("-total_voters",),
    "party_distribution": ("-total_voters",),
    "engagement_metrics": ("-engagement_score", "-voter_count"),
    "demographic_crosstab": ("generation", "gender", "party"),
    "registration_trends": ("-registration_month",),
}


def mart_order(name: str) -> list[Column]:
    return [
        descending(c[1:]) if c.startswith("-") else ascending(c) for c in MART_ORDER[name]
    ]


def ordered_output(mart: DataFrame, name: str) -> DataFrame:
    return mart.orderBy(*mart_order(name))


def _per_gender(suffix: str) -> list[Column]:
    gender = F.col("gender")
    return [
        R.conditional_count(gender == "M").alias(f"male_{suffix}"),
        R.conditional_count(gender == "F").alias(f"female_{suffix}"),
    ]


def _per_party(suffix: str, parties: Sequence[str] = PARTIES) -> list[Column]:
    return [
        R.conditional_count(F.col("party") == p).alias(f"{p.lower()}_{suffix}") for p in parties
    ]


def _voted_2024() -> Column:
    return R.conditional_count(F.col("last_voted_date") >= R.as_date(VOTED_2024))


def _ages() -> list[Column]:
    """What an average age is made of; a cell without known ages has none."""
    return [F.sum("age").alias("age_total"), F.count("age").alias("age_count")]


def _mean_age() -> Column:
    return F.try_divide(F.col("age_total").cast("double"), F.col("age_count"))


def state_cells(cleaned: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Complete records per (state, age): at most states x ages rows."""
    counts = [
        F.count("*").alias("total_voters"),
        *_per_gender("voters"),
        *_per_party("voters"),
        _voted_2024().alias("voters_2024"),
        R.conditional_count(in_half_open("last_voted_date", VOTED_2022, VOTED_2024)).alias(
            "voters_2022"
        ),
        R.conditional_count(F.col("is_valid_email")).alias("valid_emails"),
    ]
    return filter_flag(cleaned, "has_missing_data").groupBy(*by, "state_code", "age").agg(*counts)


def state_summary_of(per_age: DataFrame) -> DataFrame:
    """The median, the average and all counts roll up exactly from (state, age) cells."""
    names = [c for c in per_age.columns if c not in ("state_code", "age")]
    aged = F.when(F.col("age").isNotNull(), F.col("total_voters"))
    per_state = per_age.groupBy("state_code").agg(
        *(F.sum(n).alias(n) for n in names),
        F.try_divide(F.sum(F.col("age") * F.col("total_voters")), F.sum(aged)).alias("mean_age"),
        weighted_median("age", "total_voters").alias("median_age"),
    )
    total = F.col("total_voters")
    return per_state.select(
        "state_code",
        "total_voters",
        R.round_half_away(F.col("mean_age"), 1).alias("avg_age"),
        "median_age",
        "male_voters",
        "female_voters",
        R.pct_of("male_voters", total).alias("male_pct"),
        R.pct_of("female_voters", total).alias("female_pct"),
        *(f"{p.lower()}_voters" for p in PARTIES),
        *(R.pct_of(f"{p.lower()}_voters", total).alias(f"{p.lower()}_pct") for p in PARTIES),
        "voters_2024",
        "voters_2022",
        R.round_half_away(F.lit(100.0) * (F.col("valid_emails") / total), 1).alias(
            "email_quality_pct"
        ),
    )


def state_summary(cleaned: DataFrame) -> DataFrame:
    """Per state over complete records."""
    return state_summary_of(state_cells(cleaned))


def party_cells(cleaned: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    age = F.col("age")
    bands = [
        R.conditional_count(age.between(low, high)).alias(name)
        for name, (low, high) in AGE_BANDS.items()
    ]
    return cleaned.groupBy(*by, "party").agg(
        F.count("*").alias("total_voters"),
        *_ages(),
        *bands,
        R.conditional_count(age >= SENIOR_AGE).alias("age_65_plus"),
        _voted_2024().alias("active_voters_2024"),
        R.conditional_count(F.col("registered_date") >= R.as_date(NEW_SINCE)).alias(
            "new_registrations_since_2020"
        ),
    )


def party_distribution_of(cells: DataFrame) -> DataFrame:
    return cells.select(
        "party", "total_voters", _mean_age().alias("avg_age"), *AGE_BANDS, "age_65_plus",
        "active_voters_2024", "new_registrations_since_2020",
    )


def party_distribution(cleaned: DataFrame) -> DataFrame:
    """Per party over all records; records without a party form a group too."""
    return party_distribution_of(party_cells(cleaned))


def engagement_cells(cleaned: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return cleaned.groupBy(
        *by,
        R.recency_status("last_voted_date").alias("voter_status"),
        R.engagement_cohort("registered_date").alias("registration_cohort"),
    ).agg(F.count("*").alias("voter_count"), *_ages(), *_per_gender("count"), *_per_party("count"))


def engagement_metrics_of(cells: DataFrame) -> DataFrame:
    return cells.select(
        "voter_status", "registration_cohort", "voter_count", _mean_age().alias("avg_age"),
        "male_count", "female_count", *(f"{p.lower()}_count" for p in PARTIES),
        R.engagement_score("voter_status").alias("engagement_score"),
    )


def engagement_metrics(cleaned: DataFrame) -> DataFrame:
    """Per voting status and registration cohort over all records."""
    return engagement_metrics_of(engagement_cells(cleaned))


def _crosstab(cells: DataFrame, least: int) -> DataFrame:
    """Roll up (gender, generation, party, state) cells that carry ``n`` and ``active``."""
    rolled = cells.groupBy("gender", "generation", "party").agg(
        F.sum("n").alias("voter_count"),
        F.sum("active").alias("active"),
        F.count("state_code").alias("states_represented"),
        weighted_mode("state_code", "n").alias("most_common_state"),
    )
    kept = having_min_count(rolled, "voter_count", least)
    return kept.select(
        "gender",
        "generation",
        "party",
        "voter_count",
        R.pct_of("active", "voter_count").alias("participation_rate_2024"),
        "states_represented",
        "most_common_state",
    )


def demographic_crosstab(cleaned: DataFrame, least: int = SMALL_CELL) -> DataFrame:
    """Gender x generation x party over complete records; cells below ``least`` are dropped.

    The generation is computed in place, which equals joining it back by ``voter_id`` as
    long as that id is unique. ``demographic_crosstab_joined`` covers repeated ids.
    """
    return _crosstab(crosstab_cells(cleaned), least)


def crosstab_cells(cleaned: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Complete records per gender, generation, party and state."""
    complete = filter_flag(cleaned, "has_missing_data")
    generation = R.age_generation("age").alias("generation")
    return complete.groupBy(*by, "gender", generation, "party", "state_code").agg(
        F.count("*").alias("n"), _voted_2024().alias("active")
    )


def demographic_crosstab_joined(cleaned: DataFrame, least: int = SMALL_CELL) -> DataFrame:
    """The crosstab with the generation joined back by ``voter_id``.

    An id with k records pairs each of them with all k, so it counts k * k times. Both
    sides are counted per id before the join and the counts are multiplied, so the pairs
    themselves are never made: an id meets at most one row per generation.
    """
    complete = filter_flag(cleaned, "has_missing_data")
    people = complete.groupBy("voter_id", "gender", "party", "state_code").agg(
        F.count("*").alias("n"), _voted_2024().alias("active")
    )
    generation = R.age_generation("age").alias("generation")
    ages = complete.groupBy("voter_id", generation).agg(F.count("*").alias("copies"))
    copies = F.col("copies")
    cells = (
        people.join(ages, "voter_id")
        .groupBy("gender", "generation", "party", "state_code")
        .agg(F.sum(F.col("n") * copies).alias("n"), F.sum(F.col("active") * copies).alias("active"))
    )
    return _crosstab(cells, least)


def month_cells(
    cleaned: DataFrame, by: Sequence[str] = (), since: str = TRENDS_SINCE
) -> DataFrame:
    recent = filter_since(cleaned, "registered_date", since)
    month = R.month_floor("registered_date").alias("registration_month")
    return recent.groupBy(*by, month).agg(
        F.count("*").alias("new_registrations"), *_per_party("registrations"), *_ages()
    )


def monthly_registrations_of(cells: DataFrame) -> DataFrame:
    return cells.select(
        "registration_month", "new_registrations",
        *(f"{p.lower()}_registrations" for p in PARTIES),
        _mean_age().alias("avg_age_at_registration"),
    )


def monthly_registrations(cleaned: DataFrame, since: str = TRENDS_SINCE) -> DataFrame:
    """Per registration month from ``since`` on; unknown dates fall out of the range."""
    return monthly_registrations_of(month_cells(cleaned, since=since))


def registration_trends_of(cells: DataFrame) -> DataFrame:
    total = running_total("new_registrations", "registration_month")
    moving = centered_moving_avg("new_registrations", "registration_month")
    return monthly_registrations_of(cells).withColumns(
        {"cumulative_registrations": total, "moving_avg_registrations": moving}
    )


def registration_trends(cleaned: DataFrame, since: str = TRENDS_SINCE) -> DataFrame:
    """Monthly counts with running total and moving average over the month rows."""
    return registration_trends_of(month_cells(cleaned, since=since))


def _issue_counts() -> list[Column]:
    return [
        F.count("*").alias("cleaned_count"),
        R.conditional_count(F.col("has_missing_data")).alias("missing_data_count"),
        R.conditional_count(F.col("has_invalid_age")).alias("invalid_age_count"),
        R.conditional_count(~F.col("is_valid_email")).alias("invalid_email_count"),
    ]


def dq_summary_of(totals: DataFrame) -> DataFrame:
    complete = F.col("cleaned_count") - F.col("missing_data_count")
    return totals.withColumn("data_completeness_pct", R.pct_of(complete, "raw_count", 2))


def dq_summary(raw: DataFrame, staged: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Record counts per layer and issue counts, in one row."""
    return dq_summary_of(
        one_row(
            raw.agg(F.count("*").alias("raw_count")),
            staged.agg(F.count("*").alias("staged_count")),
            cleaned.agg(*_issue_counts()),
        )
    )


#: Columns of the totals, in the order of the summary.
TOTALS = (
    "raw_count", "staged_count", "cleaned_count", "missing_data_count", "invalid_age_count",
    "invalid_email_count",
)
TOTALS_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in TOTALS])


def total_cells(raw: DataFrame, cleaned: DataFrame, by: Sequence[str]) -> DataFrame:
    """Record and issue counts per batch, of both layers, to be added up."""
    loaded = raw.groupBy(*by).agg(
        F.count("*").alias("raw_count"), F.count("id").alias("staged_count")
    )
    counted = cleaned.groupBy(*by).agg(*_issue_counts())
    both = loaded.unionByName(counted, allowMissingColumns=True)
    return both.select(*by, *(F.coalesce(c, F.lit(0)).alias(c) for c in TOTALS))


@dataclass(frozen=True)
class CellMart:
    """A mart in two steps: cells of records, by ``keys``, and the mart made of all cells."""

    keys: tuple[str, ...]
    cells: Callable[..., DataFrame]
    made_of: Callable[[DataFrame], DataFrame]


CELL_MARTS = {
    "state_summary": CellMart(("state_code", "age"), state_cells, state_summary_of),
    "party_distribution": CellMart(("party",), party_cells, party_distribution_of),
    "engagement_metrics": CellMart(
        ("voter_status", "registration_cohort"), engagement_cells, engagement_metrics_of
    ),
    "demographic_crosstab": CellMart(
        ("gender", "generation", "party", "state_code"),
        crosstab_cells,
        lambda cells: _crosstab(cells, SMALL_CELL),
    ),
    "registration_trends": CellMart(("registration_month",), month_cells, registration_trends_of),
}


def merged_cells(cells: DataFrame, keys: Sequence[str], batch: str = "source_file_hash") -> DataFrame:
    """Cells of several batches added up."""
    sums = [c for c in cells.columns if c not in (*keys, batch)]
    return cells.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))


def dq_summary_of_cells(cells: DataFrame) -> DataFrame:
    """The summary from totals per batch. Without any, layers count 0 and issues NULL, as over no records."""
    layers = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS[:3]]
    return dq_summary_of(cells.agg(*layers, *(F.sum(c).alias(c) for c in TOTALS[3:])))


MARTS = {
    "state_summary": state_summary,
    "party_distribution": party_distribution,
    "engagement_metrics": engagement_metrics,
    "demographic_crosstab": demographic_crosstab,
    "registration_trends": registration_trends,
}
