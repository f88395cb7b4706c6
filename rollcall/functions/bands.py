"""Ordered bands over dates and ages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.dates import as_date
from rollcall.functions.text import col, constant_map

# Band starts (newest first), labels, scores.
COHORTS = (
    ("2024-01-01", "2024_new"),
    ("2022-01-01", "2022_2023"),
    ("2020-01-01", "2020_2021"),
    ("2016-01-01", "2016_2019"),
)
OLDEST_COHORT = "pre_2016"
STATUSES = (
    ("2024-01-01", "active_2024"),
    ("2022-01-01", "active_2022"),
    ("2020-01-01", "active_2020"),
)
NEVER = "never_voted"
INACTIVE = "inactive"
SCORES = {
    "active_2024": 100, "active_2022": 75, "active_2020": 50, "never_voted": 25, "inactive": 10,
}
GENERATION_AGES = (
    ("gen_z", 18, 24), ("millennial", 25, 40), ("gen_x", 41, 56), ("boomer", 57, 75),
)
OLDEST_GENERATION = ("silent", 75)
UNKNOWN_GENERATION = "unknown"


def label_since(c: Column | str, bands: Sequence[tuple[str, str]], fallback: Column) -> Column:
    """Label of the newest band the date has reached, else ``fallback``."""
    c = col(c)
    picks = [F.when(c >= as_date(start), F.lit(label)) for start, label in bands]
    return F.coalesce(*picks, fallback)


def engagement_cohort(registered: Column | str) -> Column:
    """Registration cohort; an unknown date counts as the oldest."""
    return label_since(registered, COHORTS, F.lit(OLDEST_COHORT))


def recency_status(last_vote: Column | str) -> Column:
    last_vote = col(last_vote)
    rest = F.when(last_vote.isNull(), F.lit(NEVER)).otherwise(F.lit(INACTIVE))
    return label_since(last_vote, STATUSES, rest)


def engagement_score(status: Column | str, scores: dict[str, int] = SCORES) -> Column:
    known = F.try_element_at(constant_map(scores), col(status))
    return F.coalesce(known, F.lit(scores[INACTIVE]))


def age_generation(age: Column | str) -> Column:
    age = col(age)
    name, above = OLDEST_GENERATION
    picks = [F.when(age.between(low, high), F.lit(label)) for label, low, high in GENERATION_AGES]
    return F.coalesce(*picks, F.when(age > above, F.lit(name)), F.lit(UNKNOWN_GENERATION))
