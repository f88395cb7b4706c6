"""Aggregates that a plain groupBy does not give directly.

Each pre-counts at (group, value) grain first. That step is a hash aggregate with a
map-side part, so a group holding a third of all rows shrinks to its distinct values
before anything is shuffled, and the second step sees counts instead of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


RECORDS = "_records"


def weighted_median(value: str, weight: str) -> Column:
    """Interpolated median of ``value`` repeated ``weight`` times; NULL values ignored."""
    return F.percentile(F.col(value), 0.5, F.col(weight))


def weighted_mode(value: str, weight: str) -> Column:
    """Most frequent value over pre-counted rows, smallest on ties; NULL values ignored.

    The input holds one row per (group, value).
    """
    rank = F.when(
        F.col(value).isNotNull(),
        F.struct((-F.col(weight)).alias("rank"), F.col(value).alias("value")),
    )
    return F.min(rank)["value"]


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys, value).agg(F.count("*").alias(RECORDS))


def approximate_median(
    df: DataFrame, keys: Sequence[str], value: str, name: str, accuracy: int = 10_000
) -> DataFrame:
    """An element near the median, of relative error 1 / accuracy, in memory of that size.

    For values of a wide domain, where the exact median would hold them all. It is never
    chosen by size; the caller asks for it.
    """
    return df.groupBy(*keys).agg(F.percentile_approx(value, 0.5, accuracy).alias(name))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Holds the distinct values of a group in one task: for short domains such as ages."""
    return value_counts(df, keys, value).groupBy(*keys).agg(weighted_median(value, RECORDS).alias(name))


def ordered_mode(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return value_counts(df, keys, value).groupBy(*keys).agg(weighted_mode(value, RECORDS).alias(name))


def count_distinct(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return value_counts(df, keys, value).groupBy(*keys).agg(F.count(value).alias(name))


def one_row(*totals: DataFrame) -> DataFrame:
    """Columns of several one-row results side by side, by stacking and not by joining."""
    stacked = totals[0]
    for frame in totals[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))
