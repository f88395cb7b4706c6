"""Distinct counts, modes and medians as states that are added up.

A state is counted once from its batch, kept, and merged with those of other batches; the result
read from the merged state equals the one computed from all rows. There are two kinds:

- value counts: one row per group and value. They give the distinct count, the mode and the
  median of any type.
- bitmaps of integers: one row per group and stretch of 32,768 numbers, 4 KB each, whatever
  the number of rows. They give the distinct count only, and suit ids that lie close together.

Both are made by aggregates with a map-side part, so a group of a third of all rows is a few
rows per task before anything is shuffled, and merging shuffles states and never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.aggregates import RECORDS, value_counts, weighted_median, weighted_mode

STRETCH, BITS = "_stretch", "_bits"


def stacked(states: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, states)


def counts_state(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, _records). A NULL value keeps its group."""
    return value_counts(df, keys, value)


def merged_counts(states: Sequence[DataFrame], keys: Sequence[str], value: str) -> DataFrame:
    return stacked(states).groupBy(*keys, value).agg(F.sum(RECORDS).alias(RECORDS))


def of_counts(merged: DataFrame, keys: Sequence[str], **results: Column) -> DataFrame:
    """A row per group with results of ``mode_of``, ``median_of`` and ``distinct_of``."""
    return merged.groupBy(*keys).agg(*(column.alias(name) for name, column in results.items()))


def mode_of(value: str) -> Column:
    """The most frequent value, the smallest on ties, over merged counts; NULL is no value."""
    return weighted_mode(value, RECORDS)


def median_of(value: str) -> Column:
    """Holds a group's distinct values in one task: for short domains such as ages."""
    return weighted_median(value, RECORDS)


def distinct_of(value: str) -> Column:
    return F.count(value)


def bitmap_state(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, _stretch, _bits) of an integer column. NULL sets no bit and keeps its group."""
    number = F.col(value).cast("bigint")
    stretch = F.bitmap_bucket_number(number).alias(STRETCH)
    place = F.bitmap_bit_position(number)
    return df.groupBy(*keys, stretch).agg(F.bitmap_construct_agg(place).alias(BITS))


def merged_bitmaps(states: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    return stacked(states).groupBy(*keys, STRETCH).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_of_bitmaps(merged: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name))
