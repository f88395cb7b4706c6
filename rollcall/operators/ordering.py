"""Sorted output and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ascending(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def descending(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def ordered_rows(df: DataFrame, *order: Column) -> DataFrame:
    """Global sort for row-level output.

    The row's own position breaks ties, so that a key holding many equal rows is still
    divided over several sort ranges.
    """
    tie = "_position"
    numbered = df.withColumn(tie, F.monotonically_increasing_id())
    return numbered.orderBy(*order, F.col(tie)).drop(tie)


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)
