"""Row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import as_date


def filter_null_key(df: DataFrame, key: str = "id") -> DataFrame:
    return df.where(F.col(key).isNotNull())


def filter_flag(df: DataFrame, flag: str, value: bool = False) -> DataFrame:
    return df.where(F.col(flag) if value else ~F.col(flag))


def filter_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def filter_since(df: DataFrame, column: str, start: str | dt.date) -> DataFrame:
    return df.where(F.col(column) >= as_date(start))


def in_half_open(column: str, start: str | dt.date, end: str | dt.date) -> Column:
    return (F.col(column) >= as_date(start)) & (F.col(column) < as_date(end))


def filter_half_open(
    df: DataFrame, column: str, start: str | dt.date, end: str | dt.date
) -> DataFrame:
    return df.where(in_half_open(column, start, end))


def date_range_slice(
    df: DataFrame,
    column: str,
    start: str | dt.date = "2015-01-01",
    end: str | dt.date = "2024-12-31",
) -> DataFrame:
    """Both ends included."""
    return df.where(F.col(column).between(as_date(start), as_date(end)))


def optional_membership(df: DataFrame, column: str, wanted: Sequence[str] | None) -> DataFrame:
    """An empty choice keeps everything."""
    return df.where(F.col(column).isin(*wanted)) if wanted else df


def having_min_count(df: DataFrame, column: str, least: int) -> DataFrame:
    return df.where(F.col(column) >= least)
