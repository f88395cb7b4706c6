"""Percentages, rounding and conditional counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import col


def round_half_away(value: Column, places: int) -> Column:
    """Scale, round to a whole number away from zero on ties, scale back, in DOUBLE."""
    scale = float(10**places)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def pct_of(part: Column | str, whole: Column | str, places: int = 1) -> Column:
    """Rounded percentage, NULL over a zero whole."""
    share = F.lit(100.0) * col(part) / F.nullif(col(whole), F.lit(0))
    return round_half_away(share, places)


def conditional_count(condition: Column) -> Column:
    """Rows for which the condition holds; NULL when there are no rows at all."""
    return F.sum(F.when(condition, 1).otherwise(0))
