"""Dates written in several ways, and date arithmetic against a fixed day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import col

# The four accepted shapes, two with an optional time of day.
# \A and \z, because $ would also match before a trailing newline.
YEAR_FIRST = r"\A\d{4}-\d\d-\d\d(?:[ T]\d\d:\d\d:\d\d)?\z"
MONTH_FIRST = r"\A\d\d?/\d\d?/\d{4}(?: \d\d?:\d\d:\d\d)?\z"


def as_date(value: Column | str | dt.date) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def as_timestamp(value: Column | str | dt.datetime) -> Column:
    """Read in the session time zone."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def parse_flexible_date(c: Column | str) -> Column:
    """Text to DATE by the accepted shapes; other shapes and impossible days give NULL.

    The value is matched as it stands, so padding makes it unreadable on purpose.
    """
    c = col(c)
    day = F.substring_index(c, " ", 1)
    month_and_day = F.replace(F.substring_index(day, "/", 2), F.lit("/"), F.lit("-"))
    turned = F.concat(F.substring_index(day, "/", -1), F.lit("-"), month_and_day)
    return F.when(c.rlike(YEAR_FIRST), F.left(c, F.lit(10)).try_cast("date")).when(
        c.rlike(MONTH_FIRST), turned.try_cast("date")
    )


def years_since(c: Column | str, as_of: Column | str | dt.date) -> Column:
    """Difference of the calendar years."""
    return F.year(as_date(as_of)) - F.year(col(c))


def days_since(c: Column | str, as_of: Column | str | dt.date) -> Column:
    return F.datediff(as_date(as_of), col(c))


def month_floor(c: Column | str) -> Column:
    return F.trunc(col(c), "MM")
