"""Windows over a whole (already aggregated) series.

A window without partitions runs in one task. It is meant for series with one row per
calendar month, whose length does not depend on the number of records.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def running_total(value: str, order: str) -> Column:
    """Sum up to the current value of ``order``, rows with an equal value included."""
    return F.sum(value).over(Window.orderBy(order))


def centered_moving_avg(value: str, order: str, reach: int = 2) -> Column:
    """Average over ``reach`` rows on both sides; the edges use fewer rows."""
    return F.avg(value).over(Window.orderBy(order).rowsBetween(-reach, reach))
