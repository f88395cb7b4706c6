"""Windows and medians over a whole table, for orders with many values.

A window without partitions, or with one hot partition, is one task. Here the rows are dealt into
ranges of the order and written, each range is worked out by itself, and what a range needs of
those before it, a sum or a count, comes from one row per range. No task holds more than its
range; only a value that many rows share is in one task, after it was added up map-side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.session import new_scratch_path

#: Rows of a piece in which a moving window is worked out.
PIECE_ROWS = 100_000


def _in_ranges(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """The rows with ``_range``, written so that later reads see the same ranges."""
    path = new_scratch_path(df.sparkSession, label)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, (x.eqNullSafe(y) for x, y in zip(left, right, strict=True)))


def running_total_by_range(df: DataFrame, value: str, order: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` up to the row's value of ``order``, rows of an equal one included
    and NULL first, as a window over the whole table would.

    Values are added up per value of ``order`` first. The columns ``_range``, ``_sum``,
    ``_order`` and ``_before`` are used in between.
    """
    keyed = df.groupBy(F.col(order).alias("_order")).agg(F.sum(value).alias("_sum"))
    ranged = _in_ranges(keyed, ["_order"], "running-total")
    sums = ranged.groupBy(F.col("_range").alias("_of")).agg(F.sum("_sum").alias("_sum"))
    earlier = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    before = sums.select("_of", F.sum("_sum").over(earlier).alias("_before"))
    here = F.sum("_sum").over(Window.partitionBy("_range").orderBy("_order"))
    totals = ranged.withColumn("_here", here).join(before, F.col("_range") == F.col("_of"))
    both = F.coalesce(F.col("_here") + F.col("_before"), F.col("_here"), F.col("_before"))
    totals = totals.select("_order", both.alias(name))
    return df.join(totals, F.col(order).eqNullSafe(F.col("_order"))).drop("_order")


def centered_moving_avg_by_range(
    df: DataFrame, value: str, order: Sequence[str], name: str, reach: int = 2, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """Adds the average over ``reach`` rows on both sides in the order of ``order``, NULL first.

    Rows get their number in the whole order and are cut in pieces of ``piece_rows``; those
    within ``reach`` of a border are sent to the neighbour too. ``order`` should tell rows apart.
    """
    if reach > piece_rows:
        raise ValueError("a window must not reach over a whole piece")
    ranged = _in_ranges(df, order, "moving-avg")
    counts = ranged.groupBy(F.col("_range").alias("_of")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_of", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    number = (F.col("_local") - 1 + F.col("_before")).alias("_number")
    rows = ranged.withColumn("_local", local).join(before, F.col("_range") == F.col("_of")).select(*df.columns, number)
    piece = lambda n: F.floor(n / piece_rows).cast("long")
    at = F.col("_number")
    sent = rows.withColumn("_piece", F.explode(F.array_distinct(F.array(piece(at), piece(at - reach), piece(at + reach)))))
    near = Window.partitionBy("_piece").orderBy("_number").rowsBetween(-reach, reach)
    averaged = sent.withColumn(name, F.avg(value).over(near)).where(F.col("_piece") == piece(at))
    return averaged.select(*df.columns, name)


def exact_median_by_range(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The interpolated median of ``value`` per group, NULL values ignored, for any number of values.

    Distinct values are counted and dealt into ranges of (keys, value), so a hot group lies in
    many tasks. A row per group and range tells which ranges hold the middle ranks, and only
    those are looked at value by value. A group without values has a NULL median.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    ranged = _in_ranges(counted, [*keys, "_value"], "median")
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    groups = [F.col(f"_k{i}") for i in range(len(keys))]
    held = ranged.groupBy(*named, F.col("_range").alias("_of")).agg(F.sum("_n").alias("_rows"))
    upto = Window.partitionBy(*groups).orderBy("_of")
    held = held.withColumns({"_before": F.sum("_rows").over(upto) - F.col("_rows"), "_total": F.sum("_rows").over(Window.partitionBy(*groups))})
    low, high = F.floor((F.col("_total") + 1) / 2), F.floor(F.col("_total") / 2) + 1
    middle = held.withColumns({"_low": low, "_high": high}).where("_before < _high and _before + _rows >= _low")
    near = ranged.join(middle, _same([F.col(k) for k in keys], groups) & (F.col("_range") == F.col("_of")) if keys else F.col("_range") == F.col("_of"))
    rank = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys, "_range").orderBy("_value"))
    ranked = near.withColumn("_upto", rank)
    covers = lambda r: F.when((F.col("_upto") >= F.col(r)) & (F.col("_upto") - F.col("_n") < F.col(r)), F.col("_value"))
    first, second = F.min(covers("_low")), F.max(covers("_high"))
    found = ranked.groupBy(*named).agg((first + (second - first) * F.lit(0.5)).cast("double").alias(name))
    everyone = df.select(*keys).distinct() if keys else df.sparkSession.range(1).select()
    if not keys:
        return found.select(name) if not found.isEmpty() else everyone.select(F.lit(None).cast("double").alias(name))
    return everyone.join(found, _same([F.col(k) for k in keys], groups), "left").select(*keys, name)
