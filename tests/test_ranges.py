"""Running totals, moving averages and medians in ranges, against windows and percentiles of the whole."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rollcall.operators import ranges

ROWS = [(i, None if i % 17 == 0 else i * 7919 % 501, None if i % 11 == 0 else i % 13, "hot" if i % 3 else None if i % 2 else f"g{i % 5}") for i in range(3000)]
SCHEMA = "id long, day long, n int, g string"


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).cache()


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@pytest.mark.parametrize("order", ["day", "id"])
def test_running_total(rows, order):
    whole = rows.withColumn("t", F.sum("n").over(Window.orderBy(order)))
    same(ranges.running_total_by_range(rows, "n", order, "t"), whole)


@pytest.mark.parametrize("piece", [7, 100_000])
def test_moving_avg(rows, piece):
    near = Window.orderBy("day", "id").rowsBetween(-3, 3)
    got = ranges.centered_moving_avg_by_range(rows, "n", ["day", "id"], "m", 3, piece)
    same(got, rows.withColumn("m", F.avg("n").over(near)))
    with pytest.raises(ValueError, match="reach"):
        ranges.centered_moving_avg_by_range(rows, "n", ["id"], "m", 8, 7)


def test_medians(rows):
    for keys in (["g"], [], ["g", "n"]):
        got = ranges.exact_median_by_range(rows, keys, "day", "m")
        whole = rows.groupBy(*keys).agg(F.percentile("day", 0.5).alias("m"))
        same(got, whole.select(*got.columns))
    nothing = rows.where("day is null")
    assert ranges.exact_median_by_range(nothing, [], "day", "m").collect()[0].m is None
    assert {r.m for r in ranges.exact_median_by_range(nothing, ["g"], "day", "m").collect()} == {None}


def test_many_values_of_one_group(spark):
    wide = spark.range(1_000_001).select((F.col("id") * 3).alias("v"), F.lit("one").alias("g"))
    assert ranges.exact_median_by_range(wide, ["g"], "v", "m").first().m == 1_500_000.0


def test_no_task_gets_everything(rows):
    for df in (ranges.running_total_by_range(rows, "n", "id", "t"), ranges.centered_moving_avg_by_range(rows, "n", ["id"], "m", 2, 100)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        # One row per range is all that meets in one partition.
        assert plan.count("Exchange SinglePartition") == 1


def test_empty(rows):
    none = rows.where("id < 0")
    assert ranges.running_total_by_range(none, "n", "day", "t").count() == 0
    assert ranges.centered_moving_avg_by_range(none, "n", ["day"], "m").count() == 0
    assert ranges.exact_median_by_range(none, ["g"], "day", "m").count() == 0
