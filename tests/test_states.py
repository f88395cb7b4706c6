"""States of batches, merged, against the same results over all rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators import aggregates, states

EDGES = (0, -1, 1, 32767, 32768, 32769, -32768, -32769, 2**31, -(2**31), 2**62, -(2**62))


def rows(spark, kind):
    r = random.Random(5)
    drawn = [(r.choice(["a", "b", None, "hot", "hot", "hot"]), r.choice([None, *range(40)]), r.randrange(3)) for _ in range(600)]
    if kind == "edges":
        drawn = [("a", v, i % 3) for i, v in enumerate(EDGES)] + [("a", v, (i + 1) % 3) for i, v in enumerate(EDGES)]
    if kind == "nulls":
        drawn = [("a", None, 0), ("a", None, 2), ("b", None, 1), ("b", 7, 2), (None, 7, 0)]
    if kind == "empty":
        drawn = []
    return spark.createDataFrame(drawn, "g string, v long, batch int")


def parts(df, make):
    return [make(df.where(F.col("batch") == n)) for n in range(3)]


def same(found, wanted):
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    assert found.schema.simpleString() == wanted.schema.simpleString()


@pytest.mark.parametrize("kind", ["drawn", "edges", "nulls", "empty"])
def test_merged_states_equal_the_result_over_all_rows(spark, kind):
    df = rows(spark, kind)
    counts = states.merged_counts(parts(df, lambda b: states.counts_state(b, ["g"], "v")), ["g"], "v")
    results = states.of_counts(counts, ["g"], mode=states.mode_of("v"), median=states.median_of("v"), n=states.distinct_of("v"))
    same(results.select("g", "mode"), aggregates.ordered_mode(df, ["g"], "v", "mode"))
    same(results.select("g", "median"), aggregates.exact_median(df, ["g"], "v", "median"))
    same(results.select("g", "n"), aggregates.count_distinct(df, ["g"], "v", "n"))
    bitmaps = states.merged_bitmaps(parts(df, lambda b: states.bitmap_state(b, ["g"], "v")), ["g"])
    wanted = aggregates.count_distinct(df, ["g"], "v", "n")
    found = states.distinct_of_bitmaps(bitmaps, ["g"], "n")
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_states_merge_in_any_grouping_and_survive_storage(spark, tmp_path):
    df = rows(spark, "drawn")
    for name, make, merge, read in (
        ("counts", lambda b: states.counts_state(b, ["g"], "v"), lambda s: states.merged_counts(s, ["g"], "v"),
         lambda m: states.of_counts(m, ["g"], n=states.distinct_of("v"), mode=states.mode_of("v"))),
        ("bits", lambda b: states.bitmap_state(b, ["g"], "v"), lambda s: states.merged_bitmaps(s, ["g"]),
         lambda m: states.distinct_of_bitmaps(m, ["g"], "n")),
    ):
        for n, state in enumerate(parts(df, make)):
            state.write.parquet(str(tmp_path / f"{name}{n}"))
        a, b, c = (spark.read.parquet(str(tmp_path / f"{name}{n}")) for n in range(3))
        wanted = sorted(map(str, read(merge([make(df)])).collect()))
        for merged in (merge([a, b, c]), merge([merge([c, a]), b]), merge([a, merge([b, c])])):
            assert sorted(map(str, read(merged).collect())) == wanted


def test_ties_between_batches_give_the_smallest_value(spark):
    df = spark.createDataFrame([("a", "x", 0), ("a", "y", 1), ("a", "y", 0), ("a", "x", 2), ("a", None, 2)], "g string, v string, batch int")
    counts = states.merged_counts(parts(df, lambda b: states.counts_state(b, ["g"], "v")), ["g"], "v")
    assert states.of_counts(counts, ["g"], mode=states.mode_of("v"), n=states.distinct_of("v")).collect() == [("a", "x", 2)]
