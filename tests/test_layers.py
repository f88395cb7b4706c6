"""Quirks of the layers and marts on hand-made records."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollcall.fixture import AS_OF, RUN_TS
from rollcall.operators import aggregates
from rollcall.plans import layers, marts, quality, reports
from rollcall.schema import RAW_COLUMNS, RAW_SCHEMA

DEFAULTS = dict.fromkeys(RAW_COLUMNS) | {
    "first_name": "A", "last_name": "B", "age": "30", "gender": "m", "state": "ca",
    "party": "Democrat", "email": "a@b.co", "registered_date": "2020-05-05",
    "last_voted_date": "2024-02-02",
}


def raw(spark, *records):
    rows = [tuple((DEFAULTS | r)[c] for c in RAW_COLUMNS) + (None, "h") for r in records]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def cleaned(spark, *records):
    return layers.clean(layers.stage(raw(spark, *records)), RUN_TS)


def test_null_key_is_dropped_before_trimming(spark):
    staged = layers.stage(raw(spark, {"id": None}, {"id": " "}, {"id": " 7 "}))
    assert sorted(r.voter_id for r in staged.collect()) == ["", "7"]


def test_flags_read_staged_values(spark):
    rows = cleaned(
        spark,
        {"id": "1", "age": "150"},
        {"id": "2", "first_name": None},
        {"id": "3", "first_name": "  "},
        {"id": "4", "age": "x"},
    )
    got = {r.voter_id: r for r in rows.collect()}
    assert (got["1"].age, got["1"].has_invalid_age, got["1"].has_missing_data) == (None, True, False)
    assert (got["2"].first_name, got["2"].has_missing_data) == ("UNKNOWN", True)
    assert (got["3"].first_name, got["3"].has_missing_data) == ("", False)
    assert (got["4"].has_invalid_age, got["4"].has_missing_data) == (True, True)


def test_bounds_are_parameters(spark):
    staged = layers.stage(raw(spark, {"id": "1", "age": "17"}))
    assert layers.clean(staged, RUN_TS, min_age=16).first()["age"] == 17


def test_populations_differ_between_marts(spark):
    rows = cleaned(
        spark,
        {"id": "1"},
        {"id": "2", "state": "nowhere", "party": None},
        {"id": "3", "registered_date": None},
        {"id": "4", "registered_date": "2014-12-31"},
    )
    assert marts.state_summary(rows).first()["total_voters"] == 3
    parties = {r.party: r.total_voters for r in marts.party_distribution(rows).collect()}
    assert parties == {"Democrat": 3, None: 1}
    cohorts = Counter()
    for r in marts.engagement_metrics(rows).collect():
        cohorts[r.registration_cohort] += r.voter_count
    assert cohorts == {"2020_2021": 2, "pre_2016": 2}
    assert marts.registration_trends(rows).count() == 1


def test_state_without_known_age(spark):
    row = marts.state_summary(cleaned(spark, {"id": "1", "age": "150"})).first()
    assert (row.avg_age, row.median_age, row.total_voters) == (None, None, 1)


def test_median_and_mode(spark):
    values = [("g", 1, "b"), ("g", 4, "a"), ("g", None, "b"), ("g", 10, "a"), ("h", None, None)]
    df = spark.createDataFrame(values, "k string, n int, s string")
    medians = {r.k: r.m for r in aggregates.exact_median(df, ["k"], "n", "m").collect()}
    assert medians == {"g": 4.0, "h": None}
    modes = {r.k: r.m for r in aggregates.ordered_mode(df, ["k"], "s", "m").collect()}
    assert modes == {"g": "a", "h": None}
    distinct = {r.k: r.m for r in aggregates.count_distinct(df, ["k"], "s", "m").collect()}
    assert distinct == {"g": 2, "h": 0}


def test_repeated_ids_pair_with_each_other(spark):
    """The joined crosstab against all pairs made one by one."""
    people = [
        {"id": "1"}, {"id": " 1 ", "age": "70"}, {"id": "1  ", "age": "70", "gender": "f"},
        {"id": "2", "gender": "f"}, {"id": "3", "state": "tx"}, {"id": " 3", "state": "ca"},
    ]
    rows = cleaned(spark, *people)
    generation = {30: "millennial", 70: "boomer"}
    pairs, by_state = Counter(), {}
    records = rows.collect()
    for a in records:
        for b in records:
            if a.voter_id == b.voter_id:
                key = (a.gender, generation[b.age], a.party)
                pairs[key] += 1
                by_state.setdefault(key, Counter())[a.state_code] += 1
    got = {
        (r.gender, r.generation, r.party): r
        for r in marts.demographic_crosstab_joined(rows, least=1).collect()
    }
    assert {k: r.voter_count for k, r in got.items()} == pairs
    for key, states in by_state.items():
        assert got[key].states_represented == len(states)
        assert got[key].most_common_state == min(states, key=lambda s: (-states[s], s))
    inline = marts.demographic_crosstab(rows, least=1).agg(F.sum("voter_count")).first()[0]
    assert inline == len(people) < sum(pairs.values())


def test_small_cells_are_dropped(spark):
    rows = cleaned(spark, *({"id": str(i), "gender": "f" if i < 4 else "m"} for i in range(9)))
    assert [r.gender for r in marts.demographic_crosstab(rows).collect()] == ["M"]


def test_moving_average_skips_no_rows_and_fills_no_gaps(spark):
    days = ["2020-01-05", "2020-01-06", "2020-03-01", "2020-07-01", "2020-07-02", "2020-07-03"]
    rows = cleaned(spark, *({"id": str(i), "registered_date": d} for i, d in enumerate(days)))
    got = marts.registration_trends(rows).orderBy("registration_month").collect()
    assert [r.new_registrations for r in got] == [2, 1, 3]
    assert [r.cumulative_registrations for r in got] == [2, 3, 6]
    assert [r.moving_avg_registrations for r in got] == [2.0, 2.0, 2.0]


def test_empty_registry(spark):
    empty = raw(spark).limit(0)
    staged = layers.stage(empty)
    rows = layers.clean(staged, RUN_TS)
    dq = marts.dq_summary(empty, staged, rows)
    row = dq.first()
    assert (row.raw_count, row.missing_data_count, row.data_completeness_pct) == (0, None, None)
    assert {r.issue_pct for r in reports.dq_issue_breakdown(dq).collect()} == {0.0}
    assert [tuple(r) for r in quality.threshold_rules(dq).collect()] == [("completeness", "success")]
    trends = marts.registration_trends(rows)
    assert {r.status for r in quality.check_report(staged, rows, trends, AS_OF).collect()} == {"pass"}


def test_generations_come_in_fixed_order(spark):
    rows = cleaned(spark, *({"id": str(i), "age": "80"} for i in range(6)))
    got = reports.generation_totals(marts.demographic_crosstab(rows)).collect()
    assert [tuple(r) for r in got] == [
        ("gen_z", 0), ("millennial", 0), ("gen_x", 0), ("boomer", 0), ("silent", 6),
    ]


def test_issue_rows_come_sorted(spark):
    rows = cleaned(spark, *({"id": str(i % 5), "email": "bad"} for i in range(20)))
    got = [r.voter_id for r in reports.invalid_email_rows(rows).collect()]
    assert got == sorted(got) and len(got) == 20


@pytest.mark.parametrize("name", list(marts.MARTS))
def test_ordered_output(spark, name):
    rows = cleaned(
        spark,
        *(
            {"id": str(i), "state": "ca" if i % 3 else "tx", "gender": "mf"[i % 2],
             "party": [None, "Democrat", "Green"][i % 3], "age": str(20 + i),
             "registered_date": f"20{16 + i % 8}-0{1 + i % 9}-11"}
            for i in range(60)
        ),
    )
    got = marts.ordered_output(marts.MARTS[name](rows), name).collect()
    for c in reversed(marts.MART_ORDER[name]):
        column, down = c.lstrip("-"), c.startswith("-")
        got_sorted = sorted(
            got, key=lambda r: (r[column] is None, r[column] or 0 if down else r[column] or ""),
            reverse=down,
        )
        if c == marts.MART_ORDER[name][0]:
            assert [r[column] for r in got] == [r[column] for r in got_sorted]
