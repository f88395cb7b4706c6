"""Scalar rules on edge values, next to DuckDB where it defines the result."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from rollcall import functions as R
from rollcall.functions.states import STATE_LOOKUP, STATE_NAMES


def apply(spark, rule, values, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    rows = df.select("i", rule(F.col("v")).alias("out")).collect()
    return [r["out"] for r in sorted(rows)]


def duck(expression, values):
    con = duckdb.connect()
    return [con.execute(f"SELECT {expression}", [v]).fetchone()[0] for v in values]


INTEGERS = [
    "45", "+45", "-45", " 45 ", "\t45\n", "45.7", "44.5", "-44.5", "45.", ".", ".5", "1e2", "1E2",
    "1e-1", "4.56e1", "45d", "45f", "NaN", "Infinity", "inf", "0x10", "0X1f", "0b11", "4_5", "_45",
    "45_", "4__5", "4_5.5", "1e", "--5", "5 5", "2147483647.4", "2147483647", "2147483648",
    "-2147483648", "9999999999", "1e400", "00045", "1,000", "45 ", "1e10", "", " ", "true",
    "0x", "+4_5", "44.49999999999999999999", None, "abc",
]


def test_safe_int_cast_matches_duckdb(spark):
    assert apply(spark, R.safe_int_cast, INTEGERS) == duck("TRY_CAST(? AS INTEGER)", INTEGERS)


SPACES = [
    "a", " a ", "\u00a0a\u3000", "\u2007a b\u1680", "\ta", "a\n", "\u200ba", "  ", "\u00a0", "", None, "é ", " ü",
]


def test_trim_matches_duckdb(spark):
    assert apply(spark, R.trim_text, SPACES) == duck("trim(CAST(? AS VARCHAR))", SPACES)
    assert apply(spark, R.trim_upper, [" m\u00a0"]) == ["M"]
    assert apply(spark, R.trim_lower, [" A@B.C "]) == ["a@b.c"]


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2024-01-05", dt.date(2024, 1, 5)),
        ("2024-01-05 10:20:30", dt.date(2024, 1, 5)),
        ("2024-01-05T10:20:30", dt.date(2024, 1, 5)),
        ("1/5/2024", dt.date(2024, 1, 5)),
        ("01/05/2024", dt.date(2024, 1, 5)),
        ("12/31/2024 9:05:00", dt.date(2024, 12, 31)),
        ("2/29/2024", dt.date(2024, 2, 29)),
        ("2/29/2023", None),
        ("13/01/2024", None),
        ("00/10/2024", None),
        ("2024-02-30", None),
        ("2024-1-5", None),
        (" 2024-01-05", None),
        ("2024-01-05 ", None),
        ("2024-01-05\n", None),
        ("1/5/2024\n", None),
        ("2024-01-05 10:20:30.5", None),
        ("2024-01-05T10:20:30Z", None),
        ("2024-01-05 1:20:30", None),
        ("1/5/24", None),
        ("1/5/02024", None),
        ("1/5/2024 9:5:00", None),
        ("1-5-2024", None),
        ("garbage", None),
        ("", None),
        (" ", None),
        (None, None),
    ],
)
def test_parse_flexible_date(spark, text, day):
    assert apply(spark, R.parse_flexible_date, [text]) == [day]


def test_every_state_spelling(spark):
    assert len(STATE_NAMES) == 51
    assert len(STATE_LOOKUP) == 104
    spelled = list(STATE_LOOKUP)
    assert apply(spark, R.standardize_state, spelled) == list(STATE_LOOKUP.values())
    lowered = [f" {s.lower()} " for s in spelled]
    assert apply(spark, R.standardize_state, lowered) == list(STATE_LOOKUP.values())


def test_unmapped_states(spark):
    values = ["Puerto Rico", "", "  ", None, "Calif", "WASHINGTON", "D.C."]
    assert apply(spark, R.standardize_state, values) == [None] * 5 + ["WA", None]


def test_email_plausible(spark):
    values = ["a@b.c", "a.b@c", "a@b", "ab.cd", "@.ab", "a@.b", "     ", "", None, "@.abc"]
    wanted = [True, True, False, False, False, False, False, False, False, True]
    assert apply(spark, R.email_plausible, values) == wanted


def test_gender_and_defaults(spark):
    values = ["M", "MALE", "F", "FEMALE", "X", "", None]
    assert apply(spark, R.normalize_gender, values) == ["M", "M", "F", "F", "U", "U", "U"]
    assert apply(spark, R.default_if_null, [None, "", "A"]) == ["UNKNOWN", "", "A"]


def test_age_rules(spark):
    ages = [17, 18, 24, 25, 40, 41, 56, 57, 75, 76, 120, 121, None]
    bounded = apply(spark, R.bounded_or_null, ages, "int")
    assert bounded == [None, *ages[1:11], None, None]
    assert apply(spark, R.out_of_range_flag, ages, "int") == [True] + [False] * 10 + [True, True]
    wanted = ["unknown", "gen_z", "gen_z", "millennial", "millennial", "gen_x", "gen_x", "boomer",
              "boomer", "silent", "silent", "silent", "unknown"]
    assert apply(spark, R.age_generation, ages, "int") == wanted


def test_bands_and_scores(spark):
    days = [dt.date(2024, 1, 1), dt.date(2023, 12, 31), dt.date(2021, 5, 5), dt.date(2019, 1, 1),
            dt.date(2015, 12, 31), None]
    cohorts = ["2024_new", "2022_2023", "2020_2021", "2016_2019", "pre_2016", "pre_2016"]
    statuses = ["active_2024", "active_2022", "active_2020", "inactive", "inactive", "never_voted"]
    assert apply(spark, R.engagement_cohort, days, "date") == cohorts
    assert apply(spark, R.recency_status, days, "date") == statuses
    assert apply(spark, R.engagement_score, statuses) == [100, 75, 50, 10, 10, 25]


def test_percentages_match_duckdb(spark):
    pairs = [(a, b) for b in range(0, 80) for a in range(0, b + 1)]
    df = spark.createDataFrame([(a, b) for a, b in pairs], "a long, b long")
    rows = df.select("a", "b", R.pct_of("a", "b").alias("p1"), R.pct_of("a", "b", 2).alias("p2"))
    got = {(r.a, r.b): (r.p1, r.p2) for r in rows.collect()}
    wanted = duckdb.sql(
        "SELECT a, b, round(100.0 * a / nullif(b, 0), 1), round(100.0 * a / nullif(b, 0), 2) "
        "FROM range(0, 80) x(b), range(0, 80) y(a) WHERE a <= b"
    ).fetchall()
    assert got == {(a, b): (p1, p2) for a, b, p1, p2 in wanted}


def test_conditional_count_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "v int")
    assert empty.agg(R.conditional_count(F.col("v") > 0).alias("n")).first()["n"] is None
