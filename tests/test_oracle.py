"""Every query against its SQL counterpart."""

from __future__ import annotations

import os

import pytest
from compare import duck, duck_result, spark_result

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SUBJECT = entry_module.QUERIES  # the registry's own; others have tests of their own
QUERIES, ORACLE = SUBJECT, {k: v for k, v in entry_module.oracle_sql().items() if k in SUBJECT}
# Queries whose row order is part of the result, by their sort columns; descending ones with a minus.
ORDERED = {
    "s1_ordered_state_summary": ["-total_voters"],
    "s1_ordered_party_distribution": ["-total_voters"],
    "s1_ordered_engagement_metrics": ["-engagement_score", "-voter_count"],
    "s1_ordered_demographic_crosstab": ["generation", "gender", "party"],
    "s1_ordered_registration_trends": ["-registration_month"],
    "s2_top_states": ["-total_voters", "state_code"],
    "s3_last_months": ["-registration_month"],
    "k3_status_totals": ["-voter_count"],
    "k9_trend_slice": ["registration_month"],
    "k12_mart_reader": ["-engagement_score", "-voter_count"],
}
GENERATIONS = ["gen_z", "millennial", "gen_x", "boomer", "silent", None]
# Data checks that find nothing in this registry.
EMPTY = {
    "j2_not_null_voter_id", "j2_not_null_is_valid_email", "j4_accepted_range",
    "j5_not_future_date",
}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(SUBJECT) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, con, name):
    types, rows = spark_result(QUERIES[name](spark, SF_DIR))
    wanted_types, wanted = duck_result(con, ORACLE[name])
    assert types == wanted_types
    assert rows == wanted
    assert (name in EMPTY) == (not rows)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 5


def sort_key(row, columns):
    """Sorts as the query should: NULLs last either way."""
    key = []
    for c in columns:
        value = row[c.removeprefix("-")]
        if value is not None and c.startswith("-"):
            value = -(value.toordinal() if hasattr(value, "toordinal") else value)
        key.append((value is None, value if value is not None else 0))
    return key


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_are_in_order(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    keys = [sort_key(r, ORDERED[name]) for r in rows]
    assert len(keys) > 1 and keys == sorted(keys)


def test_every_sorted_query_is_looked_at():
    assert {q for q in QUERIES if q.startswith("s1_")} <= set(ORDERED)


def test_generations_are_in_their_fixed_order(spark):
    rows = QUERIES["k6_generation_totals"](spark, SF_DIR).collect()
    assert [r.generation for r in rows] == GENERATIONS[:-1]
    rows = QUERIES["k8_generation_by_party"](spark, SF_DIR).collect()
    places = [(r.party, GENERATIONS.index(r.generation)) for r in rows]
    assert len(places) > 5 and places == sorted(places)
