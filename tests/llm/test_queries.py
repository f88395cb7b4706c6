"""Every query of the subpackage, and its SQL counterpart where there is one."""

from __future__ import annotations

import pytest
from compare import duck, duck_result, spark_result

import corpus_pipeline
from rollcall.llm.oracle import ORACLE_SQL
from rollcall.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_result(spark, name):
    types, rows = spark_result(QUERIES[name](spark, SF))
    wanted_types, wanted = duck_result(duck(SF), ORACLE_SQL[name])
    assert types == wanted_types
    assert rows == wanted and rows


def test_stages_are_named_functions():
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources", "token files"]
