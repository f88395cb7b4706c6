"""Exact top-k against all scores."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm.topk import best_of_share, bounded_top, cuts, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score int, rank int"


def brute(rows, queries, k):
    ints = {i: [int(np.floor(256 * float(np.float32(c)))) for c in v] for i, v in rows.items()}
    out = []
    for q in queries:
        scores = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_like_brute_force(spark, block_rows):
    r = np.random.default_rng(3)
    rows = {i: r.normal(size=24).astype(np.float32).tolist() for i in range(150)}
    rows |= {200 + i: rows[5] for i in range(40)}  # many equal vectors
    rows[300], rows[301] = [0.5, 0.25], [0.125, -1.0]  # of another length
    df = frame(spark, rows.items())
    got = top_k(df, df.where(F.col("vec_id") % 5 == 0), k=5, block_rows=block_rows, group=8)
    assert sorted(map(tuple, got.collect())) == brute(rows, [i for i in rows if i % 5 == 0], 5)


def test_rows_without_part(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, []), (8, [2.0, 2.0]), (8, [1.0, 1.0])]
    df = frame(spark, rows)
    got = sorted(map(tuple, top_k(df, df, k=5).collect()))
    kept = {1: [1.0, 0.0], 2: [0.5, 0.5], 7: [], 8: [1.0, 1.0]}
    assert got == brute(kept, [1, 2, 7, 8], 5)


def test_empty(spark):
    df = frame(spark, [])
    assert top_k(df, df).count() == 0


@pytest.mark.parametrize("size", [2.0**22, 1e6, 1e12])
def test_large_components(spark, size):
    r = np.random.default_rng(5)
    rows = {i: (r.normal(size=6) * r.choice([1, size])).astype(np.float32).tolist() for i in range(60)}
    rows |= {100: [size, -size, 0.0, 0.0, 0.0, 0.0], 101: [-size, size, 0.0, 0.0, 0.0, 0.0], 102: [size, 0.0, 0.0, 0.0, 0.0, 1.0]}
    most = 2**63 - 1
    ints = {i: [int(np.floor(256 * float(np.float32(c)))) for c in v] for i, v in rows.items()}
    want = []
    for q in [i for i in rows if i % 2 == 0]:
        scores = sorted((-max(-most, min(most, sum(a * b for a, b in zip(ints[q], v, strict=True)))), i) for i, v in ints.items() if i != q)
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:5], 1)]
    df = frame(spark, rows.items())
    got = top_k(df, df.where(F.col("vec_id") % 2 == 0), k=5, block_rows=16, group=2)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_a_block_of_rows_is_a_key_of_its_own(spark):
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(1200)]
    df = frame(spark, rows)
    got = top_k(df, df, k=2, block_rows=100)
    assert sorted(map(tuple, got.collect())) == brute(dict(rows), range(1200), 2)
    assert "meets" in got._jdf.queryExecution().optimizedPlan().toString()


def test_bound_leaves_rows_out_and_keeps_the_best():
    r = np.random.default_rng(0)
    x = r.integers(-300, 300, (32, 500))
    x[:, :450] //= 20  # small vectors cannot be among the best
    q = r.integers(-300, 300, (32, 4))
    at, row, score = bounded_top(np.arange(1000, 1004), q, np.arange(500), x, 3, 8)
    exact = q.T @ x
    for i in range(4):
        best = np.lexsort((np.arange(500), -exact[i]))[:3]
        assert row[at == i].tolist() == best.tolist() and score[at == i].tolist() == exact[i, best].tolist()


def shuffled_bytes(df):
    """Of the plan that ``df.collect()`` ran."""
    total, open_ = 0, [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            total += node.metrics().apply("dataSize").value()
        inner = node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node.plan() if kind.endswith("QueryStageExec") else None
        children = node.children()
        open_ += [inner] if inner is not None else [children.apply(i) for i in range(children.size())]
    return total


def test_blocks_are_not_copied_for_every_pair(spark):
    r = np.random.default_rng(8)
    rows = {i: r.integers(-99, 99, 32).astype(float).tolist() for i in range(2000)}
    df = frame(spark, rows.items()).repartition(2)
    got = top_k(df, df, k=1, block_rows=40)
    assert len(got.collect()) == 2000
    assert 0 < shuffled_bytes(got) < 6_000_000  # 20 MB when every pair of 50 and 4 blocks was written


@pytest.mark.parametrize("asked", [1, 2])
def test_repeated_ids_of_any_length_and_size(spark, asked):
    r = np.random.default_rng(9)
    rows = [(i % 60, (r.integers(-2, 3, r.choice([0, 2, 3])) * r.choice([1.0, 1.0, 1e4, 1e9])).tolist()) for i in range(400)]
    rows += [(7, [0.5, 0.25])] * 300 + [(70, []), (71, [-1e9, 0.0]), (71, [-1e9, 0.0, 0.0])]
    kept = {}
    for i, v in rows:
        kept[i] = min(v, kept.get(i, v))
    df = frame(spark, rows).repartition(5)
    got = top_k(df, df.where(F.col("vec_id") % asked == 0), k=4, block_rows=8, group=1)
    assert sorted(map(tuple, got.collect())) == brute(kept, [i for i in kept if i % asked == 0], 4)


@pytest.mark.parametrize("fall", [0.7, 1.0])
@pytest.mark.parametrize("size", [40, 1 << 20, 1 << 40])
def test_best_of_many_blocks(fall, size):
    r = np.random.default_rng(10)
    x = (r.normal(size=(3000, 24)) * size * fall ** np.arange(24)).astype(np.int64)
    x[r.integers(0, 3000, 900)] = x[11]  # many equal rows
    if size < 100:
        x = x.astype(np.int16)
    ids = np.sort(r.choice(10_000, 3000, replace=False))
    asks = np.sort(r.choice(3000, 70, replace=False))
    blocks = [(ids[low : low + 700], np.ascontiguousarray(x[low : low + 700].T)) for low in range(0, 3000, 700)]
    found, scores = best_of_share(ids[asks], x[asks].T, blocks, 5, 4)
    for i, a in enumerate(asks):
        exact = [max(-(2**63 - 1), min(2**63 - 1, int(s))) for s in x.astype(object) @ x[a].astype(object)]
        best = sorted((-s, int(ids[j])) for j, s in enumerate(exact) if j != a)[:5]
        assert [(-s, i) for s, i in zip(scores[i].tolist(), found[i].tolist(), strict=True)] == best


def test_bounds_are_worked_out_where_they_pay():
    r = np.random.default_rng(11)
    x = (r.normal(size=(32, 4000)) * 1000 * 0.7 ** np.arange(32)[:, None]).astype(np.int32)
    q = x[:, :4]
    assert cuts(q.astype(float), x.astype(float), np.full(4, 1e6), 8) == [8]
    flat = r.integers(-100, 100, (32, 4000)).astype(float)
    assert cuts(flat[:, :64], flat, np.full(64, 1.0), 8) == []
