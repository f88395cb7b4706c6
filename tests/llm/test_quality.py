"""The line classifier: sums against enumeration, and accuracy on held-out labels."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from rollcall.llm.common import table
from rollcall.llm.quality import NODE, expand, keep_good, line_features, line_starts, marginals, quality_scores, score_texts, slopes

SF = "/root/testdata/sf0.01"


def step(texts):
    raw = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_lines():
    data, at = step(["a\nbb\n", "", "\n", "x\n\ny", "tail"])
    edges, first = line_starts(data, at)
    got = [[bytes(data[edges[k] : edges[k + 1]]) for k in range(first[i], first[i + 1])] for i in range(5)]
    assert got == [[b"a\n", b"bb\n"], [b""], [b"\n"], [b"x\n", b"\n", b"y"], [b"tail"]]


def test_features_of_a_row_do_not_depend_on_the_rows_around_it():
    texts = ["One line, two.\nThen 5 more!!\n\n$$$ ###", "", "a | b | c\nA B\nz", None, "word " * 500]
    together, _, first = line_features(*step(texts))
    for i, t in enumerate(texts):
        alone, _, _ = line_features(*step([t]))
        assert alone.shape[1] == NODE and np.allclose(alone, together[first[i] : first[i + 1]])


def test_marginals_are_sums_over_all_labellings():
    r = np.random.default_rng(0)
    first = np.array([0, 3, 4, 9, 11])
    unary, tie = r.normal(size=11), r.normal(size=(2, 2))
    p, pairs, total = marginals(unary, tie, first)
    expected = np.zeros((2, 2))
    for k, (a, b) in enumerate(itertools.pairwise(first)):
        weights, good = 0.0, np.zeros(b - a)
        seen = np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(u for u, v in zip(unary[a:b], y, strict=True) if v) + sum(tie[i, j] for i, j in itertools.pairwise(y)))
            weights += w
            good += w * np.array(y)
            for i, j in itertools.pairwise(y):
                seen[i, j] += w
        assert np.allclose(p[a:b], good / weights) and np.isclose(total[k], np.log(weights))
        expected += seen / weights
    assert np.allclose(pairs, expected)


def test_the_fit_follows_the_slope_of_its_likelihood():
    r = np.random.default_rng(1)
    first = np.array([0, 3, 4, 9, 11])
    x, theta, tie = r.normal(size=(11, 4)), r.normal(size=4), r.normal(size=(2, 2))
    label, weight = np.repeat([1.0, 0.0, 0.0, 1.0], np.diff(first)), np.repeat(r.random(4), np.diff(first))
    at = lambda t, u: slopes(x, first, label, weight, t, u, 0.01)
    _, by_theta, by_tie = at(theta, tie)
    for place, slope in [*np.ndenumerate(by_theta)]:
        step = np.zeros(4)
        step[place] = 1e-5
        assert np.isclose((at(theta + step, tie)[0] - at(theta - step, tie)[0]) / 2e-5, slope, atol=1e-7)
    for place, slope in [*np.ndenumerate(by_tie)]:
        step = np.zeros((2, 2))
        step[place] = 1e-5
        assert np.isclose((at(theta, tie + step)[0] - at(theta, tie - step)[0]) / 2e-5, slope, atol=1e-7)


@pytest.fixture(scope="module")
def scored(spark):
    labels = table(spark, SF, "labels")
    rows = quality_scores(table(spark, SF, "documents"), labels).collect()
    return rows, {r["doc_id"]: r["quality"] for r in labels.collect()}


def test_held_out_accuracy(scored):
    rows, labels = scored
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    tested = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(tested) > 50 and np.mean([p == y for p, y in tested]) > 0.97


def test_edge_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, "text without id"), (4, "x" * 100_000), (5, "word\n" * 20_000), (6, "same"), (6, "same")]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, 1, 0), (4, 0, 0), (5, None, 0), (None, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int")
    got = quality_scores(docs_of(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 6}) == 1
    one_kind = labels.where("quality = 1")
    assert {r["score"] for r in quality_scores(docs_of(rows), one_kind).collect()} == {0.5}
    assert quality_scores(docs_of([], 1), labels).count() == 0
    kept = keep_good(docs_of(rows), labels)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(repr(r["doc_id"]) for r in got if r["predicted"])


def test_score_is_the_mean_of_the_lines_weighted_by_length():
    text = "good line\nbad ### $$$\nlast one here\n"
    model = {"mean": np.zeros(NODE), "spread": np.ones(NODE), "theta": np.random.default_rng(2).normal(size=2 * NODE + 1), "tie": np.array([[0.5, -0.5], [-0.2, 0.3]])}
    node, size, first = line_features(*step([text]))
    p, _, _ = marginals(expand(node, model["mean"], model["spread"]) @ model["theta"], model["tie"], first)
    assert np.isclose(score_texts(pa.array([text]), model)[0], ((size + 1) * p).sum() / (size + 1).sum(), atol=1e-8)
