"""Codes against plain loops over Python integers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from rollcall.llm.vector_codes import dot, limbs, nearest, pieces, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, v int, dim string"
MOST = 2**63 - 1


def brute(rows, parts, entries, rounds):
    """{(id, code, error, label_error, sha)} of rows (id, vector, label)."""
    good = [(i, v, lab) for i, v, lab in rows if v and len(v) % parts == 0 and all(c is not None and math.isfinite(c) for c in v)]
    exact = lambda c: math.floor(c * 256) if abs(c) < 1e300 else int(c) * 256
    ints = [(i, [exact(c) for c in v], lab, v) for i, v, lab in good]
    out, labels = [], {}
    for dim in {len(v) for _, v, _, _ in ints}:
        mine = [r for r in ints if len(r[1]) == dim]
        width = dim // parts
        part = lambda v, p, w=width: v[p * w : (p + 1) * w]
        first = sorted(mine, key=lambda r: (r[0] is None, r[0] or 0, r[3]))[:entries]
        books = [[part(v, p) for _, v, _, _ in first] for p in range(parts)]

        def pick(v, p):
            ds = [sum((a - b) ** 2 for a, b in zip(part(v, p), c, strict=True)) for c in books[p]]
            return ds.index(min(ds)), min(ds)

        for _ in range(rounds):
            for p in range(parts):
                groups = {}
                for _, v, _, _ in mine:
                    groups.setdefault(pick(v, p)[0], []).append(part(v, p))
                books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else b for k, b in enumerate(books[p])]
        sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
        for i, v, lab, _ in mine:
            found = [pick(v, p) for p in range(parts)]
            error = min(sum(d for _, d in found), MOST)
            labels[lab] = labels.get(lab, 0) + error
            out.append((i, "".join(f"{e:02x}" for e, _ in found), error, lab, sha))
    return sorted(((i, c, e, min(labels[lab], MOST), s) for i, c, e, lab, s in out), key=repr)


def codes(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, lab, 0, "x") for i, v, lab in rows], SCHEMA).repartition(3)
    coded, _ = vector_codes(frame, **options)
    assert coded.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, coded.collect()), key=repr)


def test_like_plain_loops(spark):
    r = np.random.default_rng(1)
    rows = [(int(i), (r.normal(size=12) * r.choice([0.01, 1, 50])).tolist(), [None, 1, 2][i % 3]) for i in r.permutation(150)]
    rows += [(300 + i, rows[0][1], 2) for i in range(40)]  # equal vectors
    assert codes(spark, rows, parts=4, entries=8, rounds=2) == brute(rows, 4, 8, 2)


def test_rows_without_part_ties_and_lengths(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [0.0, 0.0], 1), (2, [0.0, 0.0], 1), (3, None, 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [], 1), (8, [1.0, 2.0, 3.0], 1),
        (9, [1.0, 2.0, 3.0, 4.0], None), (10, [-1.0, 2.5, 3.0, 4.0], None), (None, [5.0, 5.0], 2), (None, [-5.0, 5.0], 2), (1, [-0.001, 0.001], 3), (1, [0.0, 0.0], 3),
    ]
    got = codes(spark, rows, parts=2, entries=3, rounds=2)
    assert got == brute(rows, 2, 3, 2) and len(got) == 8


@pytest.mark.parametrize("size", [2.0**21, 1e12, 1e200, 1.7e308])
def test_huge_components(spark, size):
    rows = [(i, [size * (i % 3 - 1), 0.5 * i, -size if i % 5 == 0 else float(i), 1.0], i % 2) for i in range(30)]
    assert codes(spark, rows, parts=2, entries=4, rounds=2) == brute(rows, 2, 4, 2)


def test_a_label_of_its_own_for_most_rows_beside_frequent_ones(spark):
    rows = [(i, [float(i % 7), float(i % 3)], 5 if i % 3 == 0 else None if i % 3 == 1 else 1000 + i) for i in range(3100)]
    assert codes(spark, rows, parts=2, entries=2, rounds=1) == brute(rows, 2, 2, 1)


def test_empty(spark):
    assert codes(spark, []) == codes(spark, [(1, None, 1)]) == []


def test_result_does_not_depend_on_partitions(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    a, books = vector_codes(df.repartition(2))
    b, _ = vector_codes(df.repartition(9))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert {d: c.shape for d, c in books.items()} == {64: (16, 64, 4)}


def test_limb_products_are_exact():
    r = np.random.default_rng(2)
    for top in (10, 2**20, 2**29):
        x, c = r.integers(-top, top, (50, 4)), r.integers(-top, top, (9, 4))
        assert (dot(x, c) == x.astype(object) @ c.T.astype(object)).all()
        for bits in (7, 25):
            back = sum(part.astype(np.int64) << (bits * k) for k, part in enumerate(limbs(x, bits)))
            assert (back == x).all()
        best, error = nearest(x, c)
        whole = ((x[:, None, :] - c[None]).astype(object) ** 2).sum(axis=2)
        assert best.tolist() == [row.tolist().index(min(row)) for row in whole] and error.tolist() == [min(row) for row in whole]
    assert len(limbs(np.array([[2**29]]), 25)) == 2


def test_sums_in_pieces():
    for value in (0, -1, 5, -(2**40), 2**40, 2**100 + 7, -(2**130) + 3):
        assert sum(p << (40 * k) for k, p in enumerate(pieces(value))) == value
