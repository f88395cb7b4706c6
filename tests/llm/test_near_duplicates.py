"""The n-gram join against all pairs, and connected components against union-find."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest

from rollcall.llm import near_duplicates as module
from rollcall.llm.common import use_checkpoints
from rollcall.llm.components import connected_components, forest
from rollcall.llm.near_duplicates import has_partner, near_duplicates, open_groups


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def roots_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def brute(rows, n=5, percent=75):
    sets = [shingles(t, n) for _, t in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    roots = roots_of(len(rows), links)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, len(s), least.get(r) if s else i) for (i, _), s, r in zip(rows, sets, roots, strict=True)), key=repr)


def check(docs_of, rows, **settings):
    got = near_duplicates(docs_of(rows), sketch_bits=12, block_docs=16, **settings)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def prose(r, n, words=300):
    return [f"w{int(r.random() ** 2 * words)}" for _ in range(n)]


def edited(r, words, share):
    return [f"e{r.random()}" if r.random() < share else w for w in words]


def test_edge_rows(docs_of):
    a = "One two three four five six seven"
    check(docs_of, [(1, None), (2, ""), (3, " \n "), (4, "short text"), (5, "SHORT\ttext"), (6, "short"), (7, a), (9, a.upper()), (8, a), (8, a), (8, "another text of an id that repeats"),
                    (None, a), (None, "text without id and alone in the world"), (10, "one two three four five"), (11, "Éa ÉA x y z"), (12, "éa éA x y z")])


@pytest.mark.parametrize(("wide", "part_rows"), [(16, 256), (2, 3), (0, 2)])
def test_groups_of_near_copies(docs_of, wide, part_rows):
    r = random.Random(wide)
    rows, passage = [], prose(r, 60)
    for g in range(6):
        base = prose(r, r.choice([8, 40, 120]))
        for _ in range(r.choice([1, 3, 25])):
            rows.append(" ".join(edited(r, base, r.choice([0, 0.005, 0.02, 0.05]))))
    for _ in range(25):  # a long passage that many share, with much or little around it
        rows.append(" ".join(prose(r, r.randrange(30)) + passage + prose(r, r.randrange(12))))
    words = prose(r, 100)
    for _ in range(12):  # a chain in which neighbours link and ends do not
        words = words[4:] + prose(r, 4)
        rows.append(" ".join(words))
    r.shuffle(rows)
    check(docs_of, list(enumerate(rows)), wide=wide, part_rows=part_rows)


def test_empty(docs_of):
    assert near_duplicates(docs_of([], 1)).count() == 0


def test_a_very_long_text(docs_of):
    r = random.Random(5)
    words = prose(r, 60_000, 9_000)
    check(docs_of, [(1, " ".join(words)), (2, " ".join(edited(r, words, 0.01))), (3, " ".join(words[:20_000])), (4, "x" * 50_000)])


@pytest.mark.parametrize("task_links", [20, 500_000])
def test_components(spark, task_links):
    r = random.Random(1)
    for n, m in ((1, 0), (50, 30), (200, 220)):
        links = [(r.randrange(n), r.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(n // 2, n - 1)]
        got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long").repartition(4), task_links).collect()))
        assert got == {i: x for i, x in enumerate(roots_of(n, links)) if i != x}


def test_forest():
    a, b = forest(np.array([5, 9, 7, 3, 8]), np.array([9, 7, 1, 3, 2]))
    assert dict(zip(a.tolist(), b.tolist(), strict=True)) == {5: 1, 7: 1, 9: 1, 8: 2}


def partners(entries, percent):
    """The entries (size, place, root) of a column that may link to one of another root, by all pairs."""
    need = lambda i, j: -(-percent * (i[0] + j[0]) // (100 + percent))
    return [any(i[2] != j[2] and 1 + min(i[0] - i[1], j[0] - j[1]) >= need(i, j) for j in entries) for i in entries]


def some_entries(r, n, percent, roots):
    sizes = [r.choice([1, 4, 7, r.randint(1, 60), r.randint(100, 140)]) for _ in range(n)]
    return [(x, r.randint(1, x - -(-percent * x // 100) + 1), r.randrange(roots)) for x in sizes]


@pytest.mark.parametrize("percent", [50, 75, 100])
def test_partners_without_pairs(percent):
    r = random.Random(percent)
    for n, roots in ((1, 1), (5, 2), (40, 2), (60, 50)):
        entries = some_entries(r, n, percent, roots)
        size, place, root = (np.array(c) for c in zip(*entries, strict=True))
        reach = (1 + size - place) * (100 + percent) // percent - size
        assert has_partner(size, reach, root, size, reach, root).tolist() == partners(entries, percent)


def test_rows_of_a_wide_column_do_not_grow_with_its_square(spark, monkeypatch):
    r, dealt = random.Random(3), {}
    entries = some_entries(r, 1200, 75, 300)
    kind = type(spark.range(1))
    plain = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda df, *by: dealt.update(rows=df.count()) or plain(df, *by))
    module.use_checkpoints(spark)
    columns = spark.createDataFrame([(1, 7, b, x, y) for b, (x, y, _) in enumerate(entries)], "a long, p long, b long, x int, y int")
    roots = spark.createDataFrame([(b, 10_000 + g) for b, (_, _, g) in enumerate(entries)], "node long, root long")
    got = {row["b"] for row in open_groups(columns, roots, 75, 2).collect()}
    assert got == {b for b, one in enumerate(partners(entries, 75)) if one} and 0 < len(got) < 1200
    assert dealt["rows"] < 3 * 1200  # 600 parts met in pairs before


def test_both_sides_sets_are_made_in_one_pass(docs_of, monkeypatch):
    calls, plain = [], module.class_sets
    monkeypatch.setattr(module, "class_sets", lambda *args: calls.append(args[-1]) or plain(*args))
    r = random.Random(9)
    base = prose(r, 60)
    check(docs_of, [(i, " ".join(edited(r, base, 0.01))) for i in range(10)])
    assert calls.count(4) == 1


def test_few_files_between_steps(spark, docs_of):
    """Few documents leave few files, whatever the number of shuffle partitions."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    use_checkpoints(spark)
    files = lambda: sum(1 for _ in Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).rglob("part-*"))
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words[: 58 - i % 3], f"x{i}"])) for i in range(60)] + [(100, None), (101, "alone")]
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        before = files()
        out = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs_of(rows), wide=4, part_rows=4).collect()}
        assert files() - before < 40
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert out == {i: 0 for i in range(60)} | {100: 100, 101: 101}
