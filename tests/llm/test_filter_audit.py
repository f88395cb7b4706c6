"""The audit against filters that are really applied, one after another."""

from __future__ import annotations

from itertools import permutations

import pytest

from rollcall.llm.filter_audit import Diagram, all_orders, audit_part, failure_counts, filter_audit, neighbour_swaps

LABELS = "doc_id long, quality int, toxic int, part string"


def brute(docs, labels):
    """Rows of (part, order, step, kept, removed, redundant, unique, good, toxic, shapley)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, source in docs:
        text = text or ""
        words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if w]
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs),
        }
        rows.append((i, source or "", {f for f, v in fails.items() if v}))
    out = []
    for part in {p for _, p, _ in rows}:
        mine = [r for r in rows if r[1] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        made = []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[2]]
                left = [r for r in left if f not in r[2]]
                shapley[f] += len(gone)
                made.append((
                    part, "".join(order), step, f, len(left), len(gone), sum(f in r[2] for r in mine) - len(gone), sum(r[2] == {f} for r in mine),
                    sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone),
                ))
        out += [(*m[:3], *m[4:], shapley[m[3]]) for m in made]
    return sorted(out)


def audit(spark, docs_of, docs, labels):
    frame = spark.createDataFrame([(*r, "clash") for r in labels], LABELS)
    return sorted(map(tuple, filter_audit(docs_of(docs), frame).collect()))


def words(n, distinct, start=0):
    return " ".join(f"w{start + k % distinct}" for k in range(n))


def test_like_filters_really_applied(spark, docs_of):
    docs = [
        (1, words(60, 60), "a"), (2, words(60, 60), "b"), (3, words(60, 10), "a"), (4, "# SHORT", "a"), (5, "# SHORT", None), (6, None, "a"), (7, "", ""),
        (8, words(49, 49), "b"), (9, words(50, 32) + "\t", "b"), (10, words(100, 65), "b"), (11, "é" * 19 + "A", "a"), (12, "é" * 18 + "AA", "a"),
        (13, "x y z" * 3, "a"), (None, words(60, 60), "a"), (None, "", "b"), (4, "# SHORT", "a"), (14, "a\x0bb\x0cc\rd\ne", "c"), (3, words(60, 10), "c"),
    ]
    labels = [(1, 1, 0), (3, 1, 1), (3, 0, 0), (4, 0, 1), (6, 1, None), (7, None, 1), (99, 1, 1), (None, 1, 1)]
    got = audit(spark, docs_of, docs, labels)
    assert got == brute(docs, labels)
    assert len(got) == 4 * 600 and {r[0] for r in got} == {"", "a", "b", "c"}


def test_one_text_in_a_third_of_the_rows(spark, docs_of):
    docs = [(i, "same | text" if i % 3 == 0 else words(55, 55, i), "hot" if i % 2 else "s%d" % (i % 5)) for i in range(200)]
    labels = [(i, i % 2, i % 7 == 0) for i in range(0, 200, 3)]
    labels = [(i, q, int(t)) for i, q, t in labels]
    assert audit(spark, docs_of, docs, labels) == brute(docs, labels)


def test_a_text_is_a_few_rows_before_texts_meet(spark, docs_of):
    docs = docs_of([(i, "same", "s") for i in range(300)])
    counts = failure_counts(docs, spark.createDataFrame([], LABELS))
    assert sorted(map(tuple, counts.collect())) == [("s", 1, 1, 0, 0), ("s", 17, 299, 0, 0)]


def test_empty_tables(spark, docs_of):
    assert audit(spark, docs_of, [], []) == []
    assert len(audit(spark, docs_of, [(1, "a", "s")], [])) == 600


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_neighbour_swaps_visit_every_order_once(n):
    order, seen = list("ABCDE"[:n]), ["ABCDE"[:n]]
    for i in neighbour_swaps(n):
        order[i], order[i + 1] = order[i + 1], order[i]
        seen.append("".join(order))
    assert sorted(seen) == sorted(all_orders("ABCDE"[:n])) and len(set(seen)) == len(seen)


def test_equal_parts_of_a_diagram_are_one_node():
    diagram = Diagram("ABCDE", {0: (5, 1, 0)})
    assert len(diagram.nodes) < 2 * 6 + 2  # one chain beside the empty one
    before = diagram.weight[diagram.root].tolist()
    for level in neighbour_swaps(5):
        diagram.swap(level)
    assert diagram.weight[diagram.root].tolist() == before == [5, 1, 0]
    assert len(audit_part("p", {31: (10**18, 0, 0)})) == 600
