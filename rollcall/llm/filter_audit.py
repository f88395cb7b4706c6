"""How filters interact: what each one removes in every order they could be applied in.

A document's failures are a mask of one bit per filter. Documents are counted by (part, mask), so
a part is a few rows however many documents it has. Each part's counts become a decision diagram:
a level per filter, at each node a branch for passing and one for failing, and at the bottom the
counts of a mask. Every node carries the counts of what reaches the bottom through it, and equal
sub-diagrams are one node. Exchanging two neighbouring levels is a local step, and such steps
lead through all orders, each once. In any order the path that passes every filter gives the
result of every step: the weight of the node is what was kept so far, and the weight of its
failing branch is what the next filter removes.

Defined results: a null text is empty; a null part is the empty string. A document without id has
no label, is no copy of any other and none is a copy of it; rows that share id and text are no
copies of each other. Of labels that repeat an id, any 1 counts. Extra columns are not read. An
empty table has no parts and gives no rows.

Texts are compared by their SHA-256. Copies are counted by (text, part, label) in the tasks before
they meet, so a text that a third of all rows share is a few rows per task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ship_package

FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
COPY = "E"
STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)
#: What a leaf counts: documents, good ones, toxic ones.
WEIGHTS = ("n", "good", "toxic")


def text_failures(text: Column, words: Column, min_words: int = 50, distinct_pct: int = 65, capital_pct: int = 5, marks: str = "[#$%&*|]") -> dict[str, Column]:
    """Failure conditions of the filters that read the text and its words alone, by letter."""
    n_words, n_distinct, n_chars = (c.cast("long") for c in (F.size(words), F.size(F.array_distinct(words)), F.length(text)))
    capitals = n_chars - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n_words < min_words,
        "B": n_distinct * 100 < n_words * distinct_pct,
        "C": capitals * 100 > n_chars * capital_pct,
        "D": text.rlike(marks),
    }


def bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents by part and failure mask."""
    text = F.coalesce(F.col("text"), F.lit(""))
    failures = text_failures(F.col("t"), F.col("words"))
    mask = sum((F.when(c, F.lit(bit(f))).otherwise(F.lit(0)) for f, c in failures.items()), F.lit(0))
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce("source", F.lit("")).alias("part"), text.alias("t"))
    rows = rows.withColumn("words", F.regexp_extract_all("t", F.lit(WORD), 0))
    rows = rows.select("id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("t"), 256)).alias("text_hash"))
    # Repeated rows shrink in the tasks; after this step a row is one (id, part, text).
    rows = rows.groupBy("id", "part", "mask", "text_hash").agg(F.count("*").alias("n"))
    marked = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("of_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = rows.where(F.col("id").isNotNull()).join(marked, F.col("id") == F.col("of_id"), "left").drop("of_id")
    nameless = rows.where(F.col("id").isNull()).withColumns({"good": F.lit(None).cast("int"), "toxic": F.lit(None).cast("int")})
    rows = known.unionByName(nameless).withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    # Of every text: the smallest id, and how many rows of each (part, label) have it or have none.
    group = ["text_hash", "part", "mask", "good", "toxic"]
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n")))
    nameless = F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0))
    # Rows of one (text, part, label) and id are one already, so the struct's n counts them all.
    grouped = rows.groupBy(*group).agg(F.sum("n").alias("n"), least.alias("least"), nameless.alias("nameless"))
    firsts = grouped.groupBy(F.col("text_hash").alias("of_text")).agg(F.min("least.id").alias("first_id"))
    joined = grouped.join(firsts, F.col("text_hash") == F.col("of_text"))
    first = F.when(F.col("least.id") == F.col("first_id"), F.col("least.n")).otherwise(0) + F.col("nameless")
    halves = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), first.alias("n")),
        F.struct((F.col("mask") + bit(COPY)).alias("mask"), (F.col("n") - first).alias("n")),
    ))
    cells = joined.select("part", "good", "toxic", halves.alias("half")).select("part", "half.mask", "half.n", "good", "toxic")
    return cells.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


class Diagram:
    """A count-weighted decision diagram over failure masks.

    A node is (level, passing child, failing child); a leaf is (depth, counts). Equal nodes are one.
    """

    def __init__(self, letters: str, counts: dict[int, tuple[int, ...]]):
        self.order = list(letters)
        self.depth = len(letters)
        self.nodes: list[tuple] = []
        self.weight: list[np.ndarray] = []
        self.known: dict[tuple, int] = {}
        zero = (0,) * len(WEIGHTS)
        level = [self.node(self.depth, counts.get(mask, zero), None) for mask in range(1 << self.depth)]
        # Masks in numeric order have the last filter's bit highest: halve from the last filter up.
        for k in reversed(range(self.depth)):
            level = self.pair_up(level, k)
        self.root = level[0]

    def pair_up(self, below: list[int], k: int) -> list[int]:
        half = len(below) // 2
        return [self.node(k, below[i], below[i + half]) for i in range(half)]

    def node(self, level: int, passing, failing) -> int:
        key = (level, passing, failing)
        at = self.known.get(key)
        if at is None:
            at = self.known[key] = len(self.nodes)
            self.nodes.append(key)
            self.weight.append(np.array(passing, dtype=object) if failing is None else self.weight[passing] + self.weight[failing])
        return at

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the one below: the inner two of four grandchildren change places."""
        renewed: dict[int, int] = {}

        def at(i: int) -> int:
            if i not in renewed:
                here, passing, failing = self.nodes[i]
                if here < level:
                    renewed[i] = self.node(here, at(passing), at(failing))
                else:
                    (_, pp, pf), (_, fp, ff) = self.nodes[passing], self.nodes[failing]
                    renewed[i] = self.node(level, self.node(level + 1, pp, fp), self.node(level + 1, pf, ff))
            return renewed[i]

        self.root = at(self.root)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """Along the path that passes everything: filter, weight kept after it, weight removed by it."""
        at = self.root
        for letter in self.order:
            _, at, failing = self.nodes[at]
            yield letter, self.weight[at], self.weight[failing]


def neighbour_swaps(n: int) -> Iterator[int]:
    """Places i so that exchanging i and i + 1, one after another, visits all n! orders once."""
    if n < 2:
        return
    inner = neighbour_swaps(n - 1)
    down = True
    while True:
        # The last element travels through the others, which then take one step of their own.
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + 1 if down else step
        down = not down


def audit_part(part: str, counts: dict[int, tuple[int, ...]], letters: str = FILTERS) -> list[tuple]:
    """All orders and steps of one part."""
    diagram = Diagram(letters, counts)
    failing = {f: sum(c[0] for mask, c in counts.items() if mask >> i & 1) for i, f in enumerate(letters)}
    alone = {f: counts.get(1 << i, (0,))[0] for i, f in enumerate(letters)}
    rows, removals = [], dict.fromkeys(letters, 0)

    def record() -> None:
        order = "".join(diagram.order)
        for step, (f, kept, removed) in enumerate(diagram.steps(), 1):
            removals[f] += int(removed[0])
            rows.append((part, order, step, f, int(kept[0]), int(removed[0]), failing[f] - int(removed[0]), alone[f], int(removed[1]), int(removed[2])))

    record()
    for level in neighbour_swaps(len(letters)):
        diagram.swap(level)
        record()
    return [(*r[:3], *r[4:], removals[r[3]]) for r in rows]


def audit_orders(counts: DataFrame) -> DataFrame:
    """One row per part, order and step, from at most one row per part and mask."""
    names = [c.split()[0] for c in STEPS.split(", ")]

    def run(cells: pd.DataFrame) -> pd.DataFrame:
        rows = [(int(m), (int(n), int(g), int(t))) for m, n, g, t in zip(cells["mask"], cells["n"], cells["good"], cells["toxic"], strict=True)]
        return pd.DataFrame(audit_part(cells["part"].iloc[0], dict(rows)), columns=names)

    return counts.groupBy("part").applyInPandas(run, STEPS)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every part, order of the five filters and step, with what was kept, removed and lost."""
    ship_package(docs.sparkSession)
    return audit_orders(failure_counts(docs, labels))


def all_orders(letters: str = FILTERS) -> list[str]:
    return ["".join(p) for p in permutations(letters)]
