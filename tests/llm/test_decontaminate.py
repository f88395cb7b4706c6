"""Decontamination: the index against all scores, leaks against plain overlap."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from rollcall.llm.decontaminate import Index, drop_leaks, find_leaks

R = random.Random(4)
WORDS = [f"w{i}" for i in range(400)]
ITEMS = [(i, ". ".join(" ".join(R.choices(WORDS, k=R.randrange(4, 40))) for _ in range(R.randrange(1, 4))) + ".") for i in range(150)]


def words(text):
    return re.findall(r"[a-z0-9\x80-￿]+", text.lower())


def grams(w, n):
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def shares(text, item, n=5):
    pieces = [p for p in re.split(r"[.!?\n]", item) if words(p)]
    question = words(" ".join(pieces[:-1])) or words(item)
    answer = words(pieces[-1])
    return [len(grams(p, min(n, len(p))) & grams(words(text), min(n, len(p)))) / len(grams(p, min(n, len(p)))) for p in (question, answer)]


def documents():
    r = random.Random(9)
    rows = []
    for i in range(120):
        text = " ".join(r.choices(WORDS, k=r.randrange(0, 200)))
        if i % 4 == 0:
            item = r.choice(ITEMS)[1]
            text += " " + (item.upper().replace(".", " !") if i % 8 else item) + " " + " ".join(r.choices(WORDS, k=r.randrange(80)))
        if i % 9 == 0:  # the question without the answer
            text += " " + ITEMS[i][1].split(".")[0]
        rows.append((i, text))
    return [*rows, (None, "lead " + ITEMS[3][1]), (500, None), (501, ""), (502, "..."), (7, ITEMS[8][1]), (7, ITEMS[8][1])]


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(i, t, 1) for i, t in [*ITEMS, (900, None), (901, ""), (None, "?!"), (150, ITEMS[8][1])]], "item_id long, text string, doc_id int")


@pytest.mark.parametrize("shard_bytes", [1 << 22, 3000])
def test_leaks(docs_of, items, shard_bytes):
    rows = documents()
    got = [(r["doc_id"], r["item_id"]) for r in find_leaks(docs_of(rows), items, shard_bytes=shard_bytes).collect()]
    want = [(d, i) for d, t in rows for i, item in [*ITEMS, (150, ITEMS[8][1])] if min(shares(t or "", item)) >= 0.5]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = drop_leaks(docs_of(rows), items, shard_bytes=shard_bytes)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = [(d, t) for d, t in rows if not any(min(shares(t or "", item)) >= 0.5 for _, item in ITEMS)]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_empty_sides(docs_of, items):
    assert find_leaks(docs_of([], 1), items).count() == 0
    assert find_leaks(docs_of(documents()), items.where("item_id < 0")).count() == 0
    assert drop_leaks(docs_of(documents()), items.where("item_id < 0")).count() == len(documents())


@pytest.mark.parametrize("reach", [0.2, 0.6])
def test_search_finds_all_units_above_their_threshold(reach):
    index = Index(ITEMS, 32, 5, reach)
    n = len(index.need)
    dense = np.zeros((len(index.words), n))
    term = np.repeat(index.keys // index.n_blocks, np.diff(index.begin))
    dense[term, index.unit] = index.impact
    r = np.random.default_rng(1)
    passages = [np.unique(r.integers(0, len(index.words), 60)) for _ in range(80)]
    passages += [np.flatnonzero(dense[:, u]) for u in range(0, n, 3)]
    passage = np.repeat(np.arange(len(passages)), [len(p) for p in passages])
    got = set(zip(*map(np.ndarray.tolist, index.search(passage, np.concatenate(passages))), strict=True))
    want = set()
    for k, p in enumerate(passages):
        for u in np.flatnonzero(dense[p].sum(axis=0) >= index.need):
            want.add((k, int(index.item[u])))
    assert got == want and len(want) >= n // 3


def test_pieces_of_an_item_that_count_are_found(docs_of, items):
    """Stretches of 40 to 100 % of items of one to five units, in one piece between other words."""
    r = random.Random(11)
    rows = []
    for k in range(600):
        item = words(ITEMS[k % len(ITEMS)][1])
        size = max(1, round(len(item) * r.uniform(0.4, 1)))
        begin = r.randrange(len(item) - size + 1)
        other = [" ".join(f"x{r.randrange(5000)}" for _ in range(r.randrange(90))) for _ in range(2)]
        rows.append((k, " ".join([other[0], *item[begin : begin + size], other[1]])))
    want = sorted((d, i) for d, t in rows for i, item in [*ITEMS, (150, ITEMS[8][1])] if min(shares(t, item)) >= 0.5)
    got = sorted((x["doc_id"], x["item_id"]) for x in find_leaks(docs_of(rows), items).collect())
    assert got == want and len(want) > 200


def test_one_sentence_of_32_words_half_present(spark, docs_of):
    item = [f"v{i}" for i in range(32)]
    other = spark.createDataFrame([(i, " ".join([*item[:16], *[f"z{i}.{k}" for k in range(16)]])) for i in range(1, 40)] + [(0, " ".join(item))], "item_id long, text string")
    rows = [(k, "lead words " + " ".join(item[a : a + 18]) + " and more") for k, a in enumerate(range(15))]
    found = {(x["doc_id"], x["item_id"]) for x in find_leaks(docs_of(rows), other).collect()}
    assert {(k, 0) for k in range(15)} <= found
