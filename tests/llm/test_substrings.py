"""Removal of repeated runs against a plain version."""

from __future__ import annotations

import random
import re

import pytest

from rollcall.llm.substrings import remove_repeated_runs


def parts(text):
    """(start, end, words) of the sentences of a text; a sentence's bytes go up to the next one's first word."""
    raw = text.encode()
    cuts = {0} | {m.end() for m in re.finditer(rb"[.!?,;:](?=[\t-\r ]|$)|\n", raw)}
    words = [(m.start(), m.group().lower()) for m in re.finditer(rb"[^\t-\r ]+", raw)]
    out = []
    for k, (at, w) in enumerate(words):
        if k == 0 or any(words[k - 1][0] < c <= at for c in cuts if c):
            out.append([at, 0, []])
        out[-1][2].append(w)
    for s, following in zip(out, [*out[1:], None], strict=False):
        s[1] = following[0] if following else len(raw)
    return out


def runs_of(sentences, run, min_words):
    for i in range(len(sentences)):
        e, words = i, []
        while e < len(sentences) and (e - i < run or len(words) < min_words):
            words += sentences[e][2]
            e += 1
        if e - i >= run and len(words) >= min_words:
            yield i, e, tuple(words)


def brute(rows, run, min_words):
    first = {}
    for i, t in rows:
        if i is not None:
            for _, _, words in runs_of(parts(t or ""), run, min_words):
                first[words] = min(first.get(words, i), i)
    out = []
    for i, t in rows:
        sentences, gone, seen = parts(t or ""), set(), set()
        for a, e, words in runs_of(sentences, run, min_words):
            if i is not None and (first[words] < i or words in seen):
                gone |= set(range(a, e))
            seen.add(words)
        raw = (t or "").encode()
        kept = bytes(b for k, b in enumerate(raw) if not any(sentences[s][0] <= k < sentences[s][1] for s in gone)).decode()
        out.append((i, len(sentences), len(gone), t if not gone else kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("run", "min_words"), [(2, 16), (3, 4), (1, 1)])
def test_like_plain_version(docs_of, run, min_words):
    r = random.Random(run)
    sentence = lambda: " ".join(f"w{r.randrange(40)}" for _ in range(r.randrange(1, 9))).capitalize() + r.choice([".", "!", ",", ".\n", "\n\n", "?  "])
    shared = [" ".join(sentence() for _ in range(8)) for _ in range(4)]
    rows = []
    for i in range(60):
        text = " ".join(sentence() for _ in range(r.randrange(6)))
        if r.random() < 0.6:
            text += " " + r.choice(shared).upper() + " " + r.choice(["", sentence(), r.choice(shared)])
        rows.append((r.randrange(50), text))
    rows += [(1, None), (2, ""), (3, "..."), (4, "\n\n"), (None, shared[0]), (None, None), (60, shared[1]), (60, shared[1]), (61, "é. " + shared[2] + " ü")]
    got = remove_repeated_runs(docs_of(rows), run=run, min_words=min_words)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, run, min_words)


def test_empty(docs_of):
    assert remove_repeated_runs(docs_of([], 1)).count() == 0


def test_a_passage_in_most_documents_stays_once(docs_of):
    passage = "It is a long passage that has many words in it, and many documents hold it. Nobody knows why that is so."
    rows = [(i, f"Opening of number{i} begins. {passage} Closing{i}.") for i in range(300)]
    got = remove_repeated_runs(docs_of(rows, 7)).collect()
    assert [r["doc_id"] for r in got if passage in r["text"]] == [0]
    assert all(f"number{r['doc_id']}" in r["text"] and f"Closing{r['doc_id']}" in r["text"] for r in got)


def test_a_copy_of_one_long_clause_goes(docs_of):
    r = random.Random(11)
    clause = " ".join(f"w{r.randrange(500)}" for _ in range(120))
    got = remove_repeated_runs(docs_of([(1, clause), (2, clause.upper()), (3, " ".join(["same"] * 40)), (4, " ".join(["same"] * 40))])).collect()
    assert {r["doc_id"]: r["text"] for r in got if r["doc_id"] in (1, 2)} == {1: clause, 2: ""}
    assert {r["doc_id"]: r["text"] for r in got}[4] == ""


def test_a_text_of_fewer_sentences_than_a_run(docs_of):
    text = "Only two sentences are here. No third one follows."
    got = remove_repeated_runs(docs_of([(1, text), (2, text), (3, "Too short."), (4, "Too short.")]), run=3, min_words=5).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {1: text, 2: "", 3: "Too short.", 4: "Too short."}


@pytest.mark.parametrize("ends", ["", ",", ",......"])
def test_every_passage_of_over_fifty_words_holds_a_run(docs_of, ends):
    """Clauses of any length; the passage begins and ends anywhere in them."""
    r = random.Random(len(ends))
    step = {"": 10**9, ",": 30, ",......": 9}[ends]
    word = lambda: f"w{r.randrange(3000)}" + ("," if r.randrange(step) == 0 else "")
    other = lambda: " ".join(word() for _ in range(r.randrange(40)))
    rows = []
    for i in range(300):
        passage = " ".join(word() for _ in range(51))
        rows += [(2 * i, f"{other()} {passage} {other()}"), (2 * i + 1, f"{other()} {passage} {other()}")]
    got = {r["doc_id"]: r["n_removed"] for r in remove_repeated_runs(docs_of(rows)).collect()}
    assert all(got[2 * i + 1] >= 2 for i in range(300))
