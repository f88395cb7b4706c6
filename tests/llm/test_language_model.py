"""The language model: counts against plain ones, batches against single steps, slopes against differences."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from rollcall.llm import language_model as L
from rollcall.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain(rows, folds=10):
    fold = [zlib.crc32(("" if i is None else str(i)).encode()) % folds == 0 for i, _ in rows]
    words = [(t or "").encode().lower().split() for _, t in rows]
    counts, ends = Counter(), 0
    for w, h in zip(words, fold, strict=True):
        if not h:
            counts.update(w)
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    log = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    return sorted(
        ((i, h, len(w) + 1, sum(x in counts for x in w) + (ends > 0), n, round(sum(log(counts[x]) for x in w) + log(ends), 5)) for (i, _), w, h in zip(rows, words, fold, strict=True)),
        key=repr,
    )


def shown(df):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in df.collect()), key=repr)


ROWS = [(i, "The cat sat on the mat. " * (i % 3) + f"word{i} Ünï rare{i % 7}") for i in range(40)] + [(90, None), (91, ""), (92, "\t\n "), (None, "no id"), (5, "repeat"), (5, "repeat"), (93, "<|endoftext|> x" * 30), (94, "y" * 30_000)]


@pytest.mark.parametrize("top_words", [3, 100_000])
def test_counts(docs_of, top_words):
    assert shown(L.score_documents(docs_of(ROWS), PATH, top_words=top_words, rounds=1)) == plain(ROWS)


def test_on_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = L.score_documents(docs, PATH)
    assert shown(got) == plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    # The model's own measure: held-out text costs less than under equally likely ids.
    rows = [r for r in got.collect() if r["held_out"]]
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert sum(r["score"] for r in rows) > -math.log10(50257) * sum(r["n_tokens"] for r in rows) * 1.5


def test_without_training_rows(docs_of):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, "some text") for i in held]
    got = L.score_documents(docs_of(rows), PATH).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in got} == {(0, 0)} and all(np.isfinite(r["base_score"]) and np.isfinite(r["score"]) for r in got)


def test_empty(docs_of):
    assert L.score_documents(docs_of([], 1), PATH).count() == 0


@pytest.fixture(scope="module")
def small():
    r = np.random.default_rng(7)
    counts = r.integers(0, 50, 3000) * (r.random(3000) < 0.5)
    classes = L.Classes(counts, [("Ġ" if i % 3 else "") + "é" * (i % 2) + "x" * (i % 9) for i in range(3000)])
    model = L.Attention(classes.weight)
    model.p = {k: v + r.normal(0, 0.2, v.shape).astype(np.float32) for k, v in model.p.items()}
    return classes, model


def one_by_one(model, classes, ids, end):
    """Every id's log probability from the definition, one window after another, and the distribution's sum."""
    p = {k: v.astype(np.float64) for k, v in model.p.items()}
    told, goals, total = [end, *ids], [*ids, end], 0.0
    for i, goal in enumerate(goals):
        begin = max(0, (i // L.HALF - 1) * L.HALF)
        X = p["E"][classes.inp[told[begin : i + 1]]]
        s = X[-1] @ p["Wq"] @ (X @ p["Wk"]).T / np.sqrt(L.WIDTH) + p["R"][np.arange(len(X))[::-1]]
        a = np.exp(s - s.max())
        h = np.tanh(X[-1] @ p["Wx"] + (a / a.sum()) @ (X @ p["Wv"]) @ p["Wo"] + p["b"])
        over, within = np.exp(h @ p["G"] + p["g"]), np.exp(h @ p["C"] + p["c"]).reshape(L.GROUP, L.GROUP)
        chance = (over / over.sum())[:, None] * within / within.sum(axis=1, keepdims=True)
        every = chance.ravel()[classes.out] * np.exp(classes.log_share)
        assert np.isclose(every.sum(), 1, atol=1e-4)  # a distribution over ids
        total += np.log(every[goal])
    return total


def whole_texts(model, texts, classes, end=2999):
    """Log probability of every text: of its ids and its end mark."""
    edges = np.cumsum([0, *map(len, texts)])
    by_id, at_end = L.log_probs(model.tables(), np.concatenate(texts), edges, end, classes)
    assert len(by_id) == edges[-1] and len(at_end) == len(texts)
    return [by_id[a:b].sum() + e for a, b, e in zip(edges, edges[1:], at_end, strict=False)]


def test_batches_score_like_single_windows(small):
    classes, model = small
    r = np.random.default_rng(3)
    texts = [r.integers(0, 2999, n) for n in (0, 1, 7, 8, 9, 15, 16, 17, 40, 3, 100)]
    got = whole_texts(model, texts, classes)
    want = [one_by_one(model, classes, t.tolist(), 2999) for t in texts]
    assert np.allclose(got, want, rtol=1e-4)


def test_many_blocks(small):
    classes, model = small
    ids = np.random.default_rng(4).integers(0, 2999, 5000)
    both = whole_texts(model, [ids, ids[:700]], classes)
    alone = [whole_texts(model, [x], classes)[0] for x in (ids, ids[:700])]
    assert np.allclose(both, alone, rtol=1e-6)


def test_slopes(small):
    classes, model = small
    r = np.random.default_rng(5)
    x, y = r.integers(0, 1000, (3, 2 * L.HALF)), r.integers(0, 256, (3, 2 * L.HALF))
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    _, g = model.slopes(x, y)
    for name, value in model.p.items():
        at = tuple(r.integers(0, s) for s in value.shape)
        if name == "E":
            at = (x[1, 3], at[1])
        kept, out = value[at], []
        for shift in (1e-5, -1e-5):
            value[at] = kept + shift
            out.append(model.slopes(x, y)[0])
        value[at] = kept
        assert np.isclose((out[0] - out[1]) / 2e-5, g[name][at], rtol=1e-3, atol=1e-6), name


def test_training_lowers_the_loss():
    classes = L.Classes(np.ones(2000, np.int64), ["x"] * 2000)
    model = L.Attention(classes.weight)
    x = np.tile(np.arange(2 * L.HALF), (512, 1)) + np.random.default_rng(0).integers(0, 20, (512, 1))
    losses = model.train(x, (x * 7 + 3) % 256, rounds=20, batch=64, rate=0.02)
    assert np.mean(losses[-5:]) < 0.3 * np.mean(losses[:5])


def test_every_window_of_every_row_is_learned_from(docs_of):
    rows = [(i, f"shared words number{i} " * (i % 9)) for i in range(60)] + [(90, None), (91, ""), (92, "x")]
    end = L.cached_encoder(PATH).tokenizer.token_to_id("<|endoftext|>")
    vocab = L.cached_encoder(PATH).tokenizer.get_vocab_size()
    classes = L.Classes(np.ones(vocab, np.int64), ["x"] * vocab)
    goals = lambda some: sum(1 + sum(map(len, L.encode_words(PATH, L.words_of(t)))) for _, t in some)
    for some in (rows, rows[:20]):
        model = L.Attention(classes.weight)
        before = {k: a.copy() for k, a in model.p.items()}
        assert L.fit_on_all(docs_of(some).select("text"), PATH, end, classes, model) == goals(some)
        assert all(np.isfinite(a).all() and a.shape == before[k].shape for k, a in model.p.items())
        told = {int(classes.inp[i]) for _, t in some for ids in L.encode_words(PATH, L.words_of(t)) for i in ids}
        moved = set(np.flatnonzero((np.abs(model.p["E"] - before["E"]) > 1e-6).any(axis=1)).tolist())
        assert told <= moved  # every input that a row has, also a short one


def test_padding_has_no_slope(small):
    classes, model = small
    ids = np.random.default_rng(6).integers(0, 2999, 21)
    x, y, real = L.windows_of(ids, np.array([0, 0, 21]), 2999, classes)
    assert real.sum() == 23 and len(x) == 3
    loss, g = model.slopes(x, y, real)
    x[~real], y[~real] = 5, 7
    again, h = model.slopes(x, y, real)
    assert np.isclose(loss, again) and all(np.allclose(g[k], h[k], atol=1e-6) for k in g)


def test_context_reaches_more_ids(docs_of):
    """An id beyond the 224 most frequent is foreseen from the id before it."""
    r = np.random.default_rng(8)
    counts = np.concatenate([np.full(400, 100), np.ones(600, np.int64)])
    classes = L.Classes(counts, ["x"] * 1000)
    assert len(set(classes.out[:400].tolist())) == 400
    model = L.Attention(classes.weight)
    told = r.integers(300, 400, (2000, 2 * L.HALF))
    losses = model.train(classes.inp[told], classes.out[told - 50], rounds=30, batch=100, rate=0.03)
    assert np.mean(losses[-5:]) < 0.5 * np.mean(losses[:5])


def test_scores_do_not_depend_on_the_layout(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    runs = [{r["doc_id"]: r for r in L.score_documents(docs.repartition(n), PATH, part_words=180_000).collect()} for n in (2, 8)]
    assert all(abs(a["score"] - runs[1][i]["score"]) <= 1e-6 * a["n_tokens"] for i, a in runs[0].items())


def test_held_out_rows_score_above_the_counts(spark):
    """With the default parameters; with many small parts the averaged weights fall behind."""
    held = L.score_documents(table(spark, "/root/testdata/sf0.01", "documents"), PATH).where("held_out").collect()
    assert sum(r["n_tokens"] for r in held) > 10_000 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_the_blend_is_of_chances():
    one, two = np.log([0.2, 0.0001, 0.5]), np.log([0.1, 0.3, 0.5])
    assert np.allclose(np.exp(L.blended(one, two, 0.25)), 0.25 * np.exp(one) + 0.75 * np.exp(two))
    assert np.isclose(L.blended(np.array([-np.inf]), np.log([0.3]), 0.5)[0], np.log(0.15))


def test_slopes_of_parts_add_up(small, monkeypatch):
    """A batch taken a few windows at a time, its last part short or all padding, gives the slopes of the whole."""
    classes, model = small
    r = np.random.default_rng(9)
    x, y = r.integers(0, 1000, (11, 2 * L.HALF)), r.integers(0, 256, (11, 2 * L.HALF))
    real = r.random(x.shape) < 0.8
    real[8:] = False
    for some in (None, real, np.zeros_like(real)):
        loss, g = model.slopes(x, y, some)
        with monkeypatch.context() as m:
            m.setattr(L, "AT_ONCE", 4)
            again, h = model.slopes(x, y, some)
        assert np.isclose(loss, again, rtol=1e-5) and all(np.allclose(g[k], h[k], rtol=1e-4, atol=1e-6) for k in g)


def test_blend_of_chances_near_nothing():
    one, two = np.array([-1000.0, -1000.0, -5.0, -np.inf, -400.0]), np.array([-900.0, -2000.0, -2000.0, -900.0, -1.0])
    want = np.logaddexp(np.log(0.35) + one, np.log(0.65) + two)
    assert np.allclose(L.blended(one, two, 0.35), want, rtol=1e-12)
    assert np.allclose(L.blended(-2.0, two, 0.35), np.logaddexp(np.log(0.35) - 2, np.log(0.65) + two), rtol=1e-12)


def test_a_worker_encodes_a_word_once_in_a_run(monkeypatch):
    """Also in a later task, and in the scoring after the fit; another run begins anew."""
    made, encode = [], L.encode_words
    monkeypatch.setattr(L, "encode_words", lambda path, words: made.extend(words) or encode(path, words))

    def task(run, texts, known):
        cache, places = L.kept_cache(PATH, run)
        places[:] = [known]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        _, _, first, place, begin, ids = L.word_ids(cache, data, np.cumsum([0, *map(len, texts)]))
        return place.tolist(), [ids[a:b].tolist() for a, b in zip(begin[first], begin[first[1:]], strict=False)]

    whole = lambda text: [i for ids in encode(PATH, L.words_of(text)) for i in ids]
    texts, more = ["The cat's", "", "CAT'S the unheardofword "], ["a the cat's"]
    assert task("one", texts, {b"the": 5}) == ([5, -1, -1, 5, -1], [whole(t) for t in texts])
    assert task("one", more, {b"the": 5}) == ([-1, 5, -1], [whole(t) for t in more])
    assert sorted(made) == [b"a", b"cat's", b"the", b"unheardofword"]
    assert task("two", more, {b"a": 0}) == ([0, -1, -1], [whole(t) for t in more])
    assert len(made) == 7
    L.kept_cache.cache_clear()
