"""Scoring texts with a small causal self-attention model over subword ids.

What the corpus gives, from every training row: the count of every word, and from these the
count of every subword id. Subword ids (those of a public tokenizer, per lower-cased word) are
put in classes: the most frequent ids have one of their own, the others share some by shape.
The model predicts the next id's class from the ids before it, by one head of masked
self-attention with a learned bias per distance, in two steps: a group of classes, then the
class in the group; an id's chance within its class is its share of the corpus counts. Together
they are a proper distribution over ids; a word's chance is the product over its ids. The score of
a word, or of the end mark, is log10 of a mix: ``blend`` of its smoothed share of all training
words (only the ``top_words`` have one here) and the rest of the attention's chance. So the score of a
text knows every frequent word and its context, and the chances of all words add up to 1 at most.

Scoring cuts a document's ids into windows of ``2 * HALF`` that overlap by half. A window's
second half is scored, its first half is context, so each id is scored once, with HALF to
2 HALF - 1 ids before it (fewer at the beginning). Windows of many documents run as one batch
with masks for the future, for padding and for what precedes a document.

The attention weights are fitted in numpy on every window of every training row. They begin from
weights fitted on a sample of ``sample_docs`` passages of ``sample_chars`` characters. Then rows are
dealt by a hash of id and text into parts of about ``part_words`` words, sorted by it; each part's task
goes on from these weights over all windows of its rows, and the parts' weights are averaged, each by the
ids it has seen. Parts follow from the rows alone, so scores do not depend on files or machines. Rows that
are equal in id and text are in one part. Every count is over all training rows too. The driver receives the sample, sums of weights from ``SUMS`` tasks,
one row per subword id, and at most ``top_words`` of the most frequent words, which are broadcast;
the counts of all other words stay in a table and are joined to the words of the documents.
Word counts are added up per task before they are shuffled, so a frequent word is a few rows.

Defined results: a null or empty text is the end mark alone; a null id counts as the text ''
when training rows are chosen; repeated rows are scored, and counted, as often as they occur;
without training rows every count is 0 and the model is uniform over the ids; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import LOWER, LOWER_VALUE, gather_spans, held_out, ship_package, steps, word_bounds
from rollcall.llm.pieces import PieceEncoder, SpanCache
from rollcall.session import new_scratch_path

HALF = 8
WIDTH = 16
GROUP = 32  # classes of a group, and groups
SHAPES = 32
HEAD, KNOWN = GROUP * GROUP - SHAPES, 4096
SMOOTH = 0.1
AT_ONCE, BLOCKS = 256, 1024  # windows of the fit, and blocks of the scoring, in one step of arrays
KEPT = 750_000  # words that a worker keeps the ids of
SUMS = 16  # tasks that add up the weights of the others


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").lower().split() if text else []


@lru_cache(maxsize=2)
def cached_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path, added_as_text=True)


def encode_words(path: str, words: list[bytes]) -> list:
    """Ids of each word with a space before it; a special token's name in a word is ordinary text."""
    encode = cached_encoder(path).encode
    return [encode(b" " + w) for w in words]


@lru_cache(maxsize=1)
def kept_cache(path: str, run: str) -> tuple[SpanCache, list]:
    """A word's place among the top words, or -1, then its ids: kept by a Python worker for all tasks of the run.

    The list holds the top words' places, which a task puts there before it looks words up.
    """
    places: list[dict] = []

    def make(words: list[bytes]) -> list:
        words = [w.lower() for w in words]
        return [(places[0].get(w, -1), *ids) for w, ids in zip(words, encode_words(path, words), strict=True)]

    return SpanCache(make, LOWER_VALUE, max_spans=KEPT), places


def word_ids(cache: SpanCache, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts and ends of words, each row's first word, and each word's place among the top words and first id; the ids."""
    starts, ends, first = word_bounds(data, at)
    numbers, sizes = cache.gather(cache.find(data, starts, ends))
    begin = np.cumsum(sizes) - sizes
    ids = np.delete(numbers, begin)
    return starts, ends, first, numbers[begin], np.append(begin - np.arange(len(begin)), len(ids)), ids


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c over all rows of the column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[bytes] = []

        def note(new: list[bytes]) -> list:
            words.extend(w.lower() for w in new)
            return [()] * len(new)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(cache.hits[: cache.n])], names=["word", "c"])

        cache = SpanCache(note, LOWER_VALUE)
        for batch in batches:
            for _, _, data, at in steps(batch.column(0)):
                starts, ends, _ = word_bounds(data, at)
                cache.find(data, starts, ends)
                if cache.n > 400_000:
                    yield rows()
                    words.clear()
                    cache = SpanCache(note, LOWER_VALUE)
        yield rows()

    return docs.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words above some count that are ``most`` at the most, of which no task sends more than its share."""
    step = F.floor(F.log2(F.col("c")) * 8)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()  # a few hundred rows
    total, least = 0, None
    for row in sorted(sizes, key=lambda r: -r["step"]):
        total += row["words"]
        if total > most:
            break
        least = row["step"]
    return counts.where(step >= least) if least is not None else counts.where(F.lit(False))


def id_counts(counts: DataFrame, tokenizer: str) -> np.ndarray:
    """The count of every subword id in the training words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray = np.zeros(cached_encoder(tokenizer).tokenizer.get_vocab_size(), np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 1 << 14):
                part = batch.slice(low, 1 << 14)
                ids = encode_words(tokenizer, part.column(0).to_pylist())
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                np.add.at(total, np.fromiter(chain.from_iterable(ids), np.int64), np.repeat(part.column(1).to_numpy(), sizes))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["id", "c"])

    rows = counts.mapInArrow(run, "id long, c long").groupBy("id").agg(F.sum("c").alias("c")).toPandas()
    total = np.zeros(cached_encoder(tokenizer).tokenizer.get_vocab_size(), np.int64)
    total[rows["id"].to_numpy(np.int64)] = rows["c"].to_numpy(np.int64)
    return total


class Classes:
    """Output classes of ids, an id's share of its class, and which input vector it has."""

    def __init__(self, counts: np.ndarray, names: list[str]):
        by_count = np.lexsort((np.arange(len(counts)), -counts))
        shape = np.array([(n[:1] == "Ġ") * 16 + min(len(n), 8) - 1 + 8 * (not n.isascii() and n[1:].isascii() is False) for n in names]) % SHAPES
        self.out = HEAD + shape
        self.out[by_count[:HEAD]] = np.arange(min(HEAD, len(counts)))
        self.inp = KNOWN + shape
        self.inp[by_count[:KNOWN]] = np.arange(min(KNOWN, len(counts)))
        whole = np.bincount(self.out, weights=counts + SMOOTH, minlength=HEAD + SHAPES)
        self.log_share = np.log((counts + SMOOTH) / whole[self.out]).astype(np.float32)
        self.weight = whole / whole.sum()


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def flat(x: np.ndarray) -> np.ndarray:
    return x.reshape(-1, x.shape[-1])


def pieces_of(x: np.ndarray) -> np.ndarray:
    """Rows of whole windows in pieces, whose products are faster than those of long arrays."""
    return x.reshape(-1, 128 if len(x) % 128 == 0 else 2 * HALF, x.shape[-1])


def side_by_side(p: dict) -> np.ndarray:
    """Of each group: the scores' weights of all groups and those of its own classes, with what is added to them as last row."""
    outer, C = np.vstack([p["G"], p["g"]]), np.vstack([p["C"], p["c"]])
    out = np.empty((GROUP, len(outer), 2 * GROUP), outer.dtype)
    out[:, :, :GROUP], out[:, :, GROUP:] = outer, C.reshape(len(C), GROUP, GROUP).transpose(1, 0, 2)
    return out


def group_scores(h: np.ndarray, goals: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Scores of groups and of the goal's group's classes, a row for each; the goals' places in it, two by two; rows by group.

    ``goals`` are in order of their groups, and the last column of ``h`` is 1.
    """
    group = goals // GROUP
    edges = np.searchsorted(group, np.arange(GROUP + 1))
    here = [(k, slice(edges[k], edges[k + 1])) for k in np.flatnonzero(np.diff(edges)).tolist()]
    scores = np.empty((len(goals), 2 * GROUP), h.dtype)
    for k, at in here:
        np.matmul(h[at], weights[k], out=scores[at])
    at_goal = (np.arange(len(goals)) * (2 * GROUP))[:, None] + np.stack([group, GROUP + goals % GROUP], axis=1)
    return scores.reshape(-1, GROUP), at_goal, here


def sums_of_exp(scores: np.ndarray) -> np.ndarray:
    """The sums over the rows of e to the power of the scores, which that replaces."""
    if scores.size and scores.max() > 60:
        np.minimum(scores, 60, out=scores)
    np.exp(scores, out=scores)
    return scores @ np.ones(GROUP, scores.dtype)


def class_chances(h: np.ndarray, goals: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """``group_scores`` with chances for scores."""
    scores, at_goal, here = group_scores(h, goals, weights)
    scores *= (1 / sums_of_exp(scores))[:, None]
    return scores.reshape(-1, 2 * GROUP), at_goal, here


class Attention:
    """One head of causal self-attention over a window, then a softmax over groups and one over a group's classes."""

    def __init__(self, weight: np.ndarray, seed: int = 1):
        r = np.random.default_rng(seed)
        d = WIDTH
        self.p = {
            "E": r.normal(0, 0.5, (KNOWN + SHAPES, d)), "Wq": r.normal(0, 0.2, (d, d)), "Wk": r.normal(0, 0.2, (d, d)), "Wv": r.normal(0, 0.3, (d, d)),
            "R": np.linspace(0, -2, 2 * HALF), "Wx": r.normal(0, 0.3, (d, d)), "Wo": r.normal(0, 0.3, (d, d)), "b": np.zeros(d),
            "C": r.normal(0, 0.1, (d, GROUP * GROUP)), "c": np.maximum(np.log(weight + 1e-30), -20),
            "G": r.normal(0, 0.1, (d, GROUP)), "g": np.maximum(np.log(weight.reshape(GROUP, GROUP).sum(axis=1) + 1e-30), -20),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def slopes(self, x: np.ndarray, y: np.ndarray, real: np.ndarray | None = None) -> tuple[float, dict]:
        """Mean loss over windows of inputs x and classes y (windows by 2 HALF), and its gradient; only places in ``real`` count.

        Windows are taken ``AT_ONCE`` at a time, since larger arrays leave a core's cache, and the parts' slopes added up.
        """
        if len(x) > AT_ONCE:
            cuts = [slice(low, low + AT_ONCE) for low in range(0, len(x), AT_ONCE)]
            parts = [self.slopes(x[c], y[c], None if real is None else real[c]) for c in cuts]
            sizes = np.array([x[c].size if real is None else np.count_nonzero(real[c]) for c in cuts])
            share = [self.p["E"].dtype.type(s) for s in sizes / max(1, sizes.sum())]
            return float(sum(s * loss for s, (loss, _) in zip(share, parts, strict=True))), {k: sum(s * g[k] for s, (_, g) in zip(share, parts, strict=True)) for k in self.p}
        p, t, w = self.p, x.shape[1], WIDTH
        kind = p["E"].dtype
        lag = np.arange(t)[:, None] - np.arange(t)[None, :]
        bias = np.where(lag >= 0, p["R"][np.abs(lag)], kind.type(-1e9))
        # Queries, keys, values and what passes by the attention, side by side.
        sides = np.concatenate([p["Wq"] * kind.type(w**-0.5), p["Wk"], p["Wv"], p["Wx"]], axis=1)
        X = np.take(p["E"], x.ravel(), axis=0)
        every = flat(pieces_of(X) @ sides)
        Q, K, V = (every[:, i * w : (i + 1) * w].reshape(-1, t, w) for i in range(3))
        A = Q @ K.transpose(0, 2, 1)
        A += bias
        np.exp(np.minimum(A, 60, out=A), out=A)
        A *= (1 / (flat(A) @ np.ones(t, kind))).reshape(-1, t, 1)
        Z = flat(A @ V)
        U = flat(pieces_of(Z) @ p["Wo"])
        U += every[:, 3 * w :]
        U += p["b"]
        np.tanh(U, out=U)
        goals = y.ravel()
        places = np.arange(x.size) if real is None else np.flatnonzero(real)
        places = places[np.argsort((goals[places] // GROUP).astype(np.int8), kind="stable")]  # group by group
        h = np.ones((len(places), w + 1), kind)  # the last column is for what is added to the scores
        U = np.take(U, places, axis=0)
        h[:, :w] = U
        weights = side_by_side(p)
        chances, at_goal, here = class_chances(h, goals[places], weights)
        loss = -float(np.log(np.take(chances, at_goal) + 1e-30).sum())
        share = kind.type(1 / max(1, len(places)))
        chances *= share
        chances.ravel()[at_goal] -= share
        d_weights, dh = np.zeros_like(weights), np.empty((len(places), w), kind)
        for k, at in here:
            np.matmul(h[at].T, chances[at], out=d_weights[k])
            np.matmul(chances[at], weights[k, :w].T, out=dh[at])
        d_outer, d_C = d_weights[:, :, :GROUP].sum(axis=0), d_weights[:, :, GROUP:].transpose(1, 0, 2).reshape(w + 1, -1)
        g = {"C": d_C[:-1], "c": d_C[-1], "G": d_outer[:-1], "g": d_outer[-1]}
        dh *= np.subtract(1, np.multiply(U, U, out=U), out=U)
        dU = np.zeros_like(X)
        dU[places] = dh
        slope = np.empty_like(every)  # of the four sides
        slope[:, 3 * w :] = dU
        g |= {"Wo": Z.T @ dU, "b": np.ones(len(dU), kind) @ dU}
        dZ = dU @ p["Wo"].T
        mean = ((dZ * Z) @ np.ones(w, kind)).reshape(-1, t, 1)  # of an attention's slopes, by its weights
        dZ = dZ.reshape(-1, t, w)
        dS = dZ @ V.transpose(0, 2, 1)
        dS -= mean
        dS *= A
        by_lag = (np.ones(len(dS), kind) @ dS.reshape(len(dS), t * t)).reshape(t, t)
        g["R"] = np.bincount(lag[lag >= 0], weights=by_lag[lag >= 0], minlength=2 * HALF)
        by_side = slope.reshape(-1, t, 4 * w)
        for i, (left, right) in enumerate(((dS, K), (dS.transpose(0, 2, 1), Q), (A.transpose(0, 2, 1), dZ))):
            np.matmul(left, right, out=by_side[:, :, i * w : (i + 1) * w])
        g |= dict(zip(("Wq", "Wk", "Wv", "Wx"), np.split((pieces_of(X).transpose(0, 2, 1) @ pieces_of(slope)).sum(axis=0), 4, axis=1), strict=True))
        g["Wq"] = g["Wq"] * kind.type(w**-0.5)
        dX = slope @ sides.T
        order = np.argsort(x.ravel().astype(np.int16), kind="stable")
        inputs = x.ravel()[order]
        begins = np.flatnonzero(np.diff(inputs, prepend=-1))
        g["E"] = np.zeros_like(p["E"])
        g["E"][inputs[begins]] = np.add.reduceat(np.take(dX, order, axis=0), begins, axis=0)
        return loss * float(share), g

    def adam(self) -> Callable[[dict, float], None]:
        """A function that takes a step against a gradient at a rate."""
        # All weights in one row, so that a step is a few passes over it.
        ends = np.cumsum([0, *(a.size for a in self.p.values())])
        own = {k: slice(low, high) for k, low, high in zip(self.p, ends, ends[1:], strict=False)}
        m, v, slope, far = (np.zeros(ends[-1], np.float32) for _ in range(4))
        step = 0

        def go(g: dict, rate: float) -> None:
            nonlocal step
            step += 1
            for k, at in own.items():
                slope[at] = g[k].ravel()
            for mean, part in ((m, 0.1), (v, 0.01)):
                np.subtract(slope, mean, out=far)
                np.multiply(far, part, out=far)
                np.add(mean, far, out=mean)
                np.multiply(slope, slope, out=slope)
            np.multiply(v, 1 / (1 - 0.99**step), out=far)
            np.sqrt(far, out=far)
            np.add(far, 1e-8, out=far)
            np.divide(m, far, out=far)
            np.multiply(far, rate / (1 - 0.9**step), out=far)
            for k, a in self.p.items():
                a -= far[own[k]].reshape(a.shape)

        return go

    def train(self, x: np.ndarray, y: np.ndarray, rounds: int, batch: int = 256, rate: float = 0.01, seed: int = 2) -> list[float]:
        """Adam over windows in random order; the rate falls to 0 over all rounds."""
        r = np.random.default_rng(seed)
        go, losses, last = self.adam(), [], max(1, rounds * (len(x) // batch))
        for _ in range(rounds):
            order = r.permutation(len(x))
            for low in range(0, len(x) - batch + 1, batch):
                pick = order[low : low + batch]
                loss, g = self.slopes(x[pick], y[pick])
                losses.append(loss)
                go(g, rate * (1 - len(losses) / (last + 1)))
        return losses

    def tables(self) -> dict:
        """Vectors by input, so that scoring looks them up: queries, keys with values, and what passes by the attention."""
        p = self.p
        root = np.float32(WIDTH**-0.5)
        late = np.arange(HALF, 2 * HALF)[:, None] - np.arange(2 * HALF)[None, :]
        bias = np.where(late >= 0, p["R"][np.maximum(late, 0)] - p["R"].max(), np.float32(-1e9)).astype(np.float32)
        E = p["E"]
        context, look = np.concatenate([E @ p["Wk"], E @ p["Wv"] @ p["Wo"]], axis=1), np.concatenate([E @ p["Wq"] * root, E @ p["Wx"] + p["b"]], axis=1)
        return {"context": context.astype(np.float32), "look": look.astype(np.float32), "bias": bias, "weights": side_by_side(p)}


def attend(t: dict, told: np.ndarray, begins: np.ndarray, low: int, high: int) -> np.ndarray:
    """What the model knows before each id of the blocks ``low`` to ``high - 1``.

    A window is a block and the one before it, whose keys and values are context only.
    """
    w, now = WIDTH, told[low * HALF : high * HALF]
    past = told[(low - 1) * HALF : low * HALF] if low else told[:HALF]  # the first block begins a text
    pair = np.take(t["context"], np.concatenate([past, now]), axis=0, mode="clip")
    # Windows overlap, so they are a view of the blocks.
    both = np.lib.stride_tricks.as_strided(pair, (high - low, 2 * HALF, 2 * w), (HALF * pair.strides[0], *pair.strides), writeable=False)
    look = np.take(t["look"], now, axis=0, mode="clip")
    s = look[:, :w].reshape(-1, HALF, w) @ both[:, :, :w].transpose(0, 2, 1)
    s += t["bias"]
    np.exp(np.minimum(s, 60, out=s), out=s)
    s[begins[low:high], :, :HALF] = 0
    z = flat(s @ both[:, :, w:])
    z *= (1 / (flat(s) @ np.ones(2 * HALF, s.dtype)))[:, None]
    z += look[:, w:]
    return np.tanh(z, out=z)


def class_log_probs(t: dict, hidden: np.ndarray, aim: np.ndarray) -> np.ndarray:
    """Natural log of each class's probability: of its group, and within it, group by group."""
    order = np.argsort((aim // GROUP).astype(np.int8), kind="stable")
    h = np.ones((len(aim), WIDTH + 1), np.float32)
    h[:, :WIDTH] = np.take(hidden, order, axis=0)
    scores, at_goal, _ = group_scores(h, aim[order], t["weights"])
    picked = np.take(scores, at_goal)
    picked -= np.log(sums_of_exp(scores)).reshape(-1, 2)
    out = np.empty(len(aim), np.float32)
    out[order] = picked[:, 0] + picked[:, 1]
    return out


def log_probs(t: dict, ids: np.ndarray, edges: np.ndarray, end: int, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Natural log of the probability of every id, and of the end mark after every text of ids."""
    sizes = np.diff(edges) + 1  # with the end mark
    blocks = -(-sizes // HALF)
    first = np.concatenate([[0], np.cumsum(blocks)])
    n = int(first[-1])
    to = gather_spans(first[:-1] * HALF, sizes)
    goal = np.zeros(n * HALF, np.int64)
    goal[to] = np.insert(ids, edges[1:], end)
    told = np.zeros(n * HALF, np.int64)  # the id before each goal; a text begins after an end mark
    told[1:] = goal[:-1]
    told[first[:-1] * HALF] = end
    told, aim = classes.inp[told], classes.out[goal]
    out = classes.log_share[goal].astype(np.float64)
    begins = np.zeros(n, bool)
    begins[first[:-1]] = True
    for low in range(0, n, BLOCKS):
        high = min(n, low + BLOCKS)
        hidden = np.concatenate([attend(t, told, begins, a, min(high, a + 128)) for a in range(low, high, 128)])
        out[low * HALF : high * HALF] += class_log_probs(t, hidden, aim[low * HALF : high * HALF])
    out = out[to]
    ends = edges[1:] + np.arange(len(sizes))
    return np.delete(out, ends), out[ends]


def blended(unigram: np.ndarray, attention: np.ndarray, blend: float) -> np.ndarray:
    """Natural log of ``blend`` of the one chance and the rest of the other, from their logs."""
    out = np.log1p(-blend) + attention
    unigram = np.broadcast_to(unigram, out.shape)
    known = np.flatnonzero(unigram > -300)  # their chances are far from 0, so that the sum has a log
    out[known] = np.log(blend * np.exp(unigram[known]) + np.exp(out[known]))
    rest = np.flatnonzero((unigram <= -300) & (unigram > -np.inf))
    out[rest] = np.logaddexp(np.log(blend) + unigram[rest], out[rest])
    return out


def sample_windows(texts: list[str], tokenizer: str, end: int, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Windows of inputs and classes from the passages; a passage begins after an end mark."""
    inputs, goals = [], []
    for text in texts:
        words = words_of(text)
        flat = [end, *(i for ids in encode_words(tokenizer, words) for i in ids), end]
        for low in range(0, len(flat) - 2 * HALF - 1, 2 * HALF):
            part = np.array(flat[low : low + 2 * HALF + 1])
            inputs.append(classes.inp[part[:-1]])
            goals.append(classes.out[part[1:]])
    if not inputs:
        return np.zeros((0, 2 * HALF), np.int64), np.zeros((0, 2 * HALF), np.int64)
    return np.stack(inputs), np.stack(goals)


def windows_of(ids: np.ndarray, edges: np.ndarray, end: int, classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of inputs and classes of every text of ids, each with the end mark after it, and which places are not padding."""
    sizes = np.diff(edges) + 1
    first = np.concatenate([[0], np.cumsum(-(-sizes // (2 * HALF)))]) * 2 * HALF
    to = gather_spans(first[:-1], sizes)
    goal = np.zeros(int(first[-1]), np.int64)
    goal[to] = np.insert(ids, edges[1:], end)
    told = np.zeros_like(goal)
    told[1:] = goal[:-1]
    told[first[:-1]] = end
    real = np.zeros(len(goal), bool)
    real[to] = True
    return classes.inp[told].reshape(-1, 2 * HALF), classes.out[goal].reshape(-1, 2 * HALF), real.reshape(-1, 2 * HALF)


def fit_on_all(
    texts: DataFrame, tokenizer: str, end: int, classes: Classes, model: Attention, batch: int = 512, rate: float = 0.005, known: Broadcast | None = None, name: str = ""
) -> int:
    """Go on with the fit over every window of the column ``text``, each task by itself, and average; the number of ids seen.

    ``known`` begins with the places of the top words; with the ``name`` of the run, workers keep these and the ids for the scoring.
    """
    start = texts.sparkSession.sparkContext.broadcast((model.p, classes))
    keys, shapes = list(model.p), [a.shape for a in model.p.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, classes_ = start.value
        own = Attention(classes_.weight)
        own.p = {k: a.copy() for k, a in weights.items()}
        go, done, seen = own.adam(), 0, 0

        def learn(parts: list) -> None:
            nonlocal done, seen
            x, y, real = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.random.default_rng(seen).permutation(len(x))
            for low in range(0, len(x), batch):
                pick = order[low : low + batch]
                share = len(pick) / batch  # a batch that is not full steps less far
                go(own.slopes(x[pick], y[pick], real[pick])[1], rate * share / (1 + done / 200) ** 0.5)
                done += 1
            seen += int(real.sum())

        cache, places = kept_cache(tokenizer, name)
        places[:] = [known.value[0] if known else {}]
        parts, held = [], 0
        for rows in batches:
            for _, _, data, at in steps(rows.column(0), 1 << 19):
                _, _, first, _, begin, ids = word_ids(cache, data, at)
                parts.append(windows_of(ids, begin[first], end, classes_))
                held += len(parts[-1][0])
                if held >= 16 * batch:
                    learn(parts)
                    parts, held = [], 0
        if held:
            learn(parts)
        whole = np.concatenate([own.p[k].ravel() for k in keys]).astype(np.float64) * seen
        yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([whole.tobytes()], pa.binary())], names=["n", "sum"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, whole = 0, np.zeros(sum(int(np.prod(s)) for s in shapes))
        for rows in batches:
            for r in rows.to_pylist():
                n += r["n"]
                whole += np.frombuffer(r["sum"])
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([whole.tobytes()], pa.binary())], names=["n", "sum"])

    rows = texts.mapInArrow(run, "n long, sum binary").where("n > 0").repartition(SUMS).mapInArrow(add, "n long, sum binary").collect()
    seen = sum(r["n"] for r in rows)
    if seen:
        whole = np.add.reduce([np.frombuffer(bytes(r["sum"])) for r in rows]) / seen
        at = np.cumsum([0, *(int(np.prod(s)) for s in shapes)])
        model.p = {k: whole[at[i] : at[i + 1]].reshape(shapes[i]).astype(np.float32) for i, k in enumerate(keys)}
    start.unpersist()
    return seen


def score_documents(
    docs: DataFrame, tokenizer: str, end_token: str = "<|endoftext|>", folds: int = 10, top_words: int = 100_000, sample_docs: int = 1000, sample_chars: int = 2000, rounds: int = 3,
    blend: float = 0.35, part_words: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    scratch = new_scratch_path(spark, "language-model")
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col), folds).alias("held_out"), F.col(text_col).alias("text"))
    training = slim.where("not held_out")
    word_counts(training.select("text")).write.parquet(f"{scratch}/counts")
    counts = spark.read.parquet(f"{scratch}/counts")
    ends_ = training.count()  # every row has one end mark
    totals = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n_train, distinct = (totals["n"] or 0) + ends_, totals["v"] + (ends_ > 0)
    rest = float(np.log10(n_train + SMOOTH * (distinct + 1)))

    top = [(bytes(r["word"]), r["c"]) for r in frequent(counts, top_words).collect()]
    known = spark.sparkContext.broadcast(({w: i for i, (w, _) in enumerate(top)}, np.log10(np.array([c for _, c in top] + [ends_]) + SMOOTH)))

    encoder = cached_encoder(tokenizer).tokenizer
    end = encoder.token_to_id(end_token)
    by_id = id_counts(counts, tokenizer)
    by_id[end] += ends_
    classes = Classes(by_id, [encoder.id_to_token(i) or "" for i in range(len(by_id))])
    begin = F.pmod(F.xxhash64("id"), F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1) + 1
    passages = training.where(F.length("text") > 0).select(F.xxhash64("id", "text").alias("h"), F.substr("text", begin.cast("int"), F.lit(sample_chars)).alias("part"))
    model = Attention(classes.weight)
    # About twice the sample by hash, and the smallest hashes of it: what reaches the driver has the sample's size.
    near = passages.where(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * min(1.0, 2 * sample_docs / max(ends_, 1))))
    x, y = sample_windows([r["part"] for r in near.orderBy("h", "part").limit(sample_docs).collect()], tokenizer, end, classes)
    model.train(x, y, rounds)
    parts = max(1, round(n_train / part_words))
    hashed = training.select("text", F.xxhash64("id", "text").alias("h")).repartition(parts, "h").sortWithinPartitions("h", "text")
    fit_on_all(hashed.select("text"), tokenizer, end, classes, model, known=known, name=scratch)
    fitted = spark.sparkContext.broadcast((model.tables(), classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (places, logs), (tables, classes_) = known.value, fitted.value

        cache, kept = kept_cache(tokenizer, scratch)
        kept[:] = [places]
        for batch in batches:
            for low, high, data, at in steps(batch.column(3), 1 << 19):
                starts, ends, first, place, begin, ids = word_ids(cache, data, at)
                by_id, at_end = log_probs(tables, ids, begin[first], end, classes_)
                by_word = np.add.reduceat(np.append(by_id, 0), begin[:-1]) if len(place) else by_id
                share = np.where(place >= 0, (logs[place] - rest) * np.log(10), -np.inf)
                by_word = np.concatenate([[0], np.cumsum(blended(share, by_word, blend))])
                score = np.diff(by_word[first]) + blended((logs[-1] - rest) * np.log(10), at_end, blend)
                value = np.concatenate([[0], np.cumsum(np.where(place >= 0, logs[place], 0))])
                seen = np.concatenate([[0], np.cumsum(place >= 0)])
                rare = np.flatnonzero(place < 0)
                lengths = (ends - starts)[rare]
                whole = LOWER[data[gather_spans(starts[rare], lengths)]]
                words = pa.Array.from_buffers(pa.binary(), len(rare), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.py_buffer(whole)])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(low, high - low) for i in range(3)), pa.array(np.diff(first) + 1), pa.array(np.diff(seen[first]) + (ends_ > 0)), pa.array(np.diff(value[first]) + logs[-1]), pa.array(score / np.log(10)),
                        pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, first), pa.int32()), words),
                    ],
                    names=["row", "id", "held_out", "n_tokens", "n_known", "base", "score", "rare"],
                )

    numbered = slim.select(F.monotonically_increasing_id().alias("row"), "id", "held_out", "text")
    scored = numbered.mapInArrow(run, f"row long, id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<binary>")
    scored.write.parquet(f"{scratch}/scored")
    scored = spark.read.parquet(f"{scratch}/scored")
    words = scored.select("row", F.explode("rare").alias("w")).groupBy("row", "w").agg(F.count("*").alias("times"))
    found = words.join(counts, F.col("w") == F.col("word"), "left").groupBy(F.col("row").alias("r")).agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)).alias("rare_base"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known")
    )
    out = scored.drop("rare").join(found, F.col("row") == F.col("r"), "left")
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(int(n_train)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(rest)).alias("base_score"), "score",
    )
