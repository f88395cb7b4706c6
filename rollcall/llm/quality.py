"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's features are computed from its text and those of
the line before and after it; a transition weight ties neighbouring labels. The model is
fitted to labelled documents whose lines carry the document's label, on a sample bounded by
``sample_docs`` documents and ``sample_lines`` lines of each (one run of lines, chosen by a
hash; a document in the sample is one of the smallest hashes of ids). Scoring covers every line of every document: forward and
backward sums give each line's probability to be good, and their mean weighted by the lines'
lengths is the document's score.

Inputs of a score are the text alone. Nothing is shuffled but the labels' ids; fitting
works on bounded data on the driver.

Defined results: a null or empty text is one empty line; a null id is never in the sample and
counts as the text '' when folds are dealt; a document labelled more than once is good if any
label says so; without labelled rows of both kinds every score is 0.5. A line is the text
between line feeds, however long; repeated rows get equal scores; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import held_out, steps, word_bounds, span_hashes

LETTER, DIGIT, UPPER, MARK, SYMBOL, BLANK = (np.zeros(256, dtype=bool) for _ in range(6))
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
DIGIT[48:58] = True
UPPER[65:91] = True
MARK[[ord(c) for c in ".,;:!?'\"-()"]] = True
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SYMBOL[33:127] = True
SYMBOL &= ~(LETTER | DIGIT | MARK)
KINDS = (LETTER, DIGIT, UPPER, MARK, SYMBOL, BLANK)
STOP = np.zeros(256, dtype=bool)
STOP[[ord(c) for c in ".!?"]] = True

#: Features of one line; a node of the chain sees those of three lines.
OWN = 18
NODE = 3 * OWN + 1


def line_starts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where lines begin (and the last ends), and the first line of each row (and the end); every row has a line."""
    feeds = np.flatnonzero(data == 0x0A) + 1
    # A feed at a row's last byte begins another, empty line there, which is left out.
    inner = feeds[~np.isin(feeds, at)]
    begins = np.concatenate([at[:-1], inner])
    order = np.argsort(begins, kind="stable")
    begins, row = begins[order], np.concatenate([np.arange(len(at) - 1), np.searchsorted(at, inner, side="right") - 1])[order]
    order = np.argsort(row, kind="stable")
    begins, row = begins[order], row[order]
    return np.append(begins, at[-1]), np.searchsorted(row, np.arange(len(at)))


def sums_between(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.float64)])[edges])


def line_features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every node, length of every line, first line of each row and the end)."""
    lines, first = line_starts(data, at)
    n = len(lines) - 1
    size = np.diff(lines).astype(np.float64)
    letter, digit, upper, mark, symbol, blank = (sums_between(k[data], lines) for k in KINDS)
    starts, ends, word_of = word_bounds(data, lines)
    words = np.diff(word_of).astype(np.float64)
    lengths = (ends - starts).astype(np.float64)
    long_words = sums_between(lengths > 12, word_of)
    short_words = sums_between(lengths <= 3, word_of)
    squares = sums_between(lengths**2, word_of)
    hashes = span_hashes(data, starts, ends)
    line = np.repeat(np.arange(n), np.diff(word_of))
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    # Words that are new in their line, and in their document.
    new_here, new_in_row = (np.zeros(len(hashes), dtype=bool) for _ in range(2))
    for new, group in ((new_here, line), (new_in_row, row[line])):
        order = np.lexsort((hashes, group))
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (np.diff(hashes[order]) != 0) | (np.diff(group[order]) != 0)
        new[order[fresh]] = True
    # Words that end in a mark or symbol; every line's last byte before white space.
    tail_symbol = sums_between(SYMBOL[data[ends - 1]] if len(ends) else ends, word_of)
    tail_mark = sums_between(MARK[data[ends - 1]] if len(ends) else ends, word_of)
    head_upper = sums_between(UPPER[data[starts]] if len(starts) else starts, word_of)
    stops = np.zeros(n)
    has = words > 0
    stops[has] = STOP[data[ends[word_of[1:][has] - 1] - 1]]
    w, s = np.maximum(words, 1), np.maximum(size, 1)
    mean = (letter + digit + mark + symbol) / w
    lines_of = np.diff(first)[row]
    own = np.stack([
        np.log1p(size) / 5, np.log1p(words) / 4, letter / s, digit / s, upper / np.maximum(letter, 1), mark / s, symbol / s, blank / s,
        np.minimum(mean / 10, 5), np.sqrt(np.maximum(squares / w - (lengths.sum() and (sums_between(lengths, word_of) / w) ** 2), 0)) / 5,
        long_words / w, short_words / w, sums_between(new_here, word_of) / w, sums_between(new_in_row, word_of) / w,
        tail_symbol / w, tail_mark / w, head_upper / w, stops,
    ], axis=1).astype(np.float64)
    node = np.zeros((n, NODE))
    node[:, :OWN] = own
    inside = np.ones(n, dtype=bool)
    inside[first[:-1]] = False  # a row's first line has none before it
    node[1:, OWN : 2 * OWN][inside[1:]] = own[:-1][inside[1:]]
    follows = np.append(inside[1:], False)
    node[:, 2 * OWN : 3 * OWN][follows] = own[1:][follows[:-1]] if n > 1 else own[:0]
    node[:, -1] = np.log1p(lines_of) / 5
    return node, size, first


def expand(node: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Standardised features, their squares and a constant."""
    z = np.clip((node - mean) / spread, -6, 6)
    return np.concatenate([z, z * z / 3, np.ones((len(z), 1))], axis=1)


def marginals(unary: np.ndarray, tie: np.ndarray, first: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability that each line is good; expected counts of each transition, a line's with its weight; log of each row's sum over labellings.

    ``unary`` is the score of good over bad. Rows are walked side by side, the longest first.
    """
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")
    count, begin = count[order], first[:-1][order]
    ahead = np.zeros((len(unary), 2))
    back = np.zeros((len(unary), 2))
    longest = int(count[0]) if len(count) else 0
    active = np.searchsorted(-count, -np.arange(longest), side="left")  # rows longer than t
    for t in range(longest):
        at = begin[: active[t]] + t
        now = np.stack([np.zeros(len(at)), unary[at]], axis=1)
        if t:
            now += np.logaddexp(ahead[at - 1, :1] + tie[0], ahead[at - 1, 1:] + tie[1])
        ahead[at] = now
    pairs = np.zeros((2, 2))
    last = begin + count - 1
    total = np.zeros(len(count))
    total[order] = np.logaddexp(ahead[last, 0], ahead[last, 1])
    for t in range(longest - 2, -1, -1):
        at = begin[: active[t + 1]] + t
        then = back[at + 1] + np.stack([np.zeros(len(at)), unary[at + 1]], axis=1)
        back[at] = np.logaddexp(tie[:, 0][None, :] + then[:, :1], tie[:, 1][None, :] + then[:, 1:])
        norm = np.logaddexp(ahead[at, 0] + back[at, 0], ahead[at, 1] + back[at, 1])
        for a in range(2):
            for b in range(2):
                chance = np.exp(ahead[at, a] + tie[a, b] + then[:, b] - norm)
                pairs[a, b] += chance.sum() if weight is None else chance @ weight[at]
    both = ahead + back
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500))), pairs, total


def slopes(x: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray, theta: np.ndarray, tie: np.ndarray, decay: float) -> tuple[float, np.ndarray, np.ndarray]:
    """What is minimised, and its gradients: each row's negative log likelihood by its lines' weight, and the decay.

    All lines of a row have one weight and one label, its own.
    """
    unary = x @ theta
    p, pairs, total = marginals(unary, tie, first, weight)
    inner = np.ones(len(label), dtype=bool)
    inner[first[:-1]] = False
    kept = np.diag([(weight * (inner & (label == v))).sum() for v in (0, 1)])
    value = weight[first[:-1]] @ total - (weight * label) @ unary - (kept * tie).sum() + decay / 2 * (theta @ theta + (tie * tie).sum())
    return value, x.T @ (weight * (p - label)) + decay * theta, pairs - kept + decay * tie


def fit(node: np.ndarray, first: np.ndarray, good: np.ndarray, steps_: int = 200, rate: float = 0.1, decay: float = 2e-3) -> dict:
    """Maximum likelihood by Adam over all rows of the sample, rows of either label with equal total weight."""
    mean, spread = node.mean(axis=0), node.std(axis=0) + 1e-6
    x = expand(node, mean, spread)
    count = np.diff(first)
    label = np.repeat(good, count)
    # A row counts once however many lines it has.
    weight = np.repeat(1 / np.maximum(count, 1), count)
    share = 0.5 / max(good.sum(), 1), 0.5 / max((1 - good).sum(), 1)
    row_weight = np.where(good > 0, share[0], share[1])
    weight *= np.repeat(row_weight, count)
    theta, tie = np.zeros(x.shape[1]), np.zeros((2, 2))
    moments = [np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros((2, 2)), np.zeros((2, 2))]
    for k in range(1, steps_ + 1):
        _, slope, slope_tie = slopes(x, first, label, weight, theta, tie, decay)
        for value, g, m, v in ((theta, slope, *moments[:2]), (tie, slope_tie, *moments[2:])):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            value -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    return {"mean": mean, "spread": spread, "theta": theta, "tie": tie}


def sampled(docs: DataFrame, labels: DataFrame, folds: int, sample_docs: int, sample_lines: int, label_col: str, id_col: str, text_col: str) -> list:
    """Rows of (label, node features, lines) of the sample; the only rows that reach the driver."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col), folds))
    known = known.groupBy(F.col(id_col).alias("k")).agg(F.max(F.col(label_col).cast("int")).alias("good"))
    # As many of either label, as far as there are.
    chosen = known.where("good = 1").orderBy(F.xxhash64("k"), "k").limit(sample_docs // 2).unionByName(
        known.where("good = 0").orderBy(F.xxhash64("k"), "k").limit(sample_docs // 2)
    )
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("k"))
    # An id that repeats gives one row of its rows, so the bound holds.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, at in steps(batch.column(1)):
                node, _, first = line_features(data, at)
                rows = []
                for i in range(high - low):
                    a, b = int(first[i]), int(first[i + 1])
                    if b - a > sample_lines:
                        a += int((batch.column(2)[low + i].as_py() * 2654435761) % (b - a - sample_lines + 1))
                        b = a + sample_lines
                    rows.append(node[a:b].astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), batch.column(3).slice(low, high - low), pa.array(rows, pa.binary())], names=["id", "good", "nodes"])

    cut = picked.select("id", "text", F.pmod(F.xxhash64("id"), F.lit(1 << 31)).alias("seed"), "good").mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, good int, nodes binary")
    return cut.groupBy("id").agg(F.max("good").alias("good"), F.max("nodes").alias("nodes")).orderBy("id").collect()


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5, sample_docs: int = 4000, sample_lines: int = 64, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> dict | None:
    """The model fitted to a bounded sample of the labelled rows outside fold 0; None without rows of both kinds."""
    rows = sampled(docs, labels, folds, sample_docs, sample_lines, label_col, id_col, text_col)
    good = np.array([r["good"] for r in rows], dtype=np.float64)
    if not 0 < good.sum() < len(good):
        return None
    nodes = [np.frombuffer(r["nodes"], np.float32).reshape(-1, NODE) for r in rows]
    return fit(np.concatenate(nodes).astype(np.float64), np.cumsum([0, *map(len, nodes)]), good)


def score_texts(column: pa.Array, model: dict | None) -> np.ndarray:
    scores = np.full(len(column), 0.5)
    if model is not None:
        for low, high, data, at in steps(column):
            node, size, first = line_features(data, at)
            p, _, _ = marginals(expand(node, model["mean"], model["spread"]) @ model["theta"], model["tie"], first)
            # An empty line has weight 1, so that every row has some; every row has a line.
            scores[low:high] = np.add.reduceat((size + 1) * p, first[:-1]) / np.add.reduceat(size + 1, first[:-1])
    # Rounded, so that equal texts score alike wherever they are in a batch.
    return np.round(np.clip(scores, 0, 1), 9)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **sample) -> DataFrame:
    """id, held_out, score and predicted (1 if score >= threshold) of every row of ``docs``."""
    model = learn(docs, labels, folds, id_col=id_col, text_col=text_col, **sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_texts(batch.column(2), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=["id", "held_out", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col), folds).alias("held_out"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **sample) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is at least ``threshold``."""
    model = learn(docs, labels, folds, id_col=id_col, text_col=text_col, **sample)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(score_texts(batch.column(place), model) >= threshold))

    return docs.mapInArrow(run, docs.schema)
