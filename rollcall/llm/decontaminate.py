"""Benchmark decontamination by a BM25 index of the test items.

Every test item is cut in units of up to ``unit_words`` words, and an inverted index holds the
BM25 impact of each word on each unit. Every training document is cut in overlapping passages,
each of which is a query. A passage finds all units whose score is at least ``reach`` of the
unit's score against itself, or less where that could miss a leak: of all stretches of an item
that hold enough of its grams to count, the shortest are looked up, and in one unit at least the
threshold is what such a stretch leaves there. So an item that stands in a document in one
piece is found whenever the piece counts as a leak, also across a border of units. Units are in blocks, and the index keeps a word's largest impact
in each block (block-max). The words of a unit whose impacts together stay below its threshold
do not open its block, as a passage that reaches the threshold holds one of the others; an
opened block is looked at only if the passage's block maxima reach the least threshold in it,
and only there are units scored.

A found item counts as leaked if the document holds at least ``overlap`` of the distinct
``gram`` word grams of its question, and as much of those of its answer. The answer is the
item's last sentence and the question what comes before it; with one sentence both are the
whole item. A part shorter than ``gram`` words has one gram, all of it.

Words are runs of letters, digits and bytes from 0x80, lower-cased, so marks do not matter.

The items' size is checked: up to ``shard_bytes`` they are one index, beyond it they are dealt
into shards by hash and every shard is one pass over the documents. An index is built from one
shard at a time and broadcast. Documents are not shuffled, and hot keys make no difference.

Defined results: null and empty texts match nothing, items without words are never found,
repeated rows and repeated items match alike, a null id is reported as null, and an empty
table on either side gives no match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import gather_spans, gram_hashes, steps, word_bounds, span_hashes

OUTSIDE = np.ones(256, dtype=bool)
OUTSIDE[48:58] = OUTSIDE[65:91] = OUTSIDE[97:123] = OUTSIDE[128:] = False
K1, B = 1.2, 0.75
BLOCK = 16
SIEVE = 1 << 18


def grams_of(words: np.ndarray, gram: int) -> np.ndarray:
    return np.unique(gram_hashes(words, min(gram, len(words)))) if len(words) else np.zeros(0, np.uint64)


def least_pieces(words: np.ndarray, cut: int, gram: int, overlap: float) -> list[tuple[int, int, int]]:
    """(first word, word after the last, all words) of the stretches of an item that hold ``overlap``
    of the distinct grams of its parts, none of which holds another."""
    n, spots = len(words), []
    for low, high in ((0, cut), (cut, n)) if cut else ((0, n),):
        width = min(gram, high - low)
        _, kind = np.unique(gram_hashes(words[low:high], width), return_inverse=True)
        spots.append((low, width, kind, -(-round(overlap * (int(kind.max()) + 1) * 1e6) // 1_000_000)))
    counts = [np.zeros(int(kind.max()) + 1, np.int64) for _, _, kind, _ in spots]
    held, found, high = [0] * len(spots), [], 0
    for begin in range(n):
        while high < n and any(h < need for h, (_, _, _, need) in zip(held, spots, strict=True)):
            high += 1
            for p, (low, width, kind, _) in enumerate(spots):
                at = high - width - low  # the gram that ends here
                if 0 <= at < len(kind) and at + low >= begin:
                    held[p] += int(counts[p][kind[at]] == 0)
                    counts[p][kind[at]] += 1
        if any(h < need for h, (_, _, _, need) in zip(held, spots, strict=True)):
            break
        found.append((begin, high, n))
        for p, (low, width, kind, _) in enumerate(spots):
            at = begin - low  # the gram that begins here goes
            if 0 <= at < len(kind) and begin + width <= high:
                counts[p][kind[at]] -= 1
                held[p] -= int(counts[p][kind[at]] == 0)
    return [f for k, f in enumerate(found) if k + 1 == len(found) or found[k + 1][1] > f[1]]


class Index:
    """The impacts of words on units, with their maxima by block, and the items' grams."""

    def __init__(self, items: list[tuple[int, str]], unit_words: int, gram: int, reach: float, overlap: float | None = None):
        self.gram = gram
        self.ids: list = []
        self.parts: list[tuple[tuple[int, np.ndarray], tuple[int, np.ndarray]]] = []
        units, unit_item, pieces = [], [], []
        for item, text in items:
            data = np.frombuffer((text or "").encode("utf-8"), np.uint8)
            starts, ends, _ = word_bounds(data, np.array([0, len(data)]), OUTSIDE)
            if not len(starts):
                continue
            words = span_hashes(data, starts, ends)
            stop = np.flatnonzero(np.isin(data, list(b".!?\n")))
            # The last sentence begins at the first word after the last stop that words follow.
            begins = np.searchsorted(starts, stop, side="right")
            begins = begins[(begins > 0) & (begins < len(words))]
            cut = int(begins.max()) if len(begins) else 0
            question, answer = (words[:cut], words[cut:]) if cut else (words, words)
            self.ids.append(item)
            self.parts.append(tuple((min(gram, len(w)), grams_of(w, gram)) for w in (question, answer)))
            pieces.append((len(units), least_pieces(words, cut, gram, overlap) if overlap else []))
            # Units of about equal length: short ones say little.
            for part in np.array_split(words, -(-len(words) // unit_words)):
                units.append(part)
                unit_item.append(len(self.ids) - 1)
        # Long units first, so that a block's units have similar thresholds.
        by = sorted(range(len(units)), key=lambda u: -len(units[u]))
        cut_units, place_of = units, np.argsort(by)
        units, self.item = [units[u] for u in by], np.array([unit_item[u] for u in by], dtype=np.int64)
        n = len(units)
        size = np.array([len(u) for u in units], dtype=np.float64)
        of = np.repeat(np.arange(n), size.astype(np.int64))
        flat = np.concatenate(units) if units else np.zeros(0, np.uint64)
        self.words, term = np.unique(flat, return_inverse=True)
        pair, tf = np.unique(term * max(n, 1) + of, return_counts=True)
        term, unit = pair // max(n, 1), pair % max(n, 1)
        df = np.bincount(term, minlength=len(self.words))
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        scale = K1 * (1 - B + B * size[unit] / (size.mean() if n else 1))
        impact = idf[term] * tf * (K1 + 1) / (tf + scale)
        self.n_blocks = -(-n // BLOCK)
        #: Postings are in order of word, then unit; an entry is a word's postings in one block.
        key = term * max(self.n_blocks, 1) + unit // BLOCK
        self.keys, begin = np.unique(key, return_index=True)
        self.begin = np.append(begin, len(key))
        self.unit, self.impact = unit, impact
        self.peak = np.maximum.reduceat(impact, begin) if len(key) else impact
        cells = len(self.words) * self.n_blocks
        #: The same by word and block, where that is a small table.
        self.peaks = np.zeros(cells, np.float32) if cells <= 1 << 22 else None
        if self.peaks is not None:
            self.peaks[self.keys] = np.nextafter(self.peak.astype(np.float32), np.float32(np.inf))
        whole = np.bincount(unit, weights=impact, minlength=n)
        self.need = reach * whole
        worth = {(int(u), int(self.words[t])): w for u, t, w in zip(unit.tolist(), term.tolist(), impact.tolist(), strict=True)} if overlap else {}
        for first_unit, found in pieces:
            edges = [0]
            while found and edges[-1] < found[-1][2]:
                edges.append(edges[-1] + len(cut_units[first_unit + len(edges) - 1]))
            known: dict[tuple[int, int, int], float] = {}
            for low, high, _ in found:
                best = (-1.0, 0, 0.0)
                for k in range(len(edges) - 1):
                    a, b = max(low, edges[k]), min(high, edges[k + 1])
                    if a < b:
                        at = int(place_of[first_unit + k])
                        if (k, a, b) not in known:
                            here = set(cut_units[first_unit + k][a - edges[k] : b - edges[k]].tolist())
                            known[k, a, b] = sum(worth[at, w] for w in here)
                        best = max(best, (known[k, a, b] / whole[at], at, known[k, a, b]))
                self.need[best[1]] = min(self.need[best[1]], best[2])
        self.need = self.need * (1 - 1e-9) - 1e-9
        self.block_need = np.minimum.reduceat(self.need, np.arange(0, n, BLOCK)) if n else self.need
        # A unit's words of smallest impact that together stay below its threshold are not needed to
        # open it: a passage that reaches the threshold holds one of the others.
        by = np.lexsort((impact, unit))
        upto = np.cumsum(impact[by])
        begin = np.searchsorted(unit[by], unit[by])
        upto -= (upto - impact[by])[begin] if n else upto
        opening = by[upto >= self.need[unit[by]]]
        #: The blocks that each word opens, in order of word.
        self.open_keys = np.unique(key[opening])
        self.open_entry = np.searchsorted(self.open_keys, np.arange(len(self.words) + 1) * max(self.n_blocks, 1))
        self.opens = np.diff(self.open_entry) > 0
        self.sieve = np.zeros(SIEVE, dtype=bool)
        self.sieve[(self.words[self.opens] % np.uint64(SIEVE)).astype(np.int64)] = True

    def dense_peak(self, term: np.ndarray, block: np.ndarray) -> np.ndarray:
        """The largest impact of words in blocks, 0 where they do not occur."""
        key = term * self.n_blocks + block
        if self.peaks is not None:
            return self.peaks[key]
        entry = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[entry] == key, self.peak[entry], 0)

    def search(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, item) of every unit found; the input pairs are distinct and in order of passage."""
        if not len(passage) or not len(self.need):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        low, high = self.open_entry[term], self.open_entry[term + 1]
        block = self.open_keys[gather_spans(low, high - low)] % self.n_blocks
        spot = np.unique(np.repeat(passage, high - low) * self.n_blocks + block)
        # The largest score a passage can have in a block that one of its words opens.
        low, high = np.searchsorted(passage, spot // self.n_blocks), np.searchsorted(passage, spot // self.n_blocks, side="right")
        pick = gather_spans(low, high - low)
        of = np.repeat(np.arange(len(spot)), high - low)
        bound = np.bincount(of, weights=self.dense_peak(term[pick], spot[of] % self.n_blocks), minlength=len(spot))
        spot = spot[bound >= self.block_need[spot % self.n_blocks]]
        # Every word of the passages that remain, in the blocks that remain.
        low, high = np.searchsorted(passage, spot // self.n_blocks), np.searchsorted(passage, spot // self.n_blocks, side="right")
        pick = gather_spans(low, high - low)
        of = np.repeat(np.arange(len(spot)), high - low)
        key = term[pick] * self.n_blocks + spot[of] % self.n_blocks
        entry = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[entry] == key
        entry, of = entry[hit], of[hit]
        low, high = self.begin[entry], self.begin[entry + 1]
        post = gather_spans(low, high - low)
        pair = (spot[np.repeat(of, high - low)] // self.n_blocks) * len(self.need) + self.unit[post]
        pair, back = np.unique(pair, return_inverse=True)
        score = np.bincount(back, weights=self.impact[post], minlength=len(pair))
        pair = pair[score >= self.need[pair % len(self.need)]]
        return pair // len(self.need), self.item[pair % len(self.need)]

    def leaks(self, column: pa.Array, unit_words: int, overlap: float) -> list[tuple[int, int, float, float]]:
        """(row, place of the item, share of the question, share of the answer) of every leak in the texts."""
        found = []
        for low, high, data, at in steps(column):
            starts, ends, first = word_bounds(data, at, OUTSIDE)
            words = span_hashes(data, starts, ends)
            if not len(words) or not len(self.words):
                continue
            # Only passages with a word that can open a unit are queries.
            near = np.flatnonzero(self.sieve[(words % np.uint64(SIEVE)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.words, words[near]), len(self.words) - 1)
            near = near[(self.words[place] == words[near]) & self.opens[place]]
            row = np.searchsorted(first, near, side="right") - 1
            # Passages of twice a unit's words, one beginning at every unit_words words: a run of unit_words words is whole in one of them.
            slots = np.diff(first) // unit_words + 2
            base = np.cumsum(slots) - slots
            slot = base[row] + (near - first[row]) // unit_words
            names = np.unique(np.concatenate([slot, slot + 1]))
            row = np.searchsorted(base, names, side="right") - 1
            middle = first[row] + (names - base[row]) * unit_words
            low_word, high_word = np.maximum(middle - unit_words, first[row]), np.minimum(middle + unit_words, first[row + 1])
            spot = gather_spans(low_word, high_word - low_word)
            passage = np.repeat(np.arange(len(names)), high_word - low_word)
            place = np.minimum(np.searchsorted(self.words, words[spot]), len(self.words) - 1)
            known = self.words[place] == words[spot]
            pairs = np.unique(passage[known] * len(self.words) + place[known])
            passage, item = self.search(pairs // len(self.words), pairs % len(self.words))
            candidates = np.unique(row[passage] * len(self.ids) + item)
            grams: dict[tuple[int, int], np.ndarray] = {}
            for r, i in zip((candidates // len(self.ids)).tolist(), (candidates % len(self.ids)).tolist(), strict=True):
                shares = []
                for n, wanted in self.parts[i]:
                    if (r, n) not in grams:
                        grams[r, n] = gram_hashes(words[first[r] : first[r + 1]], n)
                    shares.append(float(np.isin(wanted, grams[r, n]).mean()))
                if min(shares) >= overlap:
                    found.append((low + r, i, *shares))
        return found


def indexes(benchmark: DataFrame, unit_words: int, gram: int, reach: float, overlap: float, shard_bytes: int, item_col: str, text_col: str) -> Iterator[Index]:
    """The items' index, or one index per shard where they are larger than ``shard_bytes``."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    shards = -(-int(size) // shard_bytes)
    for k in range(shards):
        part = items if shards == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == k)
        yield Index(sorted(((r["item"], r["text"]) for r in part.collect()), key=repr), unit_words, gram, reach, overlap)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, unit_words: int = 32, gram: int = 5, reach: float = 0.6, overlap: float = 0.5, shard_bytes: int = 1 << 22,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, question_overlap and answer_overlap of every leaked item of every document."""
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, item_id long, question_overlap double, answer_overlap double"
    parts = []
    for index in indexes(benchmark, unit_words, gram, reach, overlap, shard_bytes, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaks = shared.value.leaks(batch.column(1), unit_words, overlap)
                rows = pa.array([x[0] for x in leaks], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), pa.array([shared.value.ids[x[1]] for x in leaks], pa.int64()), pa.array([x[2] for x in leaks], pa.float64()), pa.array([x[3] for x in leaks], pa.float64())],
                    names=["id", "item_id", "question_overlap", "answer_overlap"],
                )

        parts.append(slim.mapInArrow(run, schema))
    out = parts[0] if parts else docs.sparkSession.createDataFrame([], schema)
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumnRenamed("id", id_col)


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, unit_words: int = 32, gram: int = 5, reach: float = 0.6, overlap: float = 0.5, shard_bytes: int = 1 << 22,
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no leaked item."""
    place = docs.columns.index(text_col)
    for index in indexes(benchmark, unit_words, gram, reach, overlap, shard_bytes, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[x[0] for x in shared.value.leaks(batch.column(place), unit_words, overlap)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
