"""Removing repeated runs of sentences.

A sentence ends after ``.``, ``!`` or ``?`` before white space, or at a line's end. Long
sentences would hide a passage that begins or ends inside one, so they are taken clause by
clause, a clause ending after ``,``, ``;`` or ``:`` too; one without words belongs to the one
before it. A clause of more than ``REACH`` words is cut further, before the word of the smallest
hash (the last of equal ones) of every ``REACH`` words in a row of it; so a part has ``REACH`` words
at most, and where it is cut depends on fewer than ``REACH`` words to either side. "Sentence" means
such a part below. At every sentence begins a run: the shortest with at least ``run`` sentences and
``min_words`` words; a text with fewer sentences but enough words is one run. With the default
parameters every repeated passage of more than 50 words, each followed by the same kind of white
space, holds a whole run, whatever its clauses. Runs are compared by a 64-bit hash of their
words, so letter case A-Z and white space do not matter. The first occurrence of a run is the
one in the smallest id, and there the first place. Sentences covered by any other occurrence
are removed; everything else stays byte for byte.

One shuffle deals every run out by its hash. Before it, each batch of rows keeps one row per
hash whose rank is open; rows of larger ids in the same batch are known to be repeats and are
dealt out evenly, so a passage that a third of all documents share is one row per batch on its
task. There, runs are read in sorted order as a stream. A second shuffle joins the repeats to
the documents by id.

Defined results: a null or empty text has no sentences. Rows without id are left as they are
and are nobody's first occurrence. Rows that share an id count as one document: what an earlier
document holds is removed from each of them. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import mix, powers, span_hashes, steps, word_bounds

ENDS = np.zeros(256, dtype=bool)
ENDS[[ord(c) for c in ".!?,;:"]] = True
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


REACH = 12


def long_cuts(words: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The words at which clauses of more than ``REACH`` words, beginning at the words ``begins``, are cut further."""
    sizes = np.diff(begins, append=len(words))
    clause = np.repeat(np.where(sizes > REACH, np.arange(len(begins)), -1), sizes)
    low = np.flatnonzero((clause[: 1 - REACH] >= 0) & (clause[: 1 - REACH] == clause[REACH - 1 :])) if len(words) >= REACH else begins[:0]
    back = np.arange(REACH)[::-1]
    return np.unique(low + back[np.argmin(words[low[:, None] + back], axis=1)])


class Sentences:
    """The sentences of the rows of one step, and the runs that begin at them."""

    def __init__(self, data: np.ndarray, at: np.ndarray, run: int, min_words: int):
        n = len(data)
        after = np.ones(n + 1, dtype=bool)  # white space or the row's end follows
        after[:n] = BLANK[data]
        after[at] = True
        cut = np.zeros(n + 1, dtype=bool)
        cut[1:] = (ENDS[data] & after[1:]) | (data == 0x0A)
        cut[at] = True
        starts, ends, first = word_bounds(data, at)
        # A sentence begins at the first word after a cut.
        cuts = np.cumsum(cut)[starts] if len(starts) else starts
        begins = np.flatnonzero(np.diff(cuts, prepend=-1) > 0)
        words = span_hashes(data, starts, ends)
        begins = np.union1d(begins, long_cuts(words, begins))
        self.first_word = np.append(begins, len(starts))
        self.row = np.searchsorted(at, starts[begins], side="right") - 1
        self.of_row = np.searchsorted(begins, first)  # first sentence of each row, then the end
        self.at = starts[begins]  # first byte
        self.last = self.of_row[self.row + 1]  # the sentence after the row's last
        # Where the run that begins at each sentence ends.
        enough = np.searchsorted(self.first_word, self.first_word[:-1] + min_words)
        self.end = np.maximum(np.arange(len(begins)) + run, enough)
        few = (np.arange(len(begins)) == self.of_row[self.row]) & (self.last - self.of_row[self.row] < run) & (enough <= self.last)
        self.end[few] = self.last[few]
        self.whole = np.flatnonzero(self.end <= self.last)
        up, down = powers(len(words) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])])
        low, high = self.first_word[self.whole], self.first_word[self.end[self.whole]]
        self.hashes = mix((sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64)).view(np.int64)


def first_in_row(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True for the first of equal hashes of a row, in their order."""
    order = np.lexsort((np.arange(len(rows)), hashes, rows))
    new = np.ones(len(rows), dtype=bool)
    new[order[1:]] = (np.diff(rows[order]) != 0) | (np.diff(hashes[order]) != 0)
    return new


def repeated_runs(docs: DataFrame, run: int, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """doc, h: the runs of each document that a document with a smaller id holds, each once or more."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            all_h, all_doc = [], []
            for low, high, data, at in steps(batch.column(1)):
                s = Sentences(data, at, run, min_words)
                rows = s.row[s.whole]
                once = first_in_row(rows, s.hashes)
                all_h.append(s.hashes[once])
                all_doc.append(ids[low:high][rows[once]])
            h, doc = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (all_h, all_doc))
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = np.diff(h) != 0
            sure = doc > doc[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))] if len(h) else new
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(doc), pa.array(sure)], names=["h", "doc", "sure"])

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_h = last_doc = None  # the hash read last and its first document
        for batch in batches:
            h, doc, sure = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            out_h, out_doc = [h[sure]], [doc[sure]]
            h, doc = h[~sure], doc[~sure]
            if len(h):
                new = np.ones(len(h), dtype=bool)
                new[1:] = np.diff(h) != 0
                first = doc[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]
                if last_h is not None and h[0] == last_h:
                    first[h == last_h] = last_doc
                last_h, last_doc = h[-1], first[-1]
                out_h.append(h[doc > first])
                out_doc.append(doc[doc > first])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_doc)), pa.array(np.concatenate(out_h))], names=["doc", "h"])

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_col).mapInArrow(spread, "h long, doc long, sure boolean")
    dealt = rows.repartition(F.when(F.col("sure"), F.xxhash64("h", "doc")).otherwise(F.col("h")))
    return dealt.sortWithinPartitions("sure", "h", "doc").mapInArrow(repeats, "doc long, h long")


def remove_repeated_runs(
    docs: DataFrame, run: int = 2, min_words: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_sentences, n_removed and the text that is left, for every row of ``docs``."""
    known = repeated_runs(docs, run, min_words, id_col, text_col)
    known = known.groupBy("doc").agg(F.collect_set("h").alias("known"))
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    joined = slim.join(known, slim["id"] == known["doc"], "left").select("id", "text", "known")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, gone = [], [], []
            lists = batch.column(2)
            for low, high, data, at in steps(batch.column(1)):
                s = Sentences(data, at, run, min_words)
                rows = s.row[s.whole]
                bad = ~first_in_row(rows, s.hashes)
                named = batch.column(0).slice(low, high - low).is_valid().to_numpy(zero_copy_only=False)
                bad &= named[rows]
                for i in range(high - low):
                    if lists[low + i].is_valid:
                        a, b = np.searchsorted(rows, [i, i + 1])
                        bad[a:b] |= np.isin(s.hashes[a:b], lists[low + i].values.to_numpy())
                change = np.zeros(len(s.row) + 1, dtype=np.int64)
                np.add.at(change, s.whole[bad], 1)
                np.add.at(change, s.end[s.whole[bad]], -1)
                covered = np.cumsum(change[:-1]) > 0
                totals.append(np.diff(s.of_row))
                sums = np.concatenate([[0], np.cumsum(covered)])
                gone.append(np.diff(sums[s.of_row]))
                for i in range(high - low):
                    a, b = s.of_row[i], s.of_row[i + 1]
                    whole = data[at[i] : at[i + 1]]
                    if covered[a:b].any():
                        # A sentence's bytes go up to the next one's first word.
                        edges = np.append(s.at[a:b], at[i + 1])
                        keep = np.ones(len(whole), dtype=bool)
                        for j in np.flatnonzero(covered[a:b]):
                            keep[edges[j] - at[i] : edges[j + 1] - at[i]] = False
                        whole = whole[keep]
                        texts.append(whole.tobytes().decode("utf-8"))
                    else:
                        texts.append(batch.column(1)[low + i].as_py())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(totals) if totals else np.zeros(0, np.int64)), pa.array(np.concatenate(gone) if gone else np.zeros(0, np.int64)), pa.array(texts, pa.string())],
                names=["id", "n_sentences", "n_removed", "text"],
            )

    out = joined.mapInArrow(strip, "id long, n_sentences long, n_removed long, text string")
    return out.withColumnRenamed("id", id_col)
