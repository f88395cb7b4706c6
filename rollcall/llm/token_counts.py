"""Exact token counts without token ids.

Each word-like part of a text starts as one symbol per byte. A heap gives the adjacent pair of
lowest rank, a linked list joins it, and so on until no pair has a rank. The count is the
number of first symbols less the number of merges. Counts are kept per piece of text, so a
piece that occurs often is merged once per task.

Nulls and empty texts have 0 bytes and 0 tokens. There is no shuffle: rows are independent, so
repeated rows, ties and hot keys make no difference, and only the id and text columns are read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rollcall.llm.common import BYTE_VALUE, steps, text_parts
from rollcall.llm.pieces import SpanCache, byte_symbols, parts_of, pieces

class BytePairCounter:
    """Counts the tokens of a byte-level BPE given as a tokenizer's JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex")
        if not plain or before.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("only byte-level BPE without normalizer is supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take white space or word ends are not supported")
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.symbols = byte_symbols()
        whole = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.whole = regex.compile("|".join(map(regex.escape, whole))) if whole else None
        self.parts: dict[str, int] = {}

    def part(self, part: str) -> int:
        """Tokens of one part of the splitting pattern."""
        names = self.symbols
        symbols = [names[b] for b in part.encode("utf-8")]
        n, ranks = len(symbols), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if symbols[i] is None or j >= n or ranks.get((symbols[i], symbols[j])) != rank:
                continue  # one of the two has been merged since
            symbols[i] += symbols[j]
            symbols[j] = None
            merges += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (r, h))
        return n - merges

    def plain(self, text: str) -> int:
        total = 0
        if not text:
            return total
        for part in parts_of(text):
            if (n := self.parts.get(part)) is None:
                n = self.part(part)
                if len(part) <= 64:
                    if len(self.parts) > 300_000:
                        self.parts.clear()
                    self.parts[part] = n
            total += n
        return total

    def count(self, text: str) -> int:
        """Tokens of a text; an added token inside it is one token, as by default."""
        if self.whole is None or not (found := self.whole.findall(text)):
            return self.plain(text)
        return len(found) + sum(map(self.plain, self.whole.split(text)))


@lru_cache(maxsize=2)
def cached_counter(path: str) -> SpanCache:
    counter = BytePairCounter(path)
    return SpanCache(lambda pieces: [[counter.count(p.decode("utf-8"))] for p in pieces], BYTE_VALUE)


def token_counts(docs: DataFrame, tokenizer: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = cached_counter(tokenizer)
        for batch in batches:
            totals = np.zeros(batch.num_rows, dtype=np.int64)
            for low, high, data, at in steps(batch.column(1)):
                starts, ends, first = pieces(data, at)
                places = cache.find(data, starts, ends)
                counts = cache.numbers[cache.starts[places]]
                totals[low:high] = np.diff(np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[first])
            sizes = np.diff(text_parts(batch.column(1))[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(totals), pa.array(totals > limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
