"""Cutting a text where a byte-level BPE never merges, and a cache of what pieces give.

A piece is a run of white space with the run of other characters after it. The splitting
pattern of byte-level BPE never matches across the end of such a piece, and it looks ahead
within a piece only, so encoding pieces one by one gives what encoding the text gives. Pieces
are cut at ASCII white space; a row with other white space is taken whole.
"""

from __future__ import annotations

import json
import re
from codecs import charmap_decode
from collections.abc import Callable
from itertools import chain

import numpy as np
import regex

from rollcall.llm.common import gather_spans, span_hashes

# Fixed value: the characters of Unicode's White_Space, as a regular expression's set.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Fixed value: the splitting pattern of byte-level BPE, with its white space spelled out.
PARTS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)


#: Pieces of ASCII letters and marks after them: the pattern has one part for each.
SIMPLE = re.compile(rb"( ?)([A-Za-z]*)([!-/:-@\[-`{-~]*)")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE files: the byte's
    own where it is printable, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (chr(256 + i) for i in range(256))
    return [chr(b) if b in shown else next(others) for b in range(256)]


def parts_of(piece: str) -> list[str]:
    """The parts of the pattern; a run of letters, with or without one space before it, is one part."""
    word = piece[1:] if piece[:1] == " " else piece
    if word.isalpha():
        return [piece]
    if word[:-1].isalpha() and word[-1] in ".,;:!?":
        return [piece[:-1], piece[-1]]
    return PARTS.findall(piece)


_ASCII_WHITE = np.zeros(256, dtype=bool)
_ASCII_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def other_white(data: np.ndarray) -> np.ndarray:
    """Where white space begins that takes more than one byte."""
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    tail = np.concatenate([data, np.zeros(2, np.uint8)]).astype(np.int32)
    first, second, third = tail[lead], tail[lead + 1], tail[lead + 2]
    code = (first << 16) | (second << 8) | np.where(first == 0xC2, 0, third)
    wide = [c.encode("utf-8").ljust(3, b"\0") for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))]
    return lead[np.isin(code, [int.from_bytes(w, "big") for w in wide])]


def pieces(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of all rows, and the number of the first piece of each row (and the end).

    A row with white space beyond ASCII is one piece.
    """
    white = _ASCII_WHITE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[1:-1] = white[1:] & ~white[:-1]
    for row in np.unique(np.searchsorted(at, other_white(data), side="right") - 1).tolist():
        edge[at[row] : at[row + 1]] = False
    edge[at[:-1][np.diff(at) > 0]] = True
    edge[len(data)] = True
    cuts = np.flatnonzero(edge)
    return cuts[:-1], cuts[1:], np.searchsorted(cuts, at)


class SpanCache:
    """Arrays of numbers by the bytes of a span, kept over batches.

    Spans are looked up by a 64-bit hash, their length and their first 8 bytes, all in numpy;
    only unknown ones become Python objects. When the spans kept exceed ``max_spans``, those
    found but once since the last time go. Spans of over ``LONG`` bytes are not kept.
    """

    LONG = 256

    def __init__(self, make: Callable[[list[bytes]], list], values: np.ndarray, max_spans: int = 1_500_000):
        self.make, self.values, self.max_spans = make, values, max_spans
        self.n = 0  # places in use
        self.starts, self.hits, self.numbers = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.int32)
        self.names, self.heads, self.sizes = np.zeros(1024, np.uint64), np.zeros(1024, np.uint64), np.zeros(1024, np.int64)
        self.owner = np.zeros(1024, np.int64)  # of a place: a span of the batch that has it
        # A place by the hash's upper bits, or the next free slot after these; at least half of the slots are free.
        self.slots, self.used = np.full(1 << 12, -1, np.int32), 0

    def slot(self, names: np.ndarray) -> np.ndarray:
        return (names >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def look(self, names: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        at = self.slot(names)
        place = self.slots[at]
        left = np.flatnonzero((place >= 0) & (self.names[place] != names))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.slots) - 1)
            place[left] = self.slots[at[left]]
            left = left[(place[left] >= 0) & (self.names[place[left]] != names[left])]
        return place.astype(np.int64)

    def enter(self, places: np.ndarray) -> None:
        """Let places be found, whose hashes differ from each other and from those known."""
        self.used += len(places)
        if 2 * self.used > len(self.slots):
            places = np.concatenate([self.slots[self.slots >= 0], places])
            self.slots = np.full(1 << (4 * self.used - 1).bit_length(), -1, np.int32)
        at = self.slot(self.names[places])
        while len(places):
            free = self.slots[at] < 0
            self.slots[at[free]] = places[free]
            left = self.slots[at] != places
            places, at = places[left], (at[left] + 1) & (len(self.slots) - 1)

    def thin(self) -> None:
        known = self.slots[self.slots >= 0].astype(np.int64)
        kept = known[self.hits[known] > 1]
        if len(kept) > self.max_spans // 2:
            kept = kept[np.argsort(-self.hits[kept], kind="stable")[: self.max_spans // 2]]
        kept = np.sort(kept)
        sizes = np.diff(self.starts[: self.n + 1])[kept]
        self.numbers = self.numbers[gather_spans(self.starts[kept], sizes)]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.names, self.heads, self.sizes, self.hits, self.n = self.names[kept], self.heads[kept], self.sizes[kept], np.zeros(len(kept), np.int64), len(kept)
        self.owner, self.slots, self.used = np.zeros(len(kept), np.int64), np.full(1 << 12, -1, np.int32), 0
        self.enter(np.arange(self.n))

    def add(self, spans: list[bytes], names: np.ndarray, heads: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The new places of spans."""
        made, n, end = self.make(spans), self.n, int(self.starts[self.n])
        counts = np.fromiter(map(len, made), np.int64, len(made))
        total, self.n = int(counts.sum()), n + len(spans)
        self.starts, self.numbers = room(self.starts, self.n + 1), room(self.numbers, end + total)
        self.hits, self.names, self.heads, self.sizes, self.owner = (room(x, self.n) for x in (self.hits, self.names, self.heads, self.sizes, self.owner))
        self.starts[n + 1 : self.n + 1] = end + np.cumsum(counts)
        self.numbers[end : end + total] = np.fromiter(chain.from_iterable(made), np.int32, total)
        self.names[n : self.n], self.heads[n : self.n], self.sizes[n : self.n], self.hits[n : self.n] = names, heads, sizes, 0
        return np.arange(n, self.n)

    def head(self, data: np.ndarray, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The first 8 bytes of spans, by their values."""
        head = np.zeros(len(low), np.uint64)
        for k in range(8):
            here = np.flatnonzero(size > k)
            byte = self.values[data[low[here] + k]] & np.uint64(0xFF)
            head[here] |= byte << np.uint64(8 * k)
        return head

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The place of each span; valid until the next call."""
        if self.n > self.max_spans:
            self.thin()
        if not len(starts):
            return np.zeros(0, np.int64)
        hashes = span_hashes(data, starts, ends, self.values)
        place = self.look(hashes)
        known = np.flatnonzero(place >= 0)
        # Of the spans at a place, one is compared in length and first bytes.
        at = place[known]
        self.owner[at] = known
        one = known[self.owner[at] == known]
        at, size = place[one], (ends - starts)[one]
        other = at[(self.sizes[at] != size) | (self.heads[at] != self.head(data, starts[one], size))]
        if len(other):
            place[np.isin(place, other)] = -1
        new = np.flatnonzero(place < 0)
        if len(new):
            names, first, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            low, size = starts[new[first]], (ends - starts)[new[first]]
            whole = data.tobytes()
            spans = [whole[a:b] for a, b in zip(low.tolist(), (low + size).tolist(), strict=True)]
            added = self.add(spans, names, self.head(data, low, size), size)
            # Long ones, and one whose hash another has, serve this batch only.
            self.enter(added[~np.isin(names, self.names[other]) & (size <= self.LONG)])
            place[new] = added[back]
        np.add.at(self.hits, place, 1)
        return place

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the spans at ``places``, one after another, and how many each has."""
        sizes = self.starts[places + 1] - self.starts[places]
        return self.numbers[gather_spans(self.starts[places], sizes)], sizes


def room(x: np.ndarray, size: int) -> np.ndarray:
    """The array with space for ``size`` values, doubled when it is short; new values are 0."""
    if size <= len(x):
        return x
    grown = np.zeros(max(size, 2 * len(x)), x.dtype)
    grown[: len(x)] = x
    return grown


class PieceEncoder:
    """Ids of pieces by the tokenizers library's model, part by part of the splitting pattern.

    A piece that holds an added token, and every piece if the tokenizer is no byte-level BPE of
    this pattern, goes through the library's whole encoder.
    """

    def __init__(self, path: str, added_as_text: bool = False, max_parts: int = 200_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        before = spec.get("pre_tokenizer") or {}
        self.plain = (
            spec["model"]["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not spec.get("normalizer")
        )
        added = [] if added_as_text else [re.escape(t["content"]) for t in spec["added_tokens"]]
        # An added token of this form could be inside a simple piece.
        self.simple = self.plain and not any(SIMPLE.fullmatch(t["content"].encode("utf-8")) for t in spec["added_tokens"])
        self.tokenizer.encode_special_tokens = added_as_text
        self.added = re.compile("|".join(added)) if added else None
        self.model, self.symbols = self.tokenizer.model, "".join(byte_symbols())
        self.space = self.symbols[0x20]
        self.parts: dict[str, tuple[int, ...]] = {}
        self.max_parts = max_parts

    def part(self, name: str) -> tuple[int, ...]:
        """Ids of one part, named in the symbols of byte-level BPE files."""
        ids = self.parts.get(name)
        if ids is None:
            ids = tuple([t.id for t in self.model.tokenize(name)])
            if len(self.parts) > self.max_parts:
                self.parts.clear()
            if len(name) <= 64:
                self.parts[name] = ids
        return ids

    def encode(self, piece: bytes) -> tuple[int, ...] | list[int]:
        if self.simple and piece[1:].isalpha() and piece[0] == 0x20:  # ASCII letters
            return self.part(self.space + piece[1:].decode("ascii"))
        if self.simple and (found := SIMPLE.fullmatch(piece)):
            space, word, marks = (g.decode("ascii") for g in found.groups())
            space = self.space if space else ""
            if word:
                return self.part(space + word) + self.part(marks) if marks else self.part(space + word)
            return self.part(space + marks)
        text = piece.decode("utf-8")
        if not self.plain or (self.added and self.added.search(text)):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return [i for part in parts_of(text) for i in self.part(charmap_decode(part.encode("utf-8"), "strict", self.symbols)[0])]
