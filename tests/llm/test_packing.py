"""Packed sequences against the tokenizer's own ids, and the rules of the sequences."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rollcall.llm.packing import cut_lengths, pack_documents, powers_of_two, read_pieces, read_sequences
from rollcall.session import new_scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello, World! it's  5 o'clock\tnow\n\nand 1234 <|endoftext|> a<|startoftext|>b", "", None, " ", "ΟΔΥΣΣΕΥΣ ΣΑΣ é ́x áb",
    "ein Wort zwei 　 drei", "你好 世界 \U0001f600\U0001f600", "x" * 3000, "don't DON'T 're 'S", "word " * 5000, "\x00\x01 \x0b \x85 z",
]


def ids_of(texts, end=1):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, end] for t in texts]


def packed(spark, docs, **options):
    path = new_scratch_path(spark, "packing-test")
    pack_documents(docs, TOKENIZER, path, **options)
    return path


def check(spark, path, wanted, capacity, slack=1 / 128):
    """Every id once, in sequences that hold the rules; gives the share of padding."""
    sequences = {r["sequence_id"]: r for r in read_sequences(spark, path).collect()}
    pieces = read_pieces(spark, path).collect()
    assert len(sequences) == read_sequences(spark, path).count()
    found, ends = defaultdict(list), Counter()
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == ends[p["sequence_id"]] and p["length"] > 0
        ends[p["sequence_id"]] += p["length"]
        raw = bytes(sequences[p["sequence_id"]]["ids"][4 * p["offset"] : 4 * (p["offset"] + p["length"])])
        assert p["ids_crc32"] == zlib.crc32(raw)
        found[p["doc_id"]].append((p["start"], np.frombuffer(raw, "<u4").tolist(), p["doc_tokens"]))
    assert {i: 4 * n for i, n in ends.items()} == {i: len(s["ids"]) for i, s in sequences.items()}
    assert all(n <= capacity for n in ends.values())
    got = {}
    for doc, parts in found.items():
        parts.sort()
        whole = [i for _, ids, _ in parts for i in ids]
        at = np.cumsum([0] + [len(ids) for _, ids, _ in parts])
        assert [s for s, _, _ in parts] == at[:-1].tolist() and {n for _, _, n in parts} == {len(whole)}
        got[doc] = whole
    assert got == wanted
    total = sum(ends.values())
    padding = sum(capacity - n for n in ends.values() if n & (n - 1))
    assert padding <= slack * total + len(pieces)
    return padding / total if total else 0


@pytest.mark.parametrize("capacity", [2048, 64])
def test_every_id_once(spark, docs_of, capacity):
    docs = docs_of(list(enumerate(TEXTS)))
    path = packed(spark, docs, capacity=capacity)
    check(spark, path, dict(enumerate(ids_of(TEXTS))), capacity)


def test_many_parts_meet_level_by_level(spark, docs_of):
    texts = [" ".join(["word"] * (1 + i * 7 % 90)) for i in range(700)]
    docs = docs_of(list(enumerate(texts)), repartition=150)
    path = packed(spark, docs, capacity=128)
    assert spark.read.parquet(path).select("level").distinct().count() == 4
    share = check(spark, path, dict(enumerate(ids_of(texts))), 128)
    assert share < 0.01


def test_full_sequences_hold_their_class(spark, docs_of):
    texts = [" ".join(["word"] * 339) for _ in range(13)]  # 340 ids, class 6 of 2,048
    path = packed(spark, docs_of(list(enumerate(texts))), slack=0.1)
    rows = read_sequences(spark, path).collect()
    assert sorted(len(r["doc_ids"]) for r in rows if len(r["ids"]) == 4 * 6 * 340) == [6, 6]


def test_cuts():
    for n in [*range(1, 5000, 7), 2048, 4096, 100_000]:
        for slack in (0, 1 / 128, 0.3):
            cuts = cut_lengths(n, 2048, slack)
            assert sum(cuts) == n and all(0 < c <= 2048 for c in cuts)
            k = 2048 // cuts[-1]
            assert 2048 / k - cuts[-1] <= max(slack * n, 1)
            assert all(2048 // c * c > 2048 - 2048 // c for c in cuts[:-1])
    assert powers_of_two(2047) == [1 << b for b in reversed(range(11))] and powers_of_two(0) == []


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(None, "a b", 1, "x"), (None, "a b", 2, "y"), (3, "c", 3, "z"), (3, "c", 4, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int, k string")
    pieces = read_pieces(spark, packed(spark, docs)).collect()
    assert sum(p["length"] for p in pieces) == 10
    assert Counter(p["doc_id"] for p in pieces if p["start"] == 0) == {None: 2, 3: 2}


def test_empty_table(spark, docs_of):
    path = packed(spark, docs_of([]))
    assert read_pieces(spark, path).count() == 0


def test_no_id_crosses_the_driver_and_padding_is_small_on_real_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    wanted = dict(zip(texts, ids_of(texts.values()), strict=True))
    assert check(spark, packed(spark, docs), wanted, 2048) < 0.01
