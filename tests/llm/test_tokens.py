"""Token counts and token files against the tokenizers library."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rollcall.llm.common import BYTE_VALUE
from rollcall.llm.pieces import SpanCache, pieces
from rollcall.llm.token_counts import BytePairCounter, token_counts
from rollcall.llm.token_files import pack, read_ids, read_token_files, unpack, width, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "\n\n  a", "a  b   c ", "Hello there's a test, isn't it?", "x" * 20_000, "tab\tand\x1cfs\xa0nbsp　wide  em",
    "before <|endoftext|> after<|endoftext|><|endoftext|>  ", "ñandú çédille straße Ⅷ ½ ٣ 漢字 😀😀", "  <|endoftext|>\n", "a\r\n\r\n b", "word " * 5_000, "'s 't'll 12 345",
    "\x85next line", "trailing   \n ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def rows(texts):
    raw = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_pieces_make_up_the_text():
    data, at = rows(TEXTS)
    starts, ends, first = pieces(data, at)
    for i, t in enumerate(TEXTS):
        parts = [data[a:b].tobytes().decode() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]], strict=True)]
        assert "".join(parts) == (t or "") and all(parts)
    assert len(starts) > 5_000


def test_counter_alone(library):
    counter = BytePairCounter(PATH)
    for t in TEXTS:
        assert counter.count(t or "") == len(ids_of(library, t))


def test_cache_forgets_rare_spans_only():
    made = []
    cache = SpanCache(lambda new: made.extend(new) or [[len(p), *p] for p in new], BYTE_VALUE, max_spans=3)
    for words in (["a", "bb", "a"], ["ccc", "dddd", "a"], ["a", "eeeee", "bb"], ["a"], [], ["x" * 300], ["a", "x" * 300]):
        data, at = rows(words)
        numbers, sizes = cache.gather(cache.find(data, at[:-1], at[1:]))
        assert numbers.tolist() == [n for w in words for n in (len(w), *w.encode())] and sizes.tolist() == [len(w) + 1 for w in words]
    assert made.count(b"a") == 1 and made.count(b"bb") == 2 and made.count(b"x" * 300) == 2


def test_spans_of_one_hash_are_told_apart():
    cache = SpanCache(lambda new: [list(p) for p in new], np.zeros(256, np.uint64))  # equal lengths collide
    data, at = rows(["abc", "abd"])
    for i in (0, 1, 0):
        cache.values = np.arange(256, dtype=np.uint64) << np.uint64(8 * i)  # other hashes and heads
        numbers, _ = cache.gather(cache.find(data, at[i : i + 1], at[i + 1 : i + 2]))
        assert bytes(numbers.tolist()) == (b"abc", b"abd")[i]


def test_counts(docs_of, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "repeat"), (3, "repeat")]
    got = token_counts(docs_of(rows), PATH, limit=3).collect()
    want = [(i, len((t or "").encode()), len(ids_of(library, t)), len(ids_of(library, t)) > 3) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_counts_of_nothing(docs_of):
    assert token_counts(docs_of([], 1), PATH, limit=3).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 13, 16, 17, 20, 32])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1000, dtype=np.uint64).astype(np.uint32)
    packed = pack(ids, bits)
    assert len(packed) == (1000 * bits + 7) // 8
    for low, high in ((0, 1000), (0, 0), (999, 1000), (17, 400), (400, 401)):
        assert (unpack(packed, bits, low, high) == ids[low:high]).all()


def test_width():
    assert [width(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def test_files(spark, docs_of, library, tmp_path):
    rows = [(100 - i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (None, None), (3, "repeat"), (3, "repeat"), (3, "other")]
    write_token_files(docs_of(rows), PATH, str(tmp_path / "t"))
    got = read_token_files(spark, str(tmp_path / "t")).collect()
    want = [(i, [*ids_of(library, t), 0]) for i, t in rows]
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(
        (repr(i), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want
    )
    # In the order of the ids, nulls first, every start is where the documents before it end.
    inorder = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in inorder] == [0, *np.cumsum([r["n_tokens"] for r in inorder]).tolist()[:-1]]
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in inorder]
    assert keys == sorted(keys)
    back = read_ids(spark, str(tmp_path / "t")).collect()
    assert sorted((repr(r["doc_id"]), r["token_ids"]) for r in back) == sorted((repr(i), x) for i, x in want)


def test_files_of_nothing(spark, docs_of, tmp_path):
    write_token_files(docs_of([], 1), PATH, str(tmp_path / "t"))
    assert read_token_files(spark, str(tmp_path / "t")).count() == 0


@pytest.mark.parametrize("max_spans", [200, 1_000_000])
def test_cache_finds_what_a_dictionary_finds(max_spans):
    """Over many batches, while the index grows and while what is rare goes."""
    r = np.random.default_rng(1)
    made = []
    cache = SpanCache(lambda new: made.extend(new) or [[len(p), *p] for p in new], BYTE_VALUE, max_spans=max_spans)
    hits = Counter()
    for _ in range(30):
        spans = [b"%d" % i for i in np.minimum(r.zipf(1.3, 2000), 10**9)] + [b"x" * 300]
        data, ends = np.frombuffer(b"".join(spans), np.uint8), np.cumsum([len(p) for p in spans])
        places = cache.find(data, ends - [len(p) for p in spans], ends)
        numbers, sizes = cache.gather(places)
        assert [bytes(x[1:].astype(np.uint8)) for x in np.split(numbers, np.cumsum(sizes)[:-1])] == spans
        hits.update(spans)
    if max_spans > 200:
        del hits[b"x" * 300]  # too long to be kept
        assert Counter(made) == dict.fromkeys(hits, 1) | {b"x" * 300: 30}
        assert sorted(cache.hits[: cache.n].tolist()) == sorted([*hits.values(), *[1] * 30])
    else:
        assert len(made) > len(set(made)) and cache.n < 2500
