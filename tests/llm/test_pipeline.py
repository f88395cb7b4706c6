"""Each stage of the pipeline against a plain version of its decision, on its own input."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_near_duplicates import brute
from tokenizers import Tokenizer

import corpus_pipeline
from rollcall.llm.common import table
from rollcall.llm.quality import quality_scores
from rollcall.session import new_scratch_path

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What goes into each stage, and what comes out of the last."""
    docs, out = table(spark, SF, "documents"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*out, docs]


def rows_of(df):
    return Counter(tuple(r) for r in df.select(COLUMNS).collect())


def test_columns(kept):
    assert kept[1].columns == kept[2].columns == kept[3].columns == COLUMNS
    assert kept[4].columns == [*COLUMNS, "mix_position"]


def test_quality(spark, kept):
    good = {r["doc_id"] for r in quality_scores(kept[0], table(spark, SF, "labels")).collect() if r["predicted"]}
    assert rows_of(kept[1]) == Counter({r: n for r, n in rows_of(kept[0]).items() if r[0] in good})
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    left = [labels[r[0]] for r in rows_of(kept[1]) if r[0] in labels]
    assert np.mean(left) > 0.97 and len(left) >= 0.97 * sum(labels.values())


def test_one_copy(kept):
    rows = [(r["doc_id"], r["text"]) for r in kept[1].collect()]
    first = {i for i, n, c in brute(rows) if i == c or n == 0}
    assert rows_of(kept[2]) == Counter({r: n for r, n in rows_of(kept[1]).items() if r[0] in first})
    assert len(first) < len(rows)


def test_benchmark(spark, kept):
    plain = lambda t: " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower()))
    items = [plain(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    leaked = {r["doc_id"] for r in kept[2].collect() if any(i in plain(r["text"]) for i in items)}
    assert leaked and rows_of(kept[3]) == Counter({r: n for r, n in rows_of(kept[2]).items() if r[0] not in leaked})


def test_mix_keeps_all(kept):
    assert rows_of(kept[4]) == rows_of(kept[3])
    places = [r["mix_position"] for r in kept[4].collect()]
    assert len(set(places)) == len(places)


def test_tokens_are_in_the_order_of_the_mix(kept):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, want = 0, []
    for r in sorted(kept[4].collect(), key=lambda r: r["mix_position"]):
        ids = [*library.encode(r["text"], add_special_tokens=False).ids, 0]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted((tuple(r) for r in kept[5].select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])
    assert got == want


def test_run(spark, kept):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, kept[5].collect()))


def test_stages_on_no_documents_and_on_odd_ones(spark):
    schema = table(spark, SF, "documents").schema
    odd = [(None, None, None, None, None), (None, "", "en", "s", 0), (1, None, "en", None, None), (2, "a b c d e f", "en", "s", 11), (2, "a b c d e f", "en", "s", 11), (3, "A b c d e f", "xx", "s", 11)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= len(rows)
    one = corpus_pipeline.keep_one_copy(spark, spark.createDataFrame(odd, schema), SF)
    assert sorted(((r["doc_id"], r["text"]) for r in one.collect()), key=repr) == [(1, None), (2, "a b c d e f"), (None, ""), (None, None)]


WORDS = [" ".join(f"{w}{k}" for k in range(60)) for w in "pqrs"]


def one_copy(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)], table(spark, SF, "documents").schema)
    out = corpus_pipeline.keep_one_copy(spark, docs.repartition(3), SF)
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)


def test_rows_that_share_an_id_are_told_apart_by_their_texts(spark):
    rows = [(1, WORDS[0]), (1, WORDS[1]), (2, WORDS[2])]
    assert one_copy(spark, rows) == sorted(rows, key=repr)
    assert one_copy(spark, [*rows, (1, WORDS[2]), (3, WORDS[1]), (1, WORDS[0])]) == sorted([(1, WORDS[0]), (1, WORDS[1]), (1, WORDS[2])], key=repr)
    assert one_copy(spark, [(7, None), (7, WORDS[3]), (7, "")]) == sorted([(7, None), (7, WORDS[3]), (7, "")], key=repr)


def test_copies_without_id_go_too(spark):
    assert one_copy(spark, [(None, WORDS[0]), (None, WORDS[0] + " end"), (None, WORDS[1])]) in (
        sorted([(None, WORDS[0]), (None, WORDS[1])], key=repr), sorted([(None, WORDS[0] + " end"), (None, WORDS[1])], key=repr)
    )
    assert one_copy(spark, [(None, WORDS[0]), (9, WORDS[0] + " end")]) == [(9, WORDS[0] + " end")]


CLASHING = ["b", "s", "c", "before", "length", "c_i", "t_slot", "begin", "mix_source", "mix_rank", "kept_id", "copy_number", "row", "document", "sig", "n_shingles", "component_id", "part"]


def test_extra_columns_of_any_name_pass_through_every_stage(spark):
    base = table(spark, SF, "documents").where("doc_id < 60")
    wide = base.select("*", *(F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in CLASHING))
    docs = wide
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert set(docs.columns) <= set(out.columns)
        path = new_scratch_path(spark, "stage-test")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        for r in docs.collect():
            assert [r[c] for c in CLASHING] == [f"{c}-{r['doc_id']}" for c in CLASHING]
    assert docs.count() > 20
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
