"""The thin queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (
    chat, decontaminate, filter_audit, language_model, mixing, near_duplicates, packing, quality, substrings, token_counts, token_files, topk,
    vector_codes,
)
from rollcall.llm.common import ship_package, table
from rollcall.session import new_scratch_path

TOKENIZER = "byte_bpe_50k.json"
PACKING_TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


@query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), path)
    return token_files.read_token_files(spark, path)


@query
def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=512)


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return mixed.select("doc_id", "source", *mixing.ADDED)


@query
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = chat.rotate_perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return rendered.withColumn("mask", F.concat_ws(",", spans))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated_runs(table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch_path(spark, "packed")
    packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_TOKENIZER), path)
    return packing.read_pieces(spark, path)


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, _ = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return coded
