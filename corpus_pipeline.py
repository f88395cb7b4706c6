"""A corpus from documents to token files, in five stages of Spark jobs.

Every stage reads what its predecessor kept. All but the last return the columns of
``documents``; mixing adds ``mix_position``, by which the token files are ordered.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import decontaminate, mixing, near_duplicates, quality, token_files
from rollcall.llm.common import ship_package, table
from rollcall.session import new_scratch_path

TOKENIZER = "byte_bpe_50k.json"
POSITION = "mix_position"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship_package(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, that of the smallest id.

    Rows are told apart by a number that is written with them, so rows that share an id, or have
    none, are compared by their texts like any others. Among equal ids the text's hash and then
    the number decide; a row without id stays only where no row of its group has one. Rows
    without words are in no group and stay.
    """
    ship_package(spark)
    path = new_scratch_path(spark, "numbered")
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document")
    docs.select(whole, F.monotonically_increasing_id().alias("row")).write.parquet(path)
    numbered = spark.read.parquet(path)
    id_ = F.col("document.doc_id")
    name = F.struct(id_.isNull().alias("nameless"), id_.alias("doc_id"), F.xxhash64("document.text").alias("tie"), "row")
    groups = near_duplicates.near_duplicates(numbered.select(name.alias("doc_id"), F.col("document.text").alias("text")))
    kept = groups.where((F.col("n_shingles") == 0) | (F.col("doc_id") == F.col("component_id"))).select(F.col("doc_id.row").alias("row"))
    left = numbered.join(kept, "row", "left_semi")
    return left.select(*(F.col(f"document.`{c}`").alias(c) for c in docs.columns))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship_package(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its place in a mix of the sources by the square root of their sizes.

    Documents travel as one column, so their columns may have any names; only one called
    ``mix_position`` is replaced.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document")
    mixed = mixing.mix_sources(docs.select("doc_id", "source", whole))
    return mixed.select(*(F.col(f"document.`{c}`").alias(c) for c in docs.columns if c != POSITION), POSITION)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mix, and per document what they hold."""
    ship_package(spark)
    path = new_scratch_path(spark, "corpus-tokens")
    order = (POSITION,) if POSITION in docs.columns else ("doc_id",)
    token_files.write_token_files(docs, public_tokenizers.path(TOKENIZER), path, order=order)
    return token_files.read_token_files(spark, path)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_copy),
    ("benchmark decontamination", drop_benchmark),
    ("mixing sources", mix),
    ("token files", to_tokens),
]

#: The classifier's and the tokenizer's results are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_scratch_path(spark, "corpus-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
