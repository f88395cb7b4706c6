"""Merging the raw table's small files.

Every load adds up to one file per bucket in a folder of its batch. A merge rewrites batches into
a segment: a bucketed table with one file per bucket, sorted by key, in which the batch is an
ordinary column, so that the ledger still counts by it. Segments are packed by size: a merge
takes the smaller ones along as long as they hold no more than twice what it rewrites anyway.
So segments stay few, a row is rewritten a number of times that grows with the logarithm of the
table, and a load that looks for known keys joins a handful of bucketed tables in place.

What counts as merged is one record, written last. Until then readers see the batches where they
were; the folder that later batches go to is emptied before it is named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.schema import RAW_SCHEMA
from rollcall.sources.warehouse import MERGES, SLOTS, Warehouse, attach_raw, bucket_count, last_merge, raw_folder


def chosen(segments: dict[str, tuple[int, list[str]]], rows: int) -> list[str]:
    """The segments that a merge of ``rows`` rows takes along, smallest first."""
    taken = []
    for name, (n_rows, _) in sorted(segments.items(), key=lambda s: (s[1][0], s[0])):
        if n_rows > 2 * rows:
            break
        taken.append(name)
        rows += n_rows
    return taken


def merge_batches(spark: SparkSession, wh: Warehouse) -> str | None:
    """Rewrite all batches loaded since the last merge into a segment; gives its name.

    The rewritten rows are shuffled once, into buckets; nothing else is read. Run it when no
    load is running. The files of what was merged stay until the next merge needs their folder.
    """
    last, buckets = last_merge(spark, wh), bucket_count(spark, wh.raw_table)
    recent = _files(spark, raw_folder(wh, last.generation))
    counted = recent.groupBy("source_file_hash").agg(F.count("*").alias("n")).collect()
    if not counted:
        return None
    taken = chosen(last.segments, sum(r["n"] for r in counted))
    rows = recent
    for name in taken:
        rows = rows.unionByName(_files(spark, wh.folder(wh.raw, name)))
    name = f"voters_segment_{last.number + 1}"
    _write_segment(spark, wh, rows, name, buckets)
    # The batches' next folder is empty before any record names it.
    generation = last.generation + 1
    nothing = spark.createDataFrame([], RAW_SCHEMA)
    nothing.write.mode("overwrite").partitionBy("source_file_hash").parquet(raw_folder(wh, generation))
    segments = {s: v for s, v in last.segments.items() if s not in taken}
    batches = {r["source_file_hash"] for r in counted}.union(*(last.segments[s][1] for s in taken))
    segments[name] = (sum(r["n"] for r in counted) + sum(last.segments[s][0] for s in taken), sorted(batches))
    record = [(last.number + 1, generation, s, n, b) for s, (n, b) in segments.items()]
    slot = f"{wh.merges_folder}/slot={(last.number + 1) % SLOTS}"
    spark.createDataFrame(record, MERGES).coalesce(1).write.mode("overwrite").parquet(slot)
    attach_raw(spark, wh, buckets, last_merge(spark, wh))
    for old in taken:
        nothing.write.mode("overwrite").parquet(wh.folder(wh.raw, old))
    return name


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of a folder, read as plain files: as bucketed tables they would seem to be placed
    already, and the writing tasks would each hold some of every bucket."""
    return spark.read.schema(RAW_SCHEMA).parquet(folder)


def _write_segment(spark: SparkSession, wh: Warehouse, rows: DataFrame, name: str, buckets: int) -> None:
    table = wh.table(wh.raw, name)
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # of an attempt that was not recorded
    placed = rows.repartition(buckets, "id")  # each task holds one bucket and writes its one file
    writer = placed.write.mode("overwrite").format("parquet").bucketBy(buckets, "id").sortBy("id")
    writer.option("path", wh.folder(wh.raw, name)).saveAsTable(table)
