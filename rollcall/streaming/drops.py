"""The append-only load over a drop folder: as a stream, or by the folder's listing."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollcall.plans.refresh import load_batch
from rollcall.session import new_scratch_path
from rollcall.sources.csv import csv_scan, csv_stream
from rollcall.sources.fingerprint import content_fingerprint
from rollcall.sources.ledger import audit_record, stamp_batch
from rollcall.sources.listing import (
    NEW,
    REWRITTEN,
    SAME,
    file_changes,
    keep_listing,
    last_number,
    read_listing,
)
from rollcall.sources.warehouse import Warehouse, append_rows, ensure_tables, read_raw


def load_micro_batch(
    spark: SparkSession, wh: Warehouse, batch: DataFrame, run_ts: str, source: str, ingestion_id: str,
    key_mode: str = "abort", number: int | None = None,
) -> None:
    """Load one micro-batch and record it.

    A micro-batch may be replayed after a failure. Its keys are then already in the raw
    table and its ledger row carries the same id, so nothing is loaded or recorded twice.
    A ``number`` goes into the batch's hash, so that the same records may come again as
    another batch with a ledger row of its own.
    """
    profile = content_fingerprint(batch).first()
    if not profile["file_row_count"]:
        return
    file_hash = profile["file_hash"]
    if number is not None:
        file_hash = hashlib.sha256(f"{number}:{file_hash}".encode()).hexdigest()
    load_batch(spark, wh, stamp_batch(batch, run_ts, file_hash), key_mode)
    ledger = spark.table(wh.ledger_table)
    if not ledger.where(F.col("ingestion_id") == ingestion_id).isEmpty():
        return
    record = audit_record(
        read_raw(spark, wh),
        file_hash,
        source,
        profile["file_row_count"],
        run_ts,
        ingestion_id=ingestion_id,
    )
    append_rows(spark, record, wh.ledger_table)


def stream_load_unseen(
    spark: SparkSession,
    wh: Warehouse,
    folder: str,
    checkpoint: str,
    run_ts: str,
    columns: list[str] | None = None,
    max_files: int | None = None,
    multi_line: bool = False,
    buckets: int | None = None,
    key_mode: str = "abort",
) -> StreamingQuery:
    """Load every file dropped since the last run, then stop. ``key_mode`` is the key guard's.

    A micro-batch is parsed once, into scratch parquet, which the fingerprint, the guard
    and the load read.

    A file that is rewritten under its old name is not seen again by a file stream; that
    case belongs to ``load_changed_files``.
    """
    ensure_tables(spark, wh, buckets)
    stream_id = uuid.uuid5(uuid.NAMESPACE_URL, f"{checkpoint}|{folder}")

    def load(batch: DataFrame, batch_id: int) -> None:
        ingestion_id = str(uuid.uuid5(stream_id, str(batch_id)))
        session = batch.sparkSession
        parsed = new_scratch_path(session, "parsed")
        batch.write.parquet(parsed)
        load_micro_batch(session, wh, session.read.parquet(parsed), run_ts, folder, ingestion_id, key_mode)

    source = csv_stream(spark, folder, columns, max_files, multi_line)
    return (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_changed_files(
    spark: SparkSession,
    wh: Warehouse,
    folder: str,
    run_ts: str,
    verify: bool = False,
    multi_line: bool | None = None,
    buckets: int | None = None,
    key_mode: str = "abort",
) -> dict[str, int]:
    """Load the files that are new or were rewritten since the last run; gives files by change.

    The others are not read. Records whose key is known are not loaded again, so a rewritten file
    adds its new keys, and a removed file takes nothing away. Every run that loads has a ledger
    row, also when a file went back to bytes that it had before.

    The listing is kept last. A run that fails before it is done again over the same changes,
    with the same number: nothing is loaded or recorded twice.
    """
    ensure_tables(spark, wh, buckets)
    number = last_number(spark, wh, folder) + 1
    judged = new_scratch_path(spark, "changes")
    file_changes(spark, folder, read_listing(spark, wh, folder), verify).write.parquet(judged)
    changes = spark.read.parquet(judged)
    by_change = {r["change"]: r["count"] for r in changes.groupBy("change").count().collect()}
    if not set(by_change) - {SAME}:
        return by_change
    to_load = changes.where(F.col("change").isin(NEW, REWRITTEN))
    paths = [r["path"] for r in to_load.select("path").collect()]
    if paths:
        parsed = new_scratch_path(spark, "parsed")
        csv_scan(spark, paths, multi_line).write.parquet(parsed)
        name = f"{folder.rstrip('/')}|{number}"
        ingestion_id = str(uuid.uuid5(uuid.NAMESPACE_URL, name))
        batch = spark.read.parquet(parsed)
        load_micro_batch(spark, wh, batch, run_ts, folder, ingestion_id, key_mode, number)
    keep_listing(spark, wh, folder, changes, number)
    return by_change
