"""The audit ledger of the loads, and the gate that reads it."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import as_timestamp
from rollcall.schema import LEDGER_SCHEMA

# Ledger states, history length and columns.
LOADED = "success"
NOTHING_LOADED = "no-op"
HISTORY_ROWS = 5
HISTORY_COLUMNS = ("ingestion_id", "file_hash", "load_status", "inserted_row_count", "ingested_at")


def last_audit(ledger: DataFrame) -> DataFrame:
    """One row: the newest hash in any state, NULL for an empty ledger."""
    return ledger.agg(F.max_by("file_hash", "ingested_at").alias("last_hash"))


def last_hash(spark: SparkSession, table: str) -> str | None:
    """The newest hash of a ledger table that may not exist yet."""
    if not spark.catalog.tableExists(table):
        return None
    return last_audit(spark.table(table)).first()["last_hash"]


def is_new(current: Column, last: Column) -> Column:
    return last.isNull() | (current != last)


def change_gate(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each candidate ``file_hash`` against the latest load only, not the whole history."""
    gated = candidates.withColumn("last_hash", last_audit(ledger).scalar())
    return gated.withColumn("is_new", is_new(F.col("file_hash"), F.col("last_hash")))


def stamp_batch(
    batch: DataFrame, run_ts: Column | str | dt.datetime, file_hash: Column | str
) -> DataFrame:
    """Add the load time and the hash, the same for the whole batch."""
    file_hash = file_hash if isinstance(file_hash, Column) else F.lit(file_hash)
    return batch.withColumns(
        {"load_timestamp": as_timestamp(run_ts), "source_file_hash": file_hash}
    )


def audit_record(
    target: DataFrame,
    file_hash: str,
    source_path: str,
    file_row_count: int,
    run_ts: Column | str | dt.datetime,
    run_id: str | None = None,
    ingestion_id: str | None = None,
) -> DataFrame:
    """One ledger row. Counts the rows of the target that carry this hash, whichever
    attempt wrote them, so a repeated attempt reports the same."""
    counted = target.where(F.col("source_file_hash") == file_hash).agg(F.count("*").alias("n"))
    status = F.when(F.col("n") > 0, F.lit(LOADED)).otherwise(F.lit(NOTHING_LOADED))
    return counted.select(
        F.lit(ingestion_id or str(uuid.uuid4())).alias("ingestion_id"),
        F.lit(file_hash).alias("file_hash"),
        F.lit(source_path).alias("source_path"),
        F.lit(file_row_count).cast("bigint").alias("file_row_count"),
        F.col("n").alias("inserted_row_count"),
        status.alias("load_status"),
        F.lit(run_id).cast("string").alias("dag_run_id"),
        as_timestamp(run_ts).alias("ingested_at"),
    ).select(*LEDGER_SCHEMA.fieldNames())


def audit_history(ledger: DataFrame, n: int = HISTORY_ROWS) -> DataFrame:
    return ledger.select(*HISTORY_COLUMNS).orderBy(F.col("ingested_at").desc()).limit(n)
