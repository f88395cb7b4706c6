"""The daily run: load what is new, bring the layers up to date, record it.

The cleaned layer and the cells that marts are made of are kept by batch. A run cleans and counts
the batches that no earlier run has, and makes the marts from the cells of all batches, so its
cost follows the new batch and the number of cells, not the number of records.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.operators.keys import key_guard, load_unseen_keys
from rollcall.plans.layers import clean, stage
from rollcall.plans.marts import (
    CELL_MARTS,
    TOTALS_SCHEMA,
    dq_summary_of_cells,
    merged_cells,
    total_cells,
)
from rollcall.plans.quality import check_report
from rollcall.schema import CLEANED_SCHEMA, MAX_AGE, MIN_AGE
from rollcall.session import new_scratch_path
from rollcall.sources.csv import csv_scan, source_row_count
from rollcall.sources.fingerprint import content_fingerprint
from rollcall.sources.ledger import audit_record, change_gate, stamp_batch
from rollcall.sources.splits import byte_fingerprint
from rollcall.sources.warehouse import (
    CLEANED,
    KEPT_RUNS,
    MART_TABLES,
    Run,
    Warehouse,
    append_rows,
    bucket_count,
    by_batch,
    commit_run,
    ensure_tables,
    kept_runs,
    raw_batches,
    raw_tables,
    read_cleaned,
    read_mart,
    read_raw,
    together,
    write_version,
)


@dataclass(frozen=True)
class RunResult:
    file_hash: str
    file_row_count: int
    loaded: bool


def load_batch(spark: SparkSession, wh: Warehouse, stamped: DataFrame, mode: str = "abort") -> None:
    """Append the rows of the batch whose keys the raw table does not hold yet.

    The guard counts keys only; ``mode`` is the guard's: refuse repeated keys, or keep one row
    of each. Then the batch is shuffled once, by key into the buckets of the raw table: the
    joins find their partner bucket in place, in the loaded batches and in every merged
    segment, and each task writes the file of one bucket. The table itself is never shuffled.
    """
    loadable = key_guard(stamped, read_raw(spark, wh), mode=mode)
    unseen = loadable.repartition(bucket_count(spark, wh.raw_table), "id")
    for part in raw_tables(spark, wh):
        unseen = load_unseen_keys(unseen, spark.table(part), nullable=False)
    append_rows(spark, unseen, wh.raw_table)


def read_staged(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The staged layer over the raw table. It is not stored, so any session can read it."""
    return stage(read_raw(spark, wh))


def cells_folder(wh: Warehouse, name: str) -> str:
    return wh.folder(wh.metadata, f"cells_{name}")


def pending_batches(
    spark: SparkSession, wh: Warehouse, last: Run, settings: str, batch: str | None
) -> set[str]:
    """Batches that the last run has not cleaned with these settings, and ``batch`` in any case,
    which may have got rows that an earlier attempt did not load."""
    loaded = raw_batches(spark, wh)
    if last.settings != settings:
        return loaded
    return {b for b in loaded if b not in last.batches.get(CLEANED, {}) or b == batch}


def pending_rows(spark: SparkSession, wh: Warehouse, pending: set[str]) -> DataFrame:
    """Their raw rows. The batch is a folder of the raw table, so others are not read."""
    return read_raw(spark, wh).where(F.col("source_file_hash").isin(*sorted(pending)))


def rebuild_layers(
    spark: SparkSession,
    wh: Warehouse,
    run_ts: str | dt.datetime,
    min_age: int = MIN_AGE,
    max_age: int = MAX_AGE,
    batch: str | None = None,
    whole: bool = False,
) -> None:
    """Staged view, cleaned layer, and every mart, as one run that becomes visible at its end.

    Only pending batches are cleaned and counted; ``processed_at`` says when a record was.
    Other age limits than the last run's, or ``whole``, make all batches pending. Cells are
    written per batch, so a batch that is counted again replaces its own.
    """
    read_staged(spark, wh).createOrReplaceTempView(f"{wh.prefix}staging_voters")
    runs = list(kept_runs(spark, wh).values())[-KEPT_RUNS:]
    last = runs[-1] if runs else Run()
    settings = f"ages {min_age} to {max_age}"
    pending = raw_batches(spark, wh) if whole else pending_batches(spark, wh, last, settings, batch)
    run = last.follow(str(run_ts))
    if last.settings != settings or whole:
        run.batches = {}
        run.tables.pop((wh.intermediate, CLEANED), None)
    run.settings = settings
    names = [*CELL_MARTS, "dq_summary"]
    for name in (CLEANED, *names):
        run.batches.setdefault(name, {})

    def write_batches(rows: DataFrame, folder: str) -> None:
        place = f"{folder}/run={run.number}"
        rows.write.mode("overwrite").partitionBy("source_file_hash").parquet(place)

    if pending:
        raw = pending_rows(spark, wh, pending)
        write_batches(clean(stage(raw), run_ts, min_age, max_age), wh.cleaned_folder)
        mine = dict.fromkeys(pending, run.number)
        cleaned = by_batch(spark, wh.cleaned_folder, mine, CLEANED_SCHEMA)

        def count(name: str) -> None:
            by = ("source_file_hash",)
            cells = CELL_MARTS[name].cells(cleaned, by) if name in CELL_MARTS else total_cells(raw, cleaned, by)
            # A few thousand cells for each batch at most.
            write_batches(cells.coalesce(1), cells_folder(wh, name))

        together(spark, [lambda n=n: count(n) for n in names])
        for name in (CLEANED, *names):
            run.batches[name] |= mine

    nothing = spark.createDataFrame([], CLEANED_SCHEMA)

    def make_mart(name: str) -> None:
        plan = CELL_MARTS.get(name)
        shape = plan.cells(nothing).schema if plan else TOTALS_SCHEMA
        cells = by_batch(spark, cells_folder(wh, name), run.batches[name], shape)
        mart = plan.made_of(merged_cells(cells, plan.keys)) if plan else dq_summary_of_cells(cells)
        write_version(spark, wh, run, mart, wh.marts, MART_TABLES[name], runs)

    together(spark, [lambda n=n: make_mart(n) for n in MART_TABLES])
    commit_run(spark, wh, run)


def run_refresh(
    spark: SparkSession,
    wh: Warehouse,
    source: str,
    run_ts: str | dt.datetime,
    run_id: str | None = None,
    multi_line: bool | None = None,
    min_age: int = MIN_AGE,
    max_age: int = MAX_AGE,
    buckets: int | None = None,
    key_mode: str = "abort",
    whole: bool = False,
    fingerprint: str = "records",
) -> RunResult:
    """One run over an extract, which is parsed once, into scratch parquet.

    Fingerprint and record count read that copy; the guard reads its keys, and the load
    its rows. ``buckets`` is the raw table's, for the run that creates it; ``key_mode`` is the
    key guard's, and ``whole`` cleans and counts all batches again.

    ``fingerprint`` says what makes an extract a new one: its ``records``, in any order, or its
    ``bytes``, which are compared before anything is parsed. Keep to one of them in a warehouse.

    An extract equal to the latest recorded one is skipped and leaves no ledger row. The
    ledger row is written last: a run that fails before it leaves the gate open, and the
    next one loads nothing twice. One run at a time per warehouse.
    """
    if fingerprint not in ("records", "bytes"):
        raise ValueError(f"unknown fingerprint {fingerprint!r}")
    ensure_tables(spark, wh, buckets)
    history = spark.table(wh.ledger_table)
    by_bytes = fingerprint == "bytes"
    if by_bytes:
        gate = change_gate(byte_fingerprint(spark, source), history).first()
        if not gate["is_new"]:
            rows = history.agg(F.max_by("file_row_count", "ingested_at")).first()[0]
            return RunResult(gate["file_hash"], rows, loaded=False)
    parsed = new_scratch_path(spark, "parsed")
    csv_scan(spark, source, multi_line).write.parquet(parsed)
    extract = spark.read.parquet(parsed)
    if by_bytes:
        file_hash, rows = gate["file_hash"], source_row_count(extract).first()[0]
    else:
        gate = change_gate(content_fingerprint(extract), history).first()
        file_hash, rows = gate["file_hash"], gate["file_row_count"]
    if not gate["is_new"]:
        return RunResult(file_hash, rows, loaded=False)
    load_batch(spark, wh, stamp_batch(extract, run_ts, file_hash), key_mode)
    rebuild_layers(spark, wh, run_ts, min_age, max_age, file_hash, whole)
    record = audit_record(read_raw(spark, wh), file_hash, source, rows, run_ts, run_id)
    append_rows(spark, record, wh.ledger_table)
    return RunResult(file_hash, rows, loaded=True)


def run_checks(
    spark: SparkSession, wh: Warehouse, as_of: dt.date | str
) -> DataFrame:
    """The check report over the published tables of a warehouse, in this or a later session."""
    ensure_tables(spark, wh)
    trends = read_mart(spark, wh, "registration_trends")
    return check_report(read_staged(spark, wh), read_cleaned(spark, wh), trends, as_of)
