"""The check report kept by batch.

Three things are kept of the batches that were checked: the numbers of failing rows (by
registration date, as one check depends on the day it is made), the number of rows of every key,
and the keys that were found more than once. A new batch is read, its keys are looked up among the
counted ones, and its numbers are added; the layers themselves are not read again.

Key counts lie in a few segments, tables bucketed by key. A batch becomes a segment of its own,
or takes along those that hold no more than twice its keys, so segments stay few and a key is
rewritten a number of times that grows with the logarithm of their number. No segment is shuffled
in order to look keys up: a small batch is sent to it, a large one is bucketed like it.

What counts is one record, written last. Until then the previous state is valid, and none of its
files is overwritten.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.plans.layers import stage
from rollcall.plans.quality import is_future, lasting_checks, report_of_totals, staged_checks
from rollcall.plans.refresh import pending_rows
from rollcall.schema import CLEANED_SCHEMA
from rollcall.session import new_scratch_path
from rollcall.sources.merging import chosen
from rollcall.sources.warehouse import (
    CLEANED,
    Warehouse,
    attach_bucketed,
    bucket_count,
    by_batch,
    ensure_tables,
    last_run,
    raw_batches,
    read_mart,
    stored_rows,
)

# A row per batch (``amount`` is the run that cleaned it) and per segment (its number of keys).
STATE = "number long, kind string, name string, amount long"
BATCH, SEGMENT = "batch", "segment"
KEY_COUNTS = "voter_id string, n_staged long, n_cleaned long"
REPEATS = "voter_id string, in_staged boolean, in_cleaned boolean"


def counters() -> list[str]:
    return [*(c.name for c in staged_checks() + lasting_checks()), "staged_rows", "cleaned_rows"]


def cells_schema() -> str:
    return ", ".join(["registered_date date", *(f"{c} long" for c in counters())])


def summed_counters() -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters()]


@dataclass(frozen=True)
class CheckState:
    number: int = 0
    batches: dict[str, int] = field(default_factory=dict)
    segments: dict[str, int] = field(default_factory=dict)


def _folder(wh: Warehouse, name: str) -> str:
    return wh.folder(wh.metadata, f"checks/{name}")


def last_state(spark: SparkSession, wh: Warehouse) -> CheckState:
    rows = stored_rows(spark, _folder(wh, "states"), STATE)
    newest = max((r["number"] for r in rows), default=0)
    mine = [r for r in rows if r["number"] == newest]
    kinds = {k: {r["name"]: r["amount"] for r in mine if r["kind"] == k} for k in (BATCH, SEGMENT)}
    return CheckState(newest, kinds[BATCH], kinds[SEGMENT])


def cells_of(staged: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Failing rows and all rows. Staged ones have no date; there are as many rows as dates."""
    on_staged = staged.agg(
        *(F.count_if(c.fails).alias(c.name) for c in staged_checks()), F.count("*").alias("staged_rows")
    )
    on_cleaned = cleaned.groupBy("registered_date").agg(
        *(F.count_if(c.fails).alias(c.name) for c in lasting_checks()), F.count("*").alias("cleaned_rows")
    )
    return on_cleaned.unionByName(on_staged, allowMissingColumns=True)


def merged_cells(cells: DataFrame) -> DataFrame:
    return cells.groupBy("registered_date").agg(*summed_counters())


def key_counts(staged: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows of each key in both layers, counted map-side first."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    rows = staged.select("voter_id", one.alias("n_staged"), none.alias("n_cleaned")).unionByName(
        cleaned.select("voter_id", none.alias("n_staged"), one.alias("n_cleaned"))
    )
    return added(rows.where(F.col("voter_id").isNotNull()))


def added(counts: DataFrame) -> DataFrame:
    return counts.groupBy("voter_id").agg(
        F.sum("n_staged").alias("n_staged"), F.sum("n_cleaned").alias("n_cleaned")
    )


def new_repeats(counted: DataFrame, segments: Sequence[DataFrame]) -> DataFrame:
    """Keys of ``counted`` that have more than one row together with the segments.

    A segment gives only the counts of keys that are asked for, so what is added up afterwards
    is of the batch's size.
    """
    asked = counted.select("voter_id")
    every = counted
    for segment in segments:
        every = every.unionByName(segment.join(asked, "voter_id"))
    marked = added(every).select(
        "voter_id", (F.col("n_staged") > 1).alias("in_staged"), (F.col("n_cleaned") > 1).alias("in_cleaned")
    )
    return marked.where("in_staged OR in_cleaned")


def merged_repeats(repeats: DataFrame) -> DataFrame:
    return repeats.groupBy("voter_id").agg(
        F.bool_or("in_staged").alias("in_staged"), F.bool_or("in_cleaned").alias("in_cleaned")
    )


def _segment(spark: SparkSession, wh: Warehouse, name: str) -> DataFrame:
    table = wh.table(wh.metadata, f"key_counts_{name}")
    buckets = bucket_count(spark, wh.raw_table)
    return attach_bucketed(spark, table, KEY_COUNTS, _folder(wh, f"keys/{name}"), "voter_id", buckets)


def _kept(spark: SparkSession, wh: Warehouse, name: str, number: int, schema: str) -> DataFrame:
    if not number:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_folder(wh, f"{name}/v{number % 2}"))


def _write_segment(spark: SparkSession, wh: Warehouse, name: str, counts: DataFrame) -> int:
    table, buckets = wh.table(wh.metadata, f"key_counts_{name}"), bucket_count(spark, wh.raw_table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    placed = counts.repartition(buckets, "voter_id").write.mode("overwrite").format("parquet")
    bucketed = placed.bucketBy(buckets, "voter_id").sortBy("voter_id")
    bucketed.option("path", _folder(wh, f"keys/{name}")).saveAsTable(table)
    return spark.table(table).count()


def update_state(spark: SparkSession, wh: Warehouse) -> CheckState:
    """Take in the batches of the newest run that were not checked yet.

    If a batch that was checked has since been cleaned again, all batches are checked anew.
    """
    written = last_run(spark, wh).batches.get(CLEANED, {})
    kept = last_state(spark, wh)
    last = kept
    if any(written.get(b) != n for b, n in kept.batches.items()):
        last = CheckState()
    fresh = {b: n for b, n in written.items() if b not in last.batches}
    if last is kept and not fresh:
        return kept
    number, folders = kept.number + 1, f"v{(kept.number + 1) % 2}"
    staged, cleaned = stage(pending_rows(spark, wh, set(fresh))), by_batch(spark, wh.cleaned_folder, fresh, CLEANED_SCHEMA)

    cells = _kept(spark, wh, "cells", last.number, cells_schema()).unionByName(cells_of(staged, cleaned))
    merged_cells(cells).coalesce(1).write.mode("overwrite").parquet(_folder(wh, f"cells/{folders}"))

    noted = new_scratch_path(spark, "keys")
    key_counts(staged, cleaned).write.parquet(noted)
    counted = spark.read.schema(KEY_COUNTS).parquet(noted)
    found = new_repeats(counted, [_segment(spark, wh, s) for s in last.segments])
    repeats = _kept(spark, wh, "repeats", last.number, REPEATS).unionByName(found)
    merged_repeats(repeats).write.mode("overwrite").parquet(_folder(wh, f"repeats/{folders}"))

    taken = chosen({s: (n, []) for s, n in last.segments.items()}, counted.count())
    name = next(f"s{i}" for i in count() if f"s{i}" not in kept.segments)
    whole = counted
    for segment in taken:
        # As plain files: their buckets would otherwise seem to be those of the new segment.
        whole = whole.unionByName(spark.read.schema(KEY_COUNTS).parquet(_folder(wh, f"keys/{segment}")))
    n_keys = _write_segment(spark, wh, name, added(whole) if taken else whole)

    segments = {s: n for s, n in last.segments.items() if s not in taken} | {name: n_keys}
    state = CheckState(number, last.batches | fresh, segments)
    rows = [(number, BATCH, b, n) for b, n in state.batches.items()]
    rows += [(number, SEGMENT, s, n) for s, n in segments.items()]
    record = spark.createDataFrame(rows, STATE).coalesce(1)
    record.write.mode("overwrite").parquet(_folder(wh, f"states/slot={number % 2}"))
    return state


def run_checks_by_batch(spark: SparkSession, wh: Warehouse, as_of: dt.date | str) -> DataFrame:
    """The report of ``run_checks``, for the price of the batches that no earlier one has read.

    Batches in the raw table that no run has cleaned yet are counted as staged records, each
    time until a run has cleaned them. A cleaned layer that was published as a whole is not kept
    by batch and is refused. One check at a time per warehouse.
    """
    ensure_tables(spark, wh)
    if (wh.intermediate, CLEANED) in last_run(spark, wh).tables:
        raise ValueError("the cleaned layer is not kept by batch: use run_checks")
    state = update_state(spark, wh)
    cells = _kept(spark, wh, "cells", state.number, cells_schema())
    repeats = _kept(spark, wh, "repeats", state.number, REPEATS)
    waiting = raw_batches(spark, wh) - set(state.batches)
    if waiting:
        staged, none = stage(pending_rows(spark, wh, waiting)), spark.createDataFrame([], CLEANED_SCHEMA)
        cells = cells.unionByName(cells_of(staged, none))
        segments = [_segment(spark, wh, s) for s in state.segments]
        repeats = merged_repeats(repeats.unionByName(new_repeats(key_counts(staged, none), segments)))
    future = F.sum(F.when(is_future("registered_date", as_of), F.col("cleaned_rows")))
    totals = cells.agg(
        *summed_counters(),
        F.coalesce(future, F.lit(0)).alias("cleaned_not_future_registered_date"),
    )
    unique = repeats.agg(
        F.count_if("in_staged").alias("staged_unique_voter_id"),
        F.count_if("in_cleaned").alias("cleaned_unique_voter_id"),
    )
    return report_of_totals([totals, unique], read_mart(spark, wh, "registration_trends"), as_of)
