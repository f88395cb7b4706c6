"""The check report kept by batch against the one over whole layers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_load import SF_DIR, TIMES, load

from rollcall import fixture
from rollcall.plans import batch_checks, refresh
from rollcall.session import new_scratch_path
from rollcall.sources import csv, warehouse


@pytest.fixture
def wh(spark):
    root = new_scratch_path(spark, "wh")
    return warehouse.Warehouse(root, prefix=f"c{root[-8:]}_")


def report(df):
    return sorted(map(tuple, df.collect()))


def same_reports(spark, wh, as_of=fixture.AS_OF):
    found = report(batch_checks.run_checks_by_batch(spark, wh, as_of))
    assert found == report(refresh.run_checks(spark, wh, as_of))
    return {r[0]: r[2] for r in found}


def refreshed(spark, wh, tmp_path, day, rows, **options):
    path = str(tmp_path / f"day{day}")
    csv.write_extract(rows, path)
    return refresh.run_refresh(spark, wh, path, TIMES[day], **options)


def test_reports_by_batch_equal_whole_reports(spark, wh, tmp_path):
    registry = fixture.extract(spark, SF_DIR)
    number = F.trim("id").cast("bigint")
    blank = F.concat("id", F.lit(" "))
    days = [
        registry.where(number % 2 == 0),
        registry.where(number <= 10).withColumn("id", blank),  # known keys, spelled otherwise
        registry,
        registry.where(number <= 20).withColumn("id", F.concat(blank, F.lit(" "))),
    ]
    repeated = []
    for day, rows in enumerate(days):
        refreshed(spark, wh, tmp_path, day, rows)
        totals = same_reports(spark, wh)
        assert totals["staged_unique_voter_id"] == totals["cleaned_unique_voter_id"]
        repeated.append(totals["staged_unique_voter_id"])
        assert batch_checks.last_state(spark, wh).number == day + 1
    assert repeated == [0, 6, 11, 21]  # ids begin at 0
    # Nothing new: nothing is read, and the day of the check still counts.
    same_reports(spark, wh, "2016-06-01")
    state = batch_checks.last_state(spark, wh)
    assert state.number == 4 and len(state.segments) < 4 and sum(state.segments.values()) >= 150
    # Another session finds the state; other age limits clean all batches again.
    later = warehouse.Warehouse(wh.root, prefix=f"later_{wh.prefix}")
    warehouse.ensure_tables(spark, later)
    refresh.rebuild_layers(spark, later, TIMES[4], 30, 40)
    same_reports(spark, later)
    assert batch_checks.last_state(spark, later).number == 5


def test_batches_that_no_run_has_cleaned_and_failed_updates(spark, wh, tmp_path, monkeypatch):
    registry = fixture.extract(spark, SF_DIR)
    refreshed(spark, wh, tmp_path, 0, fixture.base_batch(registry))
    assert same_reports(spark, wh)["cleaned_equal_rowcount"] == 0
    load(spark, wh, registry.withColumn("id", F.concat("id", F.lit("  "))), "waiting")
    totals = same_reports(spark, wh)
    assert (totals["cleaned_equal_rowcount"], totals["staged_unique_voter_id"]) == (150, 112)
    assert totals["cleaned_unique_voter_id"] == 0
    refresh.rebuild_layers(spark, wh, TIMES[1])

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(batch_checks, "_write_segment", lost)
        with pytest.raises(RuntimeError):
            batch_checks.run_checks_by_batch(spark, wh, fixture.AS_OF)
    assert batch_checks.last_state(spark, wh).number == 1
    totals = same_reports(spark, wh)
    assert totals["cleaned_unique_voter_id"] == 112 and totals["cleaned_equal_rowcount"] == 0


def test_a_batch_reads_itself_and_its_keys(spark, wh, tmp_path, capsys):
    registry = fixture.extract(spark, SF_DIR)
    refreshed(spark, wh, tmp_path, 0, registry)
    batch_checks.update_state(spark, wh)
    counted = spark.createDataFrame([("1", 1, 1), ("x", 1, 1)], batch_checks.KEY_COUNTS)
    segment = batch_checks._segment(spark, wh, "s0")
    assert batch_checks.new_repeats(counted, [segment]).collect() == [("1", True, True)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = segment.join(counted.select("voter_id"), "voter_id")
        capsys.readouterr()
        joined.explain()
        text = capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange, of the batch; the segment stays where it is.
    assert text.count("Exchange hashpartitioning") == 1 and "key_counts_s0" in text


def test_a_layer_published_as_a_whole_is_refused(spark, wh, tmp_path):
    refreshed(spark, wh, tmp_path, 0, fixture.extract(spark, SF_DIR))
    warehouse.publish(spark, wh, warehouse.read_cleaned(spark, wh), wh.intermediate, warehouse.CLEANED)
    with pytest.raises(ValueError, match="run_checks"):
        batch_checks.run_checks_by_batch(spark, wh, fixture.AS_OF)
