"""Layers kept by batch, manifests of runs, and merged files of the raw table."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F
from test_load import HEADER, SF_DIR, TIMES, load, loaded, people, write_csv, ledger_rows

from rollcall import fixture
from rollcall.operators import keys
from rollcall.plans import layers, marts, refresh
from rollcall.session import new_scratch_path
from rollcall.sources import csv, ledger, merging, warehouse


@pytest.fixture
def wh(spark):
    root = new_scratch_path(spark, "wh")
    house = warehouse.Warehouse(root, prefix=f"m{root[-8:]}_")
    warehouse.ensure_tables(spark, house)
    return house


def thirds(spark):
    rows = fixture.extract(spark, SF_DIR)
    number = F.trim("id").cast("bigint")
    return [rows.where(number % 3 <= k) for k in range(3)]


def mart_rows(spark, wh, run=None):
    return {n: sorted(map(str, warehouse.read_mart(spark, wh, n, run=run).collect())) for n in warehouse.MART_TABLES}


def full_rows(spark, wh, at):
    raw = warehouse.read_raw(spark, wh)
    cleaned = layers.clean(layers.stage(raw), at)
    made = {n: build(cleaned) for n, build in marts.MARTS.items()}
    made["dq_summary"] = marts.dq_summary(raw, layers.stage(raw), cleaned)
    return {n: sorted(map(str, df.collect())) for n, df in made.items()}


def test_three_days_by_batch_equal_a_full_rebuild(spark, wh, tmp_path):
    hashes = []
    for day, rows in enumerate(thirds(spark)):
        path = str(tmp_path / f"day{day}")
        csv.write_extract(rows, path)
        hashes.append(refresh.run_refresh(spark, wh, path, TIMES[day]).file_hash)
        assert mart_rows(spark, wh) == full_rows(spark, wh, TIMES[day])
        run = warehouse.last_run(spark, wh)
        assert run.number == day + 1 and run.at == TIMES[day]
        assert run.batches["voters_cleaned"] == {h: n for n, h in enumerate(hashes, 1)}
    cleaned = warehouse.read_cleaned(spark, wh)
    assert cleaned.count() == spark.table(wh.cleaned_table).count() == 150
    stamps = {str(r[0]) for r in cleaned.select("processed_at").distinct().collect()}
    assert stamps == set(TIMES[:3])
    # Other limits clean and count everything again.
    refresh.rebuild_layers(spark, wh, TIMES[3], 30, 40)
    run = warehouse.last_run(spark, wh)
    assert set(run.batches["voters_cleaned"].values()) == {4} and set(run.batches["voters_cleaned"]) == set(hashes)
    assert warehouse.read_cleaned(spark, wh).agg(F.min("age"), F.max("age")).first()[:] == (36, 36)


def test_a_new_day_reads_only_its_batch(spark, wh):
    for n, rows in enumerate(thirds(spark)):
        load(spark, wh, rows, f"h{n}")
        if n < 2:
            refresh.rebuild_layers(spark, wh, TIMES[n])
    last = warehouse.last_run(spark, wh)
    pending = refresh.pending_batches(spark, wh, last, last.settings, "h2")
    assert pending == {"h2"}
    plan = refresh.pending_rows(spark, wh, pending)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_file_hash" in plan and "h2)" in plan
    files = glob.glob(f"{wh.cleaned_folder}/run=2/*")
    assert [f.rpartition("=")[2] for f in files if "hash=" in f] == ["h1"]


def test_a_batch_counted_again_replaces_its_cells(spark, wh):
    load(spark, wh, people(spark, "1", "2"), "h1")
    refresh.rebuild_layers(spark, wh, TIMES[0])
    load(spark, wh, people(spark, "2", "3"), "h1")  # what an earlier attempt had not loaded
    refresh.rebuild_layers(spark, wh, TIMES[1], batch="h1")
    assert warehouse.read_mart(spark, wh, "dq_summary").first().raw_count == 3
    assert mart_rows(spark, wh) == full_rows(spark, wh, TIMES[1])
    assert warehouse.read_cleaned(spark, wh).count() == spark.table(wh.cleaned_table).count() == 3


def test_nothing_loaded_gives_empty_marts(spark, wh):
    refresh.rebuild_layers(spark, wh, TIMES[0])
    assert mart_rows(spark, wh) == full_rows(spark, wh, TIMES[0])
    load(spark, wh, people(spark, "1"), "odd name/with=100% 'marks'")
    refresh.rebuild_layers(spark, wh, TIMES[1])
    assert mart_rows(spark, wh) == full_rows(spark, wh, TIMES[1])
    assert spark.table(wh.cleaned_table).count() == warehouse.read_cleaned(spark, wh).count() == 1


def test_a_rebuild_that_fails_at_one_mart_shows_the_whole_old_set(spark, wh, monkeypatch):
    first, second, _ = thirds(spark)
    load(spark, wh, first, "h1")
    refresh.rebuild_layers(spark, wh, TIMES[0])
    before = mart_rows(spark, wh)
    load(spark, wh, second, "h2")
    wrote = refresh.write_version

    def lost(spark, wh, run, df, namespace, name, kept):
        if name == "demographic_crosstab":
            raise RuntimeError("lost")
        wrote(spark, wh, run, df, namespace, name, kept)

    with monkeypatch.context() as m:
        m.setattr(refresh, "write_version", lost)
        with pytest.raises(RuntimeError, match="lost"):
            refresh.rebuild_layers(spark, wh, TIMES[1])
    later = warehouse.Warehouse(wh.root, prefix=f"later{wh.prefix}")
    warehouse.ensure_tables(spark, later)
    for house in (wh, later):
        assert mart_rows(spark, house) == before
        for name in warehouse.MART_TABLES:
            assert sorted(map(str, spark.table(house.mart_table(name)).collect())) == before[name]
        assert warehouse.read_cleaned(spark, house).count() == spark.table(house.cleaned_table).count() == first.count()
    refresh.rebuild_layers(spark, wh, TIMES[1])
    assert mart_rows(spark, wh) == full_rows(spark, wh, TIMES[1]) != before


def test_a_reader_can_name_a_run(spark, wh):
    seen = {}
    for n in range(1, 5):
        load(spark, wh, people(spark, str(n)), f"h{n}")
        refresh.rebuild_layers(spark, wh, TIMES[n - 1])
        seen[n] = mart_rows(spark, wh)
        for old in range(max(1, n - warehouse.KEPT_RUNS + 1), n + 1):
            assert mart_rows(spark, wh, run=old) == seen[old]
            assert warehouse.read_cleaned(spark, wh, run=old).count() == old
    with pytest.raises(ValueError, match="not kept"):
        warehouse.read_mart(spark, wh, "dq_summary", run=1)
    assert len(glob.glob(f"{wh.runs_folder}/slot=*")) <= warehouse.SLOTS


def test_repeated_keys_can_be_kept_once_by_a_run(spark, wh, tmp_path):
    path = write_csv(tmp_path, HEADER + "1,b" + "," * 9 + "\n1,a" + "," * 9 + "\n,c" + "," * 9 + "\n")
    with pytest.raises(Exception, match="repeated"):
        refresh.run_refresh(spark, wh, path, TIMES[0])
    assert refresh.run_refresh(spark, wh, path, TIMES[0], key_mode="dedupe").loaded
    assert loaded(spark, wh) == [("1", "a")] and ledger_rows(spark, wh) == [(3, 1, "success")]


def test_merged_batches_keep_their_hash_and_bound_the_files(spark):
    root = new_scratch_path(spark, "wh")
    wh = warehouse.Warehouse(root, prefix=f"g{root[-8:]}_")
    warehouse.ensure_tables(spark, wh, buckets=3)
    for n in range(30):
        rows = people(spark, *(str(k) for k in range(n * 10, n * 10 + 11)), name=f"run{n}")
        load(spark, wh, rows, f"h{n:02}")
        if n in (3, 9, 29):
            name = merging.merge_batches(spark, wh)
    before = sorted((r.id, r.first_name) for r in warehouse.read_raw(spark, wh).collect())
    assert before == sorted((str(k), f"run{max(0, (k - 1) // 10)}") for k in range(301))
    assert len(glob.glob(f"{wh.folder(wh.raw, name)}/*.parquet")) <= 3
    assert len(warehouse.last_merge(spark, wh).segments) <= 2 and spark.table(wh.raw_table).count() == 0
    later = warehouse.Warehouse(wh.root, prefix=f"later{wh.prefix}")
    warehouse.ensure_tables(spark, later)
    for house in (wh, later):
        target = warehouse.read_raw(spark, house)
        for n in (0, 7, 29):
            record = ledger.audit_record(target, f"h{n:02}", "/x", 11, TIMES[0]).first()
            assert record.inserted_row_count == (11 if not n else 10)
        assert warehouse.raw_batches(spark, house) == {f"h{n:02}" for n in range(30)}
    # A load after the merge finds the merged keys, and adds to what was merged.
    load(spark, later, people(spark, "5", "300", "301", name="new"), "h30")
    assert warehouse.read_raw(spark, later).count() == 302
    refresh.rebuild_layers(spark, later, TIMES[0])
    assert mart_rows(spark, later) == full_rows(spark, later, TIMES[0])
    assert merging.merge_batches(spark, later) and merging.merge_batches(spark, later) is None
    warehouse.ensure_tables(spark, wh)
    assert warehouse.read_raw(spark, wh).count() == 302


def test_a_load_does_not_shuffle_merged_segments(spark, wh):
    load(spark, wh, people(spark, "1", "2"), "h1")
    merging.merge_batches(spark, wh)
    load(spark, wh, people(spark, "3"), "h2")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = ledger.stamp_batch(people(spark, "2", "4"), TIMES[0], "h3")
        unseen = batch.repartition(warehouse.bucket_count(spark, wh.raw_table), "id")
        for part in warehouse.raw_tables(spark, wh):
            unseen = keys.load_unseen_keys(unseen, spark.table(part), nullable=False)
        plan = unseen._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert plan.count("LeftAnti") >= 2 and plan.count("Exchange") == 1
    assert [r.id for r in unseen.collect()] == ["4"]


def test_a_merge_that_fails_changes_nothing(spark, wh, monkeypatch):
    load(spark, wh, people(spark, "1", "2"), "h1")
    with monkeypatch.context() as m:
        m.setattr(merging, "attach_raw", lambda *a: None)
        m.setattr(merging, "raw_folder", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            merging.merge_batches(spark, wh)
    later = warehouse.Warehouse(wh.root, prefix=f"later{wh.prefix}")
    warehouse.ensure_tables(spark, later)
    assert loaded(spark, wh) == loaded(spark, later) == [("1", "A"), ("2", "A")]
    assert merging.merge_batches(spark, later) == "voters_segment_1"
    assert warehouse.read_raw(spark, later).count() == 2


def test_segments_are_packed_by_size():
    segments = {"a": (100, []), "b": (30, []), "c": (1000, [])}
    assert merging.chosen(segments, 10) == []
    assert merging.chosen(segments, 20) == ["b", "a"]
    assert merging.chosen(segments, 400) == ["b", "a", "c"]
    assert merging.chosen({}, 5) == []
