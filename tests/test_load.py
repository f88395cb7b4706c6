"""Sources, incremental load, ledger, refresh and stream."""

from __future__ import annotations

import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rollcall import fixture
from rollcall.operators import keys
from rollcall.plans import layers, refresh
from rollcall.schema import EXTRACT_SCHEMA, RAW_COLUMNS
from rollcall.session import new_scratch_path, scratch_root
from rollcall.sources import csv, fingerprint, ledger, warehouse
from rollcall.streaming import drops

SF_DIR = "/root/testdata/sf0.001"
TIMES = [f"2025-09-0{i} 00:00:00" for i in range(1, 8)]


@pytest.fixture
def wh(spark):
    root = new_scratch_path(spark, "wh")
    house = warehouse.Warehouse(root, prefix=f"t{root[-8:]}_")
    warehouse.ensure_tables(spark, house)
    return house


def people(spark, *ids, name="A"):
    rows = [(i, name) + (None,) * 9 for i in ids]
    return spark.createDataFrame(rows, EXTRACT_SCHEMA)


def write_csv(tmp_path, text, name="x.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


HEADER = ",".join(RAW_COLUMNS) + "\n"


def test_csv_is_read_as_written(spark, tmp_path):
    lines = (
        HEADER
        + '007,"Ann ""X"" B","Doe, J",45,,,,c:\\d,01/02/2024,"",\n'
        + ' 8 ,"two\nlines",Roe,,,,,,,,\n'
    )
    path = write_csv(tmp_path, lines)
    assert [f.rpartition("/")[2] for f in csv.files_spanning_lines(spark, path)] == ["x.csv"]
    rows = {r.id: r for r in csv.csv_scan(spark, path).collect()}
    assert set(rows) == {"007", " 8 "}
    first = rows["007"]
    assert (first.first_name, first.last_name, first.email) == ('Ann "X" B', "Doe, J", "c:\\d")
    assert (first.registered_date, first.last_voted_date, first.gender) == ("01/02/2024", None, None)
    assert rows[" 8 "].first_name == "two\nlines"
    assert csv.source_row_count(csv.csv_scan(spark, path)).first()[0] == 2


def test_columns_are_taken_by_name(spark, tmp_path):
    names = [*reversed(RAW_COLUMNS), "extra"]
    path = write_csv(tmp_path, ",".join(names) + "\n" + ",".join(names) + "\n")
    assert not csv.files_spanning_lines(spark, path)
    assert list(csv.csv_scan(spark, path).first()) == list(RAW_COLUMNS)


def test_a_record_with_missing_fields_is_refused(spark, tmp_path):
    path = write_csv(tmp_path, HEADER + "1,a,b\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv.csv_scan(spark, path).collect()


def test_a_count_refuses_what_reading_the_rows_refuses(spark, tmp_path):
    path = write_csv(tmp_path, HEADER + "1" + "," * 10 + "\n" + "2,a,b\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv.source_row_count(csv.csv_scan(spark, path)).collect()
    good = write_csv(tmp_path, HEADER + ("1" + "," * 10 + "\n") * 3, "y.csv")
    assert csv.source_row_count(csv.csv_scan(spark, good)).first()[0] == csv.csv_scan(spark, good).count() == 3


def test_only_files_with_records_over_lines_lose_splitting(spark, tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    row = lambda i, name: f"{i},{name}" + "," * 9 + "\n"
    write_csv(folder, HEADER + row(1, "5' 6\"") + row(2, '"quoted ""x"" y"'), "stray.csv")
    # An even number of quotes on its first line, and still open there.
    write_csv(folder, HEADER + row(3, '"two ""a"" and ""\nlines"'), "open.csv")
    write_csv(folder, HEADER + row(4, "plain"), "plain.csv")
    assert [f.rpartition("/")[2] for f in csv.files_spanning_lines(spark, str(folder))] == ["open.csv"]
    rows = {r.id: r.first_name for r in csv.csv_scan(spark, str(folder)).collect()}
    assert rows == {"1": "5' 6\"", "2": 'quoted "x" y', "3": 'two "a" and "\nlines', "4": "plain"}


def test_a_missing_file_is_refused(spark):
    with pytest.raises(AnalysisException):
        csv.csv_scan(spark, "/no/such/extract.csv")


def test_fingerprint_ignores_order_and_notices_changes(spark):
    def mark(df):
        return tuple(fingerprint.content_fingerprint(df).first())

    rows = fixture.extract(spark, SF_DIR)
    same = mark(rows)
    assert mark(rows.orderBy(F.desc("id")).repartition(3)) == same
    assert mark(rows.unionByName(rows.limit(1))) != same
    assert mark(rows.withColumn("age", F.when(F.col("id") != "1", F.col("age")))) != same
    a = people(spark, "1").withColumn("last_name", F.lit("x"))
    b = people(spark, "1").withColumns({"first_name": F.lit(None), "last_name": F.lit("A")})
    swapped = people(spark, "1").withColumns({"first_name": F.lit("x"), "last_name": F.lit("A")})
    assert len({mark(a), mark(b), mark(swapped)}) == 3
    assert mark(people(spark))[1] == 0


def test_anti_join_keeps_rows_without_key(spark):
    unseen = keys.load_unseen_keys(people(spark, "1", None, "2", None), people(spark, "2", None))
    assert sorted(str(r.id) for r in unseen.collect()) == ["1", "None", "None"]


def load(spark, wh, rows, name):
    refresh.load_batch(spark, wh, ledger.stamp_batch(rows, TIMES[0], name))


def loaded(spark, wh):
    return sorted((r.id, r.first_name) for r in spark.table(wh.raw_table).collect())


def test_existing_rows_are_never_updated(spark, wh):
    load(spark, wh, people(spark, "1", "2"), "h1")
    load(spark, wh, people(spark, "2", "3", name="B"), "h2")
    load(spark, wh, people(spark, "2", "3", name="C"), "h3")
    assert loaded(spark, wh) == [("1", "A"), ("2", "A"), ("3", "B")]


def test_a_broken_batch_loads_nothing(spark, wh):
    load(spark, wh, people(spark, "1"), "h1")
    for ids in (("2", "2"), ("3", None)):
        with pytest.raises(keys.KeyViolation):
            load(spark, wh, people(spark, *ids), "h2")
    assert loaded(spark, wh) == [("1", "A")]


def test_a_repeated_known_key_is_harmless(spark, wh):
    load(spark, wh, people(spark, "1"), "h1")
    load(spark, wh, people(spark, *["1"] * 50, "2"), "h2")
    assert loaded(spark, wh) == [("1", "A"), ("2", "A")]


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_another_shuffle_setting_loads_nothing_twice(spark, threshold):
    """A later session without a shared catalog finds the bucket count under the root."""
    root = new_scratch_path(spark, "wh")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    ids = list(map(str, range(200)))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for n, partitions in enumerate(("4", "7")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            house = warehouse.Warehouse(root, prefix=f"s{n}{threshold.strip('-')}{root[-6:]}_")
            warehouse.ensure_tables(spark, house)
            load(spark, house, people(spark, *ids, name=f"run{n}"), f"h{n}")
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert warehouse.bucket_count(spark, house.raw_table) == 4
    assert loaded(spark, house) == sorted((i, "run0") for i in ids)
    with pytest.raises(ValueError, match="4 buckets"):
        warehouse.ensure_tables(spark, house, buckets=9)


def test_bucket_count_is_passed_on(spark, tmp_path):
    root = new_scratch_path(spark, "wh")
    house = warehouse.Warehouse(root, prefix=f"b{root[-8:]}_")
    path = str(tmp_path / "x")
    csv.write_extract(people(spark, "1"), path)
    refresh.run_refresh(spark, house, path, TIMES[0], buckets=3)
    assert warehouse.bucket_count(spark, house.raw_table) == 3


def test_files_without_their_bucket_count_are_refused(spark):
    root = new_scratch_path(spark, "wh")
    house = warehouse.Warehouse(root, prefix=f"n{root[-8:]}_")
    rows = ledger.stamp_batch(people(spark, "1"), TIMES[0], "h1")
    rows.write.partitionBy("source_file_hash").parquet(house.folder(house.raw, "voters"))
    with pytest.raises(ValueError, match="bucket count"):
        warehouse.ensure_tables(spark, house)


def test_a_batch_can_be_deduped(spark, wh):
    rows = people(spark, "1", "2", None, name="B").unionByName(people(spark, "1", "3", None))
    got = sorted((r.id, r.first_name) for r in keys.key_guard(rows, people(spark), mode="dedupe").collect())
    assert got == [("1", "A"), ("2", "B"), ("3", "A")]
    with pytest.raises(ValueError, match="unknown mode"):
        keys.key_guard(rows, people(spark), mode="x")


def test_raw_layout(spark, wh):
    load(spark, wh, people(spark, *map(str, range(200))), "h1")
    files = glob.glob(f"{wh.folder(wh.raw, 'voters')}/source_file_hash=h1/*.parquet")
    assert 1 <= len(files) <= warehouse.bucket_count(spark, wh.raw_table)


def test_tables_are_found_again(spark, wh):
    load(spark, wh, people(spark, "1"), "h1")
    warehouse.ensure_tables(spark, wh)
    other = warehouse.Warehouse(wh.root, prefix=f"again{wh.prefix}")
    warehouse.ensure_tables(spark, other)
    assert loaded(spark, other) == [("1", "A")]


def ledger_rows(spark, wh):
    rows = spark.table(wh.ledger_table).orderBy("ingested_at").collect()
    return [(r.file_row_count, r.inserted_row_count, r.load_status) for r in rows]


def test_refresh_over_several_days(spark, wh, tmp_path):
    registry = fixture.extract(spark, SF_DIR)
    paths = {"base": str(tmp_path / "base"), "all": str(tmp_path / "all")}
    csv.write_extract(fixture.base_batch(registry), paths["base"])
    csv.write_extract(registry, paths["all"])
    runs = [
        refresh.run_refresh(spark, wh, paths[name], at, run_id=at)
        for name, at in zip(("base", "all", "all", "base"), TIMES, strict=False)
    ]
    assert [r.loaded for r in runs] == [True, True, False, True]
    # The third run is skipped without a row; the fourth differs from the latest and runs.
    assert ledger_rows(spark, wh) == [(112, 112, "success"), (150, 38, "success"), (112, 112, "success")]
    dq = warehouse.read_mart(spark, wh, "dq_summary").first()
    assert (dq.raw_count, dq.cleaned_count, dq.missing_data_count) == (150, 150, 50)
    status = warehouse.read_mart(spark, wh, "engagement_metrics").agg(F.sum("voter_count"))
    assert status.first()[0] == 150
    marts = wh.namespace(wh.marts)
    assert warehouse.read_mart(spark, wh, "state_summary", namespace=marts).count() == 5


def test_a_failed_rebuild_leaves_the_gate_open(spark, wh, tmp_path, monkeypatch):
    path = str(tmp_path / "all")
    csv.write_extract(fixture.extract(spark, SF_DIR), path)
    with monkeypatch.context() as m:
        m.setattr(refresh, "rebuild_layers", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            refresh.run_refresh(spark, wh, path, TIMES[0])
    assert ledger_rows(spark, wh) == []
    assert refresh.run_refresh(spark, wh, path, TIMES[1]).loaded
    assert ledger_rows(spark, wh) == [(150, 150, "success")]
    assert spark.table(wh.raw_table).count() == 150


def test_nothing_new_is_recorded_as_no_op(spark, wh):
    load(spark, wh, people(spark, "1"), "h1")
    record = ledger.audit_record(spark.table(wh.raw_table), "h2", "/x", 1, TIMES[0]).first()
    assert (record.inserted_row_count, record.load_status, record.dag_run_id) == (0, "no-op", None)


def test_gate_on_an_empty_ledger(spark, wh):
    assert ledger.last_hash(spark, "no_such_ledger") is None
    assert ledger.last_hash(spark, wh.ledger_table) is None
    one = spark.createDataFrame([("h",)], "file_hash string")
    row = ledger.change_gate(one, spark.table(wh.ledger_table)).first()
    assert (row.last_hash, row.is_new) == (None, True)


def test_publish_switches_between_folders_that_take_turns(spark, wh):
    table = wh.table(wh.marts, "x")
    places = []
    created = None
    for n in range(1, 5):
        got = warehouse.publish(spark, wh, spark.range(n).toDF("n"), wh.marts, "x")
        created = created or warehouse.table_detail(spark, table, "Created Time")
        assert warehouse.table_detail(spark, table, "Created Time") == created  # never dropped
        places.append(warehouse.table_detail(spark, table, "Location")[-2:])
        assert got.count() == n
    assert len(set(places)) == warehouse.KEPT_RUNS + 1
    warehouse.publish(spark, wh, spark.range(5).toDF("n"), wh.marts, "x")
    assert warehouse.table_detail(spark, table, "Location")[-2:] == places[0]
    wider = warehouse.publish(spark, wh, spark.range(2).selectExpr("id", "id AS m"), wh.marts, "x")
    assert wider.columns == ["id", "m"]


def test_a_failed_publish_keeps_the_old_version(spark, wh):
    warehouse.publish(spark, wh, spark.range(3).toDF("n"), wh.marts, "y")
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("bigint").alias("n"))
    later = warehouse.Warehouse(wh.root, prefix=f"later{wh.prefix}")
    for house in (wh, later):  # in this session, and in one that only has the root
        warehouse.ensure_tables(spark, house)
        with pytest.raises(Exception, match="lost"):
            warehouse.publish(spark, house, broken, wh.marts, "y")
        assert spark.table(house.table(wh.marts, "y")).count() == 3
    warehouse.publish(spark, later, spark.range(5).toDF("n"), wh.marts, "y")
    warehouse.ensure_tables(spark, wh)
    assert spark.table(wh.table(wh.marts, "y")).count() == 5


def test_a_later_session_reads_every_layer_and_checks_it(spark, wh, tmp_path):
    path = str(tmp_path / "all")
    csv.write_extract(fixture.extract(spark, SF_DIR), path)
    refresh.run_refresh(spark, wh, path, TIMES[0])
    later = warehouse.Warehouse(wh.root, prefix=f"later{wh.prefix}")
    report = {r.check_name: r.failures for r in refresh.run_checks(spark, later, fixture.AS_OF).collect()}
    assert len(report) == 12 and report["staged_unique_voter_id"] == 0 and report["cleaned_equal_rowcount"] == 0
    assert refresh.read_staged(spark, later).count() == spark.table(later.cleaned_table).count() == 150
    for name in warehouse.MART_TABLES:
        mine, theirs = (sorted(map(str, warehouse.read_mart(spark, w, name).collect())) for w in (wh, later))
        assert mine == theirs and (mine or name == "demographic_crosstab")  # its small cells are left out


def test_a_folder_with_a_quote_in_its_name(spark, tmp_path):
    house = warehouse.Warehouse(f"{tmp_path}/it's", prefix=f"q{tmp_path.name[-6:].replace('-', '_')}_")
    warehouse.ensure_tables(spark, house)
    load(spark, house, people(spark, "1"), "h1")
    warehouse.publish(spark, house, spark.range(2).toDF("n"), house.marts, "x")
    warehouse.publish(spark, house, spark.range(3).toDF("n"), house.marts, "x")
    assert loaded(spark, house) == [("1", "A")] and spark.table(house.table(house.marts, "x")).count() == 3


def test_stream_equals_batch(spark, wh, tmp_path):
    registry = fixture.extract(spark, SF_DIR)
    folder, progress = str(tmp_path / "drops"), str(tmp_path / "progress")
    for rows, at in ((fixture.base_batch(registry), TIMES[0]), (registry, TIMES[1])):
        csv.write_extract(rows, folder)
        drops.stream_load_unseen(spark, wh, folder, progress, at).awaitTermination()
    drops.stream_load_unseen(spark, wh, folder, progress, TIMES[2]).awaitTermination()
    assert ledger_rows(spark, wh) == [(112, 112, "success"), (150, 38, "success")]
    raw = spark.table(wh.raw_table)
    wanted = sorted(tuple(v or None for v in r) for r in registry.collect())
    assert sorted(map(tuple, raw.select(*RAW_COLUMNS).collect()), key=str) == sorted(wanted, key=str)


def test_a_replayed_micro_batch_changes_nothing(spark, wh):
    batch = people(spark, "1", "2")
    for at in TIMES[:2]:
        drops.load_micro_batch(spark, wh, batch, at, "/drops", "same-id")
    assert loaded(spark, wh) == [("1", "A"), ("2", "A")]
    assert ledger_rows(spark, wh) == [(2, 2, "success")]
    drops.load_micro_batch(spark, wh, people(spark), TIMES[2], "/drops", "empty")
    assert len(ledger_rows(spark, wh)) == 1


def test_loading_in_steps_equals_loading_at_once(spark, wh):
    registry = fixture.extract(spark, SF_DIR)
    load(spark, wh, fixture.base_batch(registry), "h1")
    load(spark, wh, registry, "h2")
    assert spark.table(wh.raw_table).count() == registry.count()
    staged = layers.stage(spark.table(wh.raw_table))
    assert staged.select("voter_id").distinct().count() == registry.count()


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
