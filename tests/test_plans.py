"""The physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from rollcall import fixture
from rollcall.catalog import QUERIES
from rollcall.operators import keys
from rollcall.plans import layers, marts, quality, refresh
from rollcall.session import new_scratch_path
from rollcall.sources import ledger, warehouse

SF_DIR = "/root/testdata/sf0.001"


def plan(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def nodes(text, name):
    return len(re.findall(rf"^\(\d+\) {name}", text, flags=re.M))


@pytest.fixture(scope="module")
def cleaned(spark):
    path = new_scratch_path(spark, "cleaned")
    layers.clean(layers.stage(fixture.raw_registry(spark, SF_DIR)), fixture.RUN_TS).write.parquet(path)
    return spark.read.parquet(path)


def test_layers_do_not_shuffle(spark, capsys):
    path = new_scratch_path(spark, "raw")
    fixture.raw_registry(spark, SF_DIR).write.parquet(path)
    rows = layers.clean(layers.stage(spark.read.parquet(path)), fixture.RUN_TS)
    text = plan(rows, capsys)
    assert nodes(text, "Exchange") == 0
    assert "PushedFilters: [IsNotNull(id)]" in text


@pytest.mark.parametrize("name", list(marts.MARTS))
def test_marts_read_only_their_columns(cleaned, name, capsys):
    text = plan(marts.MARTS[name](cleaned), capsys)
    assert "BatchEvalPython" not in text and "Join" not in text
    read = re.search(r"ReadSchema: (.*)", text)[1]
    assert not re.search(r"\b(email|first_name|voter_id):", read)


def test_filters_reach_the_scan(cleaned, capsys):
    assert "has_missing_data" in re.search(
        r"PushedFilters: (.*)", plan(marts.state_summary(cleaned), capsys)
    )[1]
    assert "GreaterThanOrEqual(registered_date" in plan(marts.registration_trends(cleaned), capsys)


def test_window_runs_on_aggregated_months(cleaned, capsys):
    text = plan(marts.registration_trends(cleaned), capsys)
    above, below = text.index("Window"), text.index("HashAggregate")
    assert above < below


def test_load_shuffles_the_batch_only(spark, capsys, monkeypatch):
    """The plan of the load itself: the batch is scanned and shuffled once, the table never."""
    root = new_scratch_path(spark, "wh")
    wh = warehouse.Warehouse(root, prefix=f"plan{root[-8:]}_")
    warehouse.ensure_tables(spark, wh)
    path = new_scratch_path(spark, "extract")
    fixture.extract(spark, SF_DIR).write.parquet(path)
    rows = spark.read.parquet(path)
    refresh.load_batch(spark, wh, ledger.stamp_batch(rows, fixture.RUN_TS, "h"))
    appended = []
    monkeypatch.setattr(refresh, "append_rows", lambda _, df, table: appended.append(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        refresh.load_batch(spark, wh, ledger.stamp_batch(rows, fixture.RUN_TS, "h2"))
        text = plan(appended[0], capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in text and "Bucketed: true" in text
    assert nodes(text, "Exchange") == 1 and nodes(text, "Scan parquet") == 2
    raw = spark.table(wh.raw_table)
    assert "PartitionFilters" in plan(raw.where("source_file_hash = 'h'"), capsys)


def test_refresh_parses_the_extract_once(spark, tmp_path, monkeypatch):
    root = new_scratch_path(spark, "wh")
    wh = warehouse.Warehouse(root, prefix=f"once{root[-8:]}_")
    path = str(tmp_path / "csv")
    refresh_csv = refresh.csv_scan
    read = []

    def scan(*a):
        parsed = refresh_csv(*a)
        counter = spark.sparkContext.accumulator(0)
        read.append(counter)
        return parsed.mapInArrow(lambda batches: (counter.add(b.num_rows) or b for b in batches), parsed.schema)

    from rollcall.sources import csv

    csv.write_extract(fixture.extract(spark, SF_DIR), path)
    monkeypatch.setattr(refresh, "csv_scan", scan)
    result = refresh.run_refresh(spark, wh, path, fixture.RUN_TS)
    assert len(read) == 1 and read[0].value == result.file_row_count == 150


def test_unseen_keys_scan_the_batch_once(spark, capsys):
    path = new_scratch_path(spark, "extract")
    fixture.extract(spark, SF_DIR).write.parquet(path)
    rows = spark.read.parquet(path)
    text = plan(keys.load_unseen_keys(rows, rows.where("age > '30'").select("id")), capsys)
    assert nodes(text, "Scan parquet") == 2  # the batch, and the target


def test_check_report_scans_each_layer_once(spark, cleaned, capsys):
    path = new_scratch_path(spark, "staged")
    layers.stage(fixture.raw_registry(spark, SF_DIR)).write.parquet(path)
    trends = new_scratch_path(spark, "trends")
    marts.registration_trends(cleaned).write.parquet(trends)
    text = plan(quality.check_report(spark.read.parquet(path), cleaned, spark.read.parquet(trends), "2025-09-01"), capsys)
    assert nodes(text, "Scan parquet") == 3


def test_a_hot_key_is_counted_before_the_shuffle(spark, capsys):
    hot = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.lit("x")).otherwise(
        F.col("id").cast("string")).alias("id"))
    text = plan(keys.key_violations(hot), capsys)
    # In formatted plans a node is numbered after what feeds it.
    assert "partial_count" in text and text.index("partial_count") < text.index("hashpartitioning")
    assert [tuple(r) for r in keys.key_violations(hot).collect()] == [("x", 334)]


def test_skewed_anti_join_is_split(spark, capsys):
    """A key with a third of the batch does not stay in one task of the join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit("x")).otherwise(F.col("id").cast("string"))
        batch = spark.range(0, 200_000, 1, 8).select(key.alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        target = spark.range(0, 100_000, 1, 8).select(F.col("id").cast("string").alias("id"))
        unseen = keys.load_unseen_keys(batch, target)
        n = len(unseen.collect())
        text = plan(unseen, capsys)
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert n == sum(1 for i in range(200_000) if i % 3 == 0 or i >= 100_000)
    assert "skew" in text.lower()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"a1_csv_scan", "a3_source_row_count", "a8_append_sink", "a13_run_refresh", "l1_stream_load_unseen", "a2_byte_fingerprint"}))
def test_no_python_and_no_product_in_any_query(spark, capsys, name):
    """Five that are left out run their jobs eagerly; what they return is a scan. The bytes of a
    file are cut at fixed places in Python."""
    text = plan(QUERIES[name](spark, SF_DIR), capsys)
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
