"""Files read in splits: records that span lines, and hashes of bytes."""

from __future__ import annotations

import hashlib
import random

import pytest
from test_load import HEADER, TIMES, write_csv

from rollcall.plans import refresh
from rollcall.session import new_scratch_path
from rollcall.sources import csv, splits, warehouse

SPLIT = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1000"}


@pytest.fixture
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


CELLS = ("", "plain", "5' 6\"", '"two\nlines"', '"a ""q"" \n,""\n"""', '""', '","', '"x,\n\ny"', '"\n"', '"\n,"', "  w ", "é ü")


def some_csv(rows, line_end, at_end, seed=1):
    r = random.Random(seed)
    lines = []
    for i in range(rows):
        cells = [r.choice(CELLS) if r.random() < 0.97 else '"' + "long\n" * r.randint(1, 9000) + '"' for _ in range(10)]
        lines.append(",".join([str(i), *cells]))
    return (HEADER + "\n".join(lines) + ("\n" if at_end else "")).replace("\n", line_end)


@pytest.mark.parametrize(("line_end", "at_end"), [("\n", True), ("\n", False), ("\r\n", True)])
def test_a_file_in_splits_equals_the_file_as_a_whole(spark, tmp_path, small_splits, line_end, at_end):
    path = write_csv(tmp_path, some_csv(150, line_end, at_end))
    assert splits.split_lines(spark, path).rdd.getNumPartitions() > 5
    states = splits.border_states(splits.quote_reports(splits.split_lines(spark, path)).collect())
    # Some splits begin in a quoted field, and some lie in one as a whole.
    assert any(splits.begins_inside(states, f, b) and splits.begins_inside(states, f, b + 20000) for f in states for b in range(0, 400_000, 20000))
    whole = sorted(map(tuple, csv.csv_scan(spark, path, multi_line=True).collect()), key=str)
    assert sorted(map(tuple, csv.csv_scan(spark, path).collect()), key=str) == whole and len(whole) == 150
    assert csv.source_row_count(csv.csv_scan(spark, path)).first()[0] == 150


def test_many_splits_are_read_in_few_tasks(spark, tmp_path, monkeypatch):
    for k, v in {"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "100"}.items():
        monkeypatch.setitem(SPLIT, k, v)
    kept = {k: spark.conf.get(k) for k in SPLIT}
    path = write_csv(tmp_path, some_csv(200, "\n", True, seed=4))
    whole = sorted(map(tuple, csv.csv_scan(spark, path, multi_line=True).collect()), key=str)
    try:
        for k, v in SPLIT.items():
            spark.conf.set(k, v)
        lines = splits.split_lines(spark, path)
        assert lines.select("block").distinct().count() > 300 and spark.read.text(path).rdd.getNumPartitions() > 300
        assert lines.rdd.getNumPartitions() <= max(splits.TASKS, splits.ROUNDS * spark.sparkContext.defaultParallelism)
        found = csv.csv_scan(spark, path)
        assert sorted(map(tuple, found.collect()), key=str) == whole and len(whole) == 200
        assert splits.byte_fingerprint(spark, path).first().n_bytes == (tmp_path / "x.csv").stat().st_size
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_several_files_and_blank_lines(spark, tmp_path, small_splits):
    folder = tmp_path / "drop"
    folder.mkdir()
    for n in range(3):
        write_csv(folder, some_csv(40, "\n", True, seed=n) + "\n\n", f"{n}.csv")
    write_csv(folder, HEADER + "plain" + "," * 10 + "\n", "3.csv")
    whole = sorted(map(tuple, csv.csv_scan(spark, str(folder), multi_line=True).collect()), key=str)
    assert sorted(map(tuple, csv.csv_scan(spark, str(folder)).collect()), key=str) == whole and len(whole) == 121


@pytest.mark.parametrize("bad", ['1,"a\nb",c\n', '1,"a\nb"' + "," * 12 + "\n"])
def test_missing_or_extra_fields_are_refused_by_a_count_too(spark, tmp_path, bad):
    path = write_csv(tmp_path, HEADER + bad)
    for action in (lambda df: df.collect(), lambda df: df.count()):
        with pytest.raises(Exception, match="(?i)malformed"):
            action(csv.csv_scan(spark, path))


def test_headers_must_be_equal(spark, tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    row = '1,"a\nb"' + "," * 9 + "\n"
    write_csv(folder, HEADER + row, "a.csv")
    write_csv(folder, ",".join(reversed(HEADER.strip().split(","))) + "\n" + row, "b.csv")
    with pytest.raises(ValueError, match="headers"):
        csv.csv_scan(spark, str(folder))


def plain_hash(data, leaf, children):
    level = [hashlib.sha256(data[i : i + leaf]).hexdigest() for i in range(0, len(data), leaf)]
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[i : i + children]).encode()).hexdigest() for i in range(0, len(level), children)]
    return hashlib.sha256((f"{len(data)}:" + "".join(level)).encode()).hexdigest()


@pytest.mark.parametrize("at_end", [True, False])
def test_byte_hash_equals_a_plain_one_on_any_splits(spark, tmp_path, at_end):
    r = random.Random(3)
    data = b"\n".join(bytes(r.choices([*range(9), *range(11, 256)], k=r.choice([0, 5, 80, 700]))) for _ in range(900))
    data = data.rstrip(b"\n") + (b"\n" if at_end else b"")
    path = tmp_path / "x.bin"
    path.write_bytes(data)
    found = set()
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("1k", "7000", "100k", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            for leaf, children in ((1000, 4), (65536, 1024)):
                row = splits.file_hashes(spark, str(path), leaf, children).first()
                assert (row.n_bytes, row.digest) == (len(data), plain_hash(data, leaf, children))
            found.add(splits.byte_fingerprint(spark, str(path)).first().file_hash)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert len(found) == 1


@pytest.mark.parametrize("data", [b"", b"\n", b"a", b"\xef\xbb\xbfa\nb", b"\xef\xbb\xbfa\nb\n", b"\r\n\r\n", b"x" * 1000, b"x" * 999 + b"\n"])
def test_byte_hash_of_odd_files(spark, tmp_path, data):
    (tmp_path / "x").write_bytes(data)
    row = splits.file_hashes(spark, str(tmp_path / "x"), 1000, 4).first()
    assert (row.n_bytes, row.digest) == (len(data), plain_hash(data, 1000, 4))


def test_byte_hash_notices_any_byte_and_no_name(spark, tmp_path):
    def mark(**files):
        folder = new_scratch_path(spark, "bytes")
        import os

        os.makedirs(folder)
        for name, data in files.items():
            with open(f"{folder}/{name}.csv", "wb") as f:
                f.write(data)
        return splits.byte_fingerprint(spark, folder).first().file_hash

    base = mark(a=b"1,x\n2,y\n", b=b"3,z\n")
    assert mark(p=b"3,z\n", q=b"1,x\n2,y\n") == base
    others = [mark(a=b"2,y\n1,x\n", b=b"3,z\n"), mark(a=b"1,x\n2,y", b=b"3,z\n"), mark(a=b"1,x\n2,Y\n", b=b"3,z\n"), mark(a=b"1,x\n2,y\n"), mark(a=b"1,x\n2,y\n", b=b"3,z\n", c=b"")]
    assert len({base, *others}) == 6


def test_missing_and_compressed_files_are_refused(spark, tmp_path):
    import gzip

    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        splits.byte_fingerprint(spark, "/no/such/file")
    (tmp_path / "x.gz").write_bytes(gzip.compress(b"a\nb\n" * 500))
    with pytest.raises(ValueError, match="compressed"):
        splits.byte_fingerprint(spark, str(tmp_path / "x.gz"))


def test_a_run_by_bytes_takes_a_reordered_extract_as_new(spark, tmp_path):
    root = new_scratch_path(spark, "wh")
    wh = warehouse.Warehouse(root, prefix=f"y{root[-8:]}_")
    rows = ["1,a" + "," * 9 + "\n", "2,b" + "," * 9 + "\n"]
    first, again, turned = (write_csv(tmp_path, HEADER + "".join(r), n) for r, n in ((rows, "a"), (rows, "b"), (rows[::-1], "c")))
    runs = [refresh.run_refresh(spark, wh, p, t, fingerprint="bytes") for p, t in zip((first, again, turned), TIMES, strict=False)]
    assert [(r.loaded, r.file_row_count) for r in runs] == [(True, 2), (False, 2), (True, 2)]
    with pytest.raises(ValueError, match="fingerprint"):
        refresh.run_refresh(spark, wh, first, TIMES[0], fingerprint="x")
