"""Files of a drop folder that change between runs."""

from __future__ import annotations

import os

import pytest
from test_load import HEADER, TIMES, ledger_rows, loaded, write_csv

from rollcall.session import new_scratch_path
from rollcall.sources import listing, warehouse
from rollcall.streaming import drops


@pytest.fixture
def wh(spark):
    root = new_scratch_path(spark, "wh")
    return warehouse.Warehouse(root, prefix=f"l{root[-8:]}_")


@pytest.fixture
def folder(tmp_path):
    place = tmp_path / "drop box+"
    place.mkdir()
    return place


def people(*ids, name="A"):
    return HEADER + "".join(f"{i},{name}" + "," * 9 + "\n" for i in ids)


def later(path, seconds):
    at = os.stat(path).st_mtime + seconds
    os.utime(path, (at, at))


def run(spark, wh, folder, day, **options):
    return drops.load_changed_files(spark, wh, str(folder), TIMES[day], **options)


def test_new_rewritten_touched_removed_and_same_files(spark, wh, folder):
    first = write_csv(folder, people(1, 2), "a 1.csv")
    second = write_csv(folder, people(3), "b%20+.csv")
    write_csv(folder, HEADER, "empty.csv")
    write_csv(folder, "", "no bytes.csv")
    assert run(spark, wh, folder, 0) == {"new": 3}
    assert loaded(spark, wh) == [("1", "A"), ("2", "A"), ("3", "A")]
    assert run(spark, wh, folder, 1) == {"same": 3}
    # One gets a new time only; one is rewritten under its old name; one goes.
    later(second, 10)
    write_csv(folder, people(2, 4, name="B"), "a 1.csv")
    later(first, 10)
    os.remove(folder / "empty.csv")
    assert run(spark, wh, folder, 2) == {"touched": 1, "rewritten": 1, "removed": 1}
    assert loaded(spark, wh) == [("1", "A"), ("2", "A"), ("3", "A"), ("4", "B")]
    assert ledger_rows(spark, wh) == [(3, 3, "success"), (2, 1, "success")]
    changes = listing.read_changes(spark, wh, str(folder)).where("number = 2").collect()
    assert {(r.path.rsplit("/", 1)[1], r.change) for r in changes} == {
        ("a 1.csv", "rewritten"), ("b%20+.csv", "touched"), ("empty.csv", "removed"),
    }
    assert listing.read_listing(spark, wh, str(folder)).count() == 2
    os.remove(second)
    assert run(spark, wh, folder, 3) == {"removed": 1, "same": 1}
    assert len(ledger_rows(spark, wh)) == 2 and len(loaded(spark, wh)) == 4


def test_back_to_earlier_bytes_is_a_change_of_its_own(spark, wh, folder):
    for day, ids in enumerate([(1,), (2,), (1,)]):
        path = write_csv(folder, people(*ids), "x.csv")
        later(path, day * 10)
        assert run(spark, wh, folder, day) == {"rewritten" if day else "new": 1}
    assert run(spark, wh, folder, 3) == {"same": 1}
    # Three ledger rows; the third load brought nothing that was not there.
    assert ledger_rows(spark, wh) == [(1, 1, "success"), (1, 1, "success"), (1, 0, "no-op")]
    seen = listing.read_changes(spark, wh, str(folder)).orderBy("number").collect()
    assert seen[0].digest == seen[2].digest == seen[1].last_digest != seen[1].digest


def test_a_failed_run_is_done_again_and_loads_once(spark, wh, folder, monkeypatch):
    write_csv(folder, people(1, 2), "x.csv")

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(drops, "keep_listing", lost)
        with pytest.raises(RuntimeError):
            run(spark, wh, folder, 0)
    assert listing.last_number(spark, wh, str(folder)) == 0
    assert run(spark, wh, folder, 1) == {"new": 1}
    assert loaded(spark, wh) == [("1", "A"), ("2", "A")]
    assert ledger_rows(spark, wh) == [(2, 2, "success")]


def test_other_bytes_of_the_same_length_and_time(spark, wh, folder):
    path = write_csv(folder, people(1), "x.csv")
    run(spark, wh, folder, 0)
    kept = os.stat(path)
    write_csv(folder, people(2), "x.csv")
    os.utime(path, ns=(kept.st_atime_ns, kept.st_mtime_ns))
    assert run(spark, wh, folder, 1) == {"same": 1}
    assert run(spark, wh, folder, 2, verify=True) == {"rewritten": 1}
    assert loaded(spark, wh) == [("1", "A"), ("2", "A")]


def test_an_empty_folder_and_only_headers(spark, wh, folder):
    assert run(spark, wh, folder, 0) == {}
    write_csv(folder, HEADER, "x.csv")
    assert run(spark, wh, folder, 1) == {"new": 1}
    assert ledger_rows(spark, wh) == [] and loaded(spark, wh) == []
