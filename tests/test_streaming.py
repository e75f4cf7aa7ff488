import os
from pathlib import Path

import pytest

from lakestrata.plans.batch import Medallion
from lakestrata.sources.files import read_manifest
from lakestrata.sources.runs import RunTable
from lakestrata.streaming.ingest import BronzeTables, ingest_stream, medallion_stream
from tests.conftest import rows

HEADER = "order_id,order_date\n"


def test_each_file_is_ingested_once_by_its_own_layout(spark, files, folder):
    path = files(**{"a.csv": HEADER + "1,2026-01-01\n", "n.txt": "x"})

    def run():
        ingest_stream(spark, path, folder, f"{folder}/checkpoint").awaitTermination()
        return rows(BronzeTables(spark, folder).bronze.read().select("order_id", "order_date", "source_file"))

    assert run() == [("1", "2026-01-01", "a.csv")]
    assert run() == [("1", "2026-01-01", "a.csv")]
    files(**{"b.csv": "date,id,code\n2026-01-02,2,X\n,3,Y\n", "bad.json": "[", "c.csv": HEADER + "4,2026-01-04\n"})
    assert run() == [("1", "2026-01-01", "a.csv"), ("2", "2026-01-02", "b.csv"), ("3", None, "b.csv"), ("4", "2026-01-04", "c.csv")]
    assert rows(BronzeTables(spark, folder).bronze.read().where("order_id < 3").select("order_id", "code")) == [("1", None), ("2", "X")]
    issues = BronzeTables(spark, folder).issues.read()
    assert rows(issues.select("source_file")) == [("bad.json",), ("n.txt",)]


def test_micro_batches_fill_the_layers(spark, files, folder):
    path = files(**{"a.csv": HEADER + "1,2026-01-01\n,2026-01-01\n", "z [1].csv": HEADER + "7,2026-01-01\n", "zero.csv": ""})

    def run():
        medallion_stream(spark, path, folder, f"{folder}/checkpoint").awaitTermination()
        m = Medallion(spark, folder)
        return rows(m.silver.read().select("order_id")), m.quarantine.read().count()

    assert run() == ([("1",), ("7",)], 1)
    files(**{"b.csv": "id,date,discount_code\n1,2026-02-01,X\n2,2026-02-01,Y\n", "bad.json": "["})
    assert run() == ([("1",), ("2",), ("7",)], 1)
    assert run() == ([("1",), ("2",), ("7",)], 1)
    assert read_manifest(spark, f"{folder}/manifest").count() == 5


def test_lost_stream_state_does_not_duplicate(spark, files, folder):
    path = files(**{"a.csv": HEADER + "1,2026-01-01\n,2026-01-01\n"})
    for checkpoint in ("one", "two"):
        medallion_stream(spark, path, folder, f"{folder}/{checkpoint}").awaitTermination()
    m = Medallion(spark, folder)
    assert m.silver.read().count() == 1 and m.quarantine.read().count() == 1


def test_two_streams_into_one_medallion(spark, files, folder, tmp_path):
    one = files(**{"a.csv": HEADER + "1,2026-01-01\n"})
    two = tmp_path / "two"
    two.mkdir()
    (two / "b.csv").write_text(HEADER + "2,2026-01-01\n")
    medallion_stream(spark, one, folder, f"{folder}/one").awaitTermination()
    medallion_stream(spark, str(two), folder, f"{folder}/two").awaitTermination()
    assert rows(Medallion(spark, folder).silver.read().select("order_id")) == [("1",), ("2",)]


def test_files_that_hold_nothing_come_alone_and_get_an_issue_and_a_disposition(spark, files, folder):
    path = files(**{"a.csv": HEADER + "1,2026-01-01\n"})

    def run():
        ingest_stream(spark, path, f"{folder}/in", f"{folder}/one").awaitTermination()
        medallion_stream(spark, path, f"{folder}/out", f"{folder}/two").awaitTermination()
        return (rows(BronzeTables(spark, f"{folder}/in").issues.read().select("source_file", "order_id"))
                if BronzeTables(spark, f"{folder}/in").issues.exists() else [], read_manifest(spark, f"{folder}/out/manifest").count())

    assert run() == ([], 1)
    files(**{"zero.csv": "", "_hidden.csv": HEADER + "2,2026-01-01\n"})
    assert run() == ([("_hidden.csv", "IO_ERROR"), ("zero.csv", "EMPTY")], 3)
    old = Path(path) / "old.csv"
    old.write_text(HEADER + "3,2026-01-01\n")
    os.utime(old, (1, 1))  # it comes late and bears an early time
    assert run() == ([("_hidden.csv", "IO_ERROR"), ("zero.csv", "EMPTY")], 4)
    assert rows(BronzeTables(spark, f"{folder}/in").bronze.read().select("order_id")) == [("1",), ("3",)]


def test_batch_that_died_before_it_was_recorded_is_taken_again(spark, files, folder, monkeypatch):
    path = files(**{"a.csv": HEADER + "1,2026-01-01\n", "b.csv": HEADER + "2,2026-01-01\n", "c.csv": ""})
    write = RunTable.write

    def die(table, *arguments):
        if table.path.endswith("handled"):
            raise ZeroDivisionError
        write(table, *arguments)

    with monkeypatch.context() as patch:
        patch.setattr(RunTable, "write", die)
        with pytest.raises(Exception):
            ingest_stream(spark, path, folder, f"{folder}/checkpoint", files_per_batch=2).awaitTermination()
    assert BronzeTables(spark, folder).bronze.read().count() == 0
    ingest_stream(spark, path, folder, f"{folder}/checkpoint", files_per_batch=2).awaitTermination()
    tables = BronzeTables(spark, folder)
    assert rows(tables.bronze.read().select("order_id")) == [("1",), ("2",)]
    assert rows(tables.issues.read().select("source_file")) == [("c.csv",)] and len(tables.bronze.vacuum()) == 1
