"""Folders of very many files: nothing is asked or looked up one file at a time."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakestrata.plans.batch import Medallion
from lakestrata.sources import files as f
from lakestrata.sources import storage, tabular
from lakestrata.sources.files import MANY_FILES, read_manifest
from lakestrata.streaming.ingest import BronzeTables, ingest_stream, medallion_stream

N = MANY_FILES + 50


def two_kinds(files, even="a_%04d.csv", odd="b_%04d.csv"):
    """As many files of a layout as of another one, and a JSON file; names by kind, or in turn."""
    files(**{even % (2 * i): f"order_id,order_date\n{i},2026-01-01\n" for i in range(N)})
    files(**{odd % (2 * i + 1): f"date,id,code\n2026-01-02,{N + i},X\n" for i in range(N)})
    return files(**{"z.json": '{"order_id": "j", "order_date": "2026-01-03"}\n'})


def layouts(spark, path):
    return f.sniff_layout(f.csv_heads(f.list_files(spark, path)))


def ids(rows):
    return sorted(row[0] for row in rows.select("order_id").collect())


@pytest.fixture
def scans(monkeypatch):
    """The number of paths that each scan was given."""
    found, scan = [], f.scan_files

    def note(spark, names, read):
        def counted(paths):
            found.append(len(paths))
            return read(paths)
        return scan(spark, names, counted)

    monkeypatch.setattr(tabular, "scan_files", note)
    return found


def test_many_files_are_scanned_as_ranges_of_their_folder(spark, files, scans):
    path = two_kinds(files)
    assert ids(tabular.scan_csv_files(spark, layouts(spark, path))) == sorted(str(i) for i in range(2 * N))
    assert scans == [1, 1]
    some = layouts(spark, path).where("path NOT LIKE '%a_0010.csv'")
    assert ids(tabular.scan_csv_files(spark, some)) == sorted(str(i) for i in range(2 * N) if i != 5)


def test_files_are_looked_up_by_name_where_ranges_do_not_tell_them(spark, files, scans):
    path = two_kinds(files, "c_%04d.csv", "c_%04d.csv")  # in turn
    assert ids(tabular.scan_csv_files(spark, layouts(spark, path))) == sorted(str(i) for i in range(2 * N))
    assert scans[1::2] == [N, N]
    below = Path(path) / "run=1"
    below.mkdir()
    (below / "c_0000.csv").write_text("order_id,order_date\nbelow,2026-01-01\n")
    assert "below" not in ids(tabular.scan_csv_files(spark, layouts(spark, path)))


def test_a_file_that_comes_while_the_scan_is_made_is_not_in_it(spark, files):
    path = two_kinds(files)
    names = f.scan_names(layouts(spark, path).where(F.col("path").contains("/a_")))

    def late(paths):
        files(**{"a_0001.csv": "order_id,order_date\nlate,2026-01-01\n"})
        return spark.read.text(paths)

    found = f.scan_files(spark, names, late)
    assert found.count() == 2 * N and found.where(F.col("value").startswith("late")).isEmpty()


def test_local_listings_ask_hadoop_for_no_single_file(spark, files, monkeypatch):
    path = files(**{"a b.csv": "x", "ü%41.json": "", "_c.csv": "xyz", ".d": "-"})
    (Path(path) / "sub").mkdir()
    by_hadoop = sorted(storage._info(i) for i in storage._opened(spark, path)[1].listStatus(storage._opened(spark, path)[0]))

    def refuse(*_):
        raise AssertionError

    monkeypatch.setattr(storage, "_info", refuse)
    found = sorted(storage.list_folder(spark, path))
    assert [i for i in found if i.is_file] == [i for i in by_hadoop if i.is_file] and len(found) == len(by_hadoop) == 5
    names = [i.path for i in found if i.is_file]
    assert f.named_files(spark, [*names, names[0], "file:/not/there.csv"]).count() == 4


def test_small_files_are_opened_by_more_than_one_task(spark, files):
    path = two_kinds(files)
    listed = f.list_files(spark, path).coalesce(1)
    assert f.csv_heads(listed).rdd.getNumPartitions() > 4
    files(**{f"d_{i:04d}.json": '[{"order_id": 1}]' for i in range(N)})
    documents = f.list_files(spark, path).where("extension = '.json'").coalesce(1)
    records = tabular.json_records(spark, documents)
    assert records.count() == N + 1
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_a_stream_takes_all_that_has_come_at_once(spark, files, folder):
    path = files(**{f"e_{i:04d}.csv": "" for i in range(1001)})
    ingest_stream(spark, path, f"{folder}/in", f"{folder}/one").awaitTermination()
    medallion_stream(spark, path, f"{folder}/out", f"{folder}/two").awaitTermination()
    entries = read_manifest(spark, Medallion(spark, f"{folder}/out").manifest)
    assert (entries.count(), entries.select("run").distinct().count()) == (1001, 1)
    assert BronzeTables(spark, f"{folder}/in").recorded().count() == 1


def test_each_csv_file_is_opened_once_for_its_head(spark, files, folder, monkeypatch):
    path = files(**{f"g_{i:02d}.csv": f"order_id,order_date\n{i},2026-01-01\n" for i in range(20)}, **{"h.csv": ""})
    opened = spark.sparkContext.accumulator(0)
    read = f._read_heads

    def counted(batches):
        for heads in read(batches):
            opened.add(len(heads))
            yield heads

    monkeypatch.setattr(f, "_read_heads", counted)
    examined = f.examine_files(f.list_files(spark, path))
    assert examined.where("issue IS NULL").count() == 20 and examined.count() == 21
    assert opened.value == 21
    monkeypatch.setattr(f, "_read_heads", read)
    names = f.scan_names(f.list_files(spark, files(**{"\U0001f642[1].csv": "", "～.csv": "", "Z.csv": ""})))
    assert names == sorted(names, key=str.encode) and any("\\[1\\]" in name for name in names)
