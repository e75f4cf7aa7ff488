import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from lakestrata.sources import csvparts, tabular
from tests.conftest import rows

COLUMNS = ["order_id", "note", "more"]


def _cell(rng):
    text = "".join(rng.choice('ab",\n é漢🙂x') for _ in range(rng.randrange(9)))
    return rng.choice(["", "plain", '""', '"' + text.replace('"', '""') + '"', '"' + text.replace('"', '""') + '"'])


def _table(rng, n, end="\n"):
    """Records of one to four cells, blank lines among them, a mark in front or not, a line break at the end or not."""
    lines = [",".join(_cell(rng) for _ in range(rng.choice([1, 2, 3, 3, 3, 4]))) for _ in range(n)]
    return rng.choice(["", "﻿"]) + end.join(lines) + rng.choice(["", end, end + end])


def _parts(path, size, length):
    state, found = csvparts.OUTSIDE, []
    for at in range(0, size, length):
        found += csvparts.records_of(path, at, length, state)
        state = csvparts.quoted_parts(csvparts._stretch(path, at, length), state)[1]
    return found


@pytest.mark.parametrize("length", [1, 2, 3, 7, 50, 1000])
def test_stretches_give_the_records_of_the_whole(tmp_path, length):
    rng = random.Random(length)
    for n in range(60):
        text = _table(rng, rng.choice([1, 2, 12]))
        path = tmp_path / f"{n}.csv"
        path.write_bytes(text.encode())
        want = [record for record in csv.reader(io.StringIO(text.removeprefix("﻿"), newline="")) if record]
        got = [next(csv.reader(io.StringIO(r.decode(), newline=""))) for r in _parts(str(path), path.stat().st_size, length)]
        assert got == want, text


def test_the_end_of_a_line(tmp_path):
    path = tmp_path / "x.csv"
    for text, end in (("a\r\nb", "\r\n"), ("a\nb\r\n", "\n"), ("a\rb\n", "\r"), ("", None), ("x" * 70000 + "\r\n", "\r\n"), ("x" * 65535 + "\r\n", "\r\n")):
        path.write_text(text, newline="")
        assert csvparts.line_end(str(path)) == end


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("header", [True, False])
def test_large_files_are_read_as_whole_ones(spark, files, end, header):
    rng = random.Random(len(end))
    path = files(**{f"{n} +é.csv": _table(rng, 300, end) for n in range(3)}, **{"small.csv": 'a,"b\nc"' + end + 'd,"e"x,"' + end})

    def read(stretch):
        return tabular.scan_csv_layout(spark, path, COLUMNS, header, ragged="pad", with_position=True, multi_line=True, stretch=stretch)

    whole, parts = read(1 << 30), read(700)
    columns = ["source_file", *COLUMNS]
    assert parts.columns == whole.columns
    assert rows(parts, *columns) == rows(whole, *columns)
    ordered = [[r[1:] for r in df.orderBy("_file", "_block", "_seq").select("source_file", *COLUMNS).collect() if "+" in r[0]] for df in (parts, whole)]
    assert ordered[0] == ordered[1]
    blocks = parts.where(F.col("source_file").startswith("1")).select("_block").distinct().count()
    assert blocks == 1 if end == "\r" else blocks > 2
    skipped = [tabular.scan_csv_layout(spark, path, COLUMNS[:2], header, ragged="skip", multi_line=True, stretch=s) for s in (700, 1 << 30)]
    assert rows(skipped[0], *COLUMNS[:2]) == rows(skipped[1], *COLUMNS[:2])


def test_stray_quotes_and_open_cells(spark, files):
    lines = ['1,5" pipe,x', '2,"a"b,c"', '3,"x" ,y', '4,a"b"c,"q""q"', '5,"""",""', '6," ""x""\n,",z'] * 40 + ['7,"never closed,x', "8,b", ""]
    path = files(**{"a.csv": "\n".join(lines)})
    whole, parts = (tabular.scan_csv_layout(spark, path, COLUMNS, False, multi_line=True, stretch=s) for s in (1 << 30, 100))
    assert rows(parts) == rows(whole)


def test_stretches_are_many_tasks(spark, files):
    path = files(**{"a.csv": 'id,"a\nb"\n' * 2000})
    found = csvparts.csv_records(spark, csvparts.large_files(spark, path, 1000), 1000)
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 10


def test_headers_behind_many_blank_lines(spark, files):
    path = files(**{"a.csv": "\n" * 50 + 'id,"no\nte"\n' + '1,"x\ny"\n' * 9, "b.csv": "\r\n" * 40 + "id,n\r\n" + '2,"z\r\n"\r\n' * 9})
    whole, parts = (tabular.scan_csv_layout(spark, path, COLUMNS, True, multi_line=True, stretch=s) for s in (1 << 30, 20))
    assert rows(parts) == rows(whole) and parts.count() == 18
