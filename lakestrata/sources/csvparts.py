"""Large CSV files with line breaks inside quoted cells, read by many tasks.

Whether a line break ends a record depends on the quotes before it. So each stretch of a file is first summed up: the
state it ends in for every state it may begin in (outside a quoted cell, inside one, right behind a quote inside one,
which either closes the cell or is the first of a doubled one). Following these sums through a file gives every
stretch the state it begins in. A task then takes the records that begin in its stretch, reading on to the end of
the last one, and gives them out as text, which ``from_csv`` splits into cells as Spark's CSV reader does.

A quote opens a cell only at its beginning; elsewhere outside it is an ordinary character.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.text import decoded_path
from lakestrata.sources.files import scan_files
from lakestrata.sources.storage import read_range

#: Bytes of a stretch; larger files are read in stretches.
STRETCH = 8 << 20
OUTSIDE, INSIDE, QUOTED = 0, 1, 2
RECORDS = "path string, _block bigint, _seq bigint, record string"
_SUMS = "path string, at bigint, two boolean, blank boolean, end0 int, end1 int, end2 int"
_BEGINS = "path string, at bigint, two boolean, state int, first boolean"
_BOM = b"\xef\xbb\xbf"
#: Of a quoted cell what comes behind its opening quote; the group is its closing quote, empty where the data ends.
_INNER = rb'[^"]*+(?:""[^"]*+)*+("?+)'
_CELL, _REST = re.compile(rb'(?<=[,\n])"' + _INNER), re.compile(_INNER)
_HEAD = 1 << 16


def _columns(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def quoted_parts(data: bytes, state: int) -> tuple[list[tuple[int, int]], int]:
    """(start and end of each part inside quotes, the state behind the last byte).

    The first byte of ``data`` is the one in front of the stretch, a line break if there is none; ``state`` is that behind it.
    """
    if len(data) == 1:
        return [], state
    found, at = [], 1
    if state == QUOTED:
        state, at = (INSIDE, 2) if data[1:2] == b'"' else (OUTSIDE, 1)
    if state == INSIDE:
        cell = _REST.match(data, at)
        found.append((1, cell.end()))
        if cell.end() == len(data):
            return found, QUOTED if cell[1] else INSIDE
        at = cell.end()
    cell = None
    for cell in _CELL.finditer(data, at):
        found.append(cell.span())
    if cell is not None and cell.end() == len(data):
        return found, QUOTED if cell[1] else INSIDE
    return found, OUTSIDE


def _stretch(path: str, at: int, length: int) -> bytes:
    """The byte in front of a stretch and its bytes; a byte order mark becomes blank lines."""
    data = read_range(path, at - 1, length + 1) if at else b"\n" + read_range(path, 0, length)
    if at <= len(_BOM) and read_range(path, 0, len(_BOM)) == _BOM:
        blank = min(len(_BOM) - at + 1, len(data))
        data = b"\n" * blank + data[blank:]
    return data


def _breaks(data: bytes, quoted: list[tuple[int, int]]) -> np.ndarray:
    """Places of the line breaks outside quotes."""
    at = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    if not quoted:
        return at
    spans = np.array(quoted)
    part = np.searchsorted(spans[:, 0], at, "right") - 1
    return at[(part < 0) | (at >= spans[part, 1])]


def records_of(path: str, at: int, length: int, state: int) -> list[bytes]:
    """The records that begin in a stretch, without their line breaks; blank lines are none."""
    more = _HEAD
    while True:
        data = _stretch(path, at, length + more)
        whole = len(data) <= length + more  # nothing comes behind
        breaks = _breaks(data, quoted_parts(data, state)[0])
        breaks = breaks[breaks > 0] if state != OUTSIDE else breaks
        starts = breaks[breaks < length] + 1
        ends = np.searchsorted(breaks, starts)
        if not len(starts) or whole or ends[-1] < len(breaks):
            break
        more *= 4
    bounds = [(start, breaks[end] if end < len(breaks) else len(data)) for start, end in zip(starts, ends)]
    return [data[start:end] for start, end in bounds if end > start]


def line_end(path: str) -> str | None:
    """What ends the first line of a file; None if it has no line break."""
    at = 0
    while data := read_range(path, at, _HEAD):
        found = re.search(rb"[\r\n]", data)
        if found:
            return {b"\r\n": "\r\n", b"\n": "\n"}.get(_line_end(path, at + found.start()), "\r")
        at += len(data)
    return None


def _line_end(path: str, at: int) -> bytes:
    data = read_range(path, at, 2)
    return data[:1] if data[:1] == b"\n" else data


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(line_end=[line_end(path) for path in batch["path"]])


def large_files(spark: SparkSession, paths: str | list[str], stretch: int) -> list:
    """``path, length, line_end`` of the files that are larger than a stretch; the listing alone tells which."""
    reader = spark.read.format("binaryFile")
    scan = reader.load(paths) if isinstance(paths, str) else scan_files(spark, paths, reader.load)
    listed = scan.select(
        decoded_path("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"))
    return listed.where(F.col("length") > stretch).mapInPandas(
        _describe, "path string, length bigint, line_end string").collect()


def _sum_up(stretch: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, at, two in batch[["path", "at", "two"]].itertuples(index=False):
                data = _stretch(path, at, stretch)
                blank = not data[1:].strip(b"\r\n" if two else b"\n")
                outside, inside = (quoted_parts(data, state)[1] for state in (OUTSIDE, INSIDE))
                quoted = quoted_parts(data, QUOTED)[1] if data[1:2] == b'"' else outside
                rows.append((path, at, two, blank, outside, inside, quoted))
            yield pd.DataFrame(rows, columns=_columns(_SUMS))
    return run


def _follow(sums: pd.DataFrame) -> pd.DataFrame:
    """The state in which each stretch of one file begins, and whether only blank lines come before; a few numbers a stretch."""
    sums, state, begins = sums.sort_values("at"), OUTSIDE, []
    for ends in sums[["end0", "end1", "end2"]].to_numpy():
        begins.append(state)
        state = int(ends[state])
    blank = sums["blank"].cumprod().astype(bool)
    return sums[["path", "at", "two"]].assign(state=begins, first=blank.shift(1, fill_value=True))


def csv_records(spark: SparkSession, files: list, stretch: int = STRETCH, has_header: bool = False) -> DataFrame:
    """The records of files (``path, length, line_end``) as text: ``path, _block, _seq, record``, in the order of the last
    three, without the first one of each file if that is a header. Lines end as the first one does, or with a line feed
    alone; files whose lines end with carriage returns alone are not for this reader."""
    number = sum(-(-file["length"] // stretch) for file in files)
    listed = spark.createDataFrame([(f["path"], f["length"], f["line_end"] == "\r\n") for f in files], "path string, length bigint, two boolean")
    stretches = listed.select("path", "two", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(stretch).cast("bigint"))).alias("at"))
    # the number is given, as rows this small would be read by one task otherwise
    begins = stretches.repartition(number).mapInPandas(_sum_up(stretch), _SUMS).groupBy("path").applyInPandas(_follow, _BEGINS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.to_pylist():
                found = records_of(one["path"], one["at"], stretch, one["state"])
                if one["two"]:
                    found = [r for r in ((r + b"\n").replace(b"\r\n", b"\n")[:-1] for r in found) if r]
                texts = [r.decode("utf-8", "replace") for r in found[int(has_header and one["first"]):]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([one["path"]] * len(texts), pa.string()), pa.array([one["at"]] * len(texts), pa.int64()),
                    pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["path", "_block", "_seq", "record"])

    return begins.repartition(number).mapInArrow(read, RECORDS)
