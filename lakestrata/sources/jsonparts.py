"""Large JSON arrays read by many tasks.

Whether a byte lies inside a string, and how deep, depends on everything before it. So each stretch of a file is first
summed up for every state it may begin in (outside a string, inside, behind a backslash): the state it ends in, and how
much deeper. Following these sums through a file gives every stretch its true beginning. A task then takes the records
that begin in its stretch, reading on to the end of the last one, and checks what lies between them, so that all of
the file is checked once.
"""

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.sources.storage import read_range

#: Bytes of a stretch; larger files are read in stretches.
STRETCH = 4 << 20
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2
_SUMS = "path string, at bigint, " + ", ".join(f"end{s} int, deeper{s} bigint" for s in range(3))
_BEGINS = "path string, at bigint, state int, depth bigint"
_SPACE = rb"[ \t\r\n]*"
_HEAD = re.compile(rb"(?:\xef\xbb\xbf)?" + _SPACE + rb"\[" + _SPACE)
_BETWEEN = re.compile(_SPACE + rb"," + _SPACE + rb"(?=\{)")
_TAIL = re.compile(_SPACE + rb"\]" + _SPACE + rb"\Z")
_UNDECIDED = re.compile(_SPACE + rb"(?:," + _SPACE + rb"|\]" + _SPACE + rb")?\Z")


def scan(data: bytes, state: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of brackets outside strings, +1 or -1 for each, and the state behind the last byte."""
    buffer = np.frombuffer(data, np.uint8)
    place = np.arange(len(buffer))
    last_other = np.maximum.accumulate(np.where(buffer != 92, place, -1)) if len(buffer) else place
    before = np.concatenate([[-1], last_other])  # the last byte in front of each place that is no backslash
    run = np.arange(len(buffer) + 1) - 1 - before + ((before < 0) & (state == ESCAPED))
    escaped = run % 2 == 1
    quote = (buffer == 34) & ~escaped[:-1]
    within = np.cumsum(quote) % 2 == 1
    inside = (within ^ quote) ^ (state != OUTSIDE)  # in front of each byte
    opens, closes = np.isin(buffer, (91, 123)), np.isin(buffer, (93, 125))
    at = np.flatnonzero((opens | closes) & ~inside)
    ends_inside = bool(within[-1]) ^ (state != OUTSIDE) if len(buffer) else state != OUTSIDE
    end = (ESCAPED if escaped[-1] else INSIDE) if ends_inside else OUTSIDE
    return at, np.where(opens[at], 1, -1), end


def _sum_up(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, at in batch[["path", "at"]].itertuples(index=False):
                data = read_range(path, at, length)
                row = [path, at]
                for state in range(3):
                    _, deeper, end = scan(data, state)
                    row += [end, int(deeper.sum())]
                rows.append(row)
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SUMS.split(", ")])
    return run


def _follow(sums: pd.DataFrame) -> pd.DataFrame:
    """The state and the depth in which each stretch of one file begins; a few numbers a stretch."""
    sums, state, depth, rows = sums.sort_values("at"), OUTSIDE, 0, []
    ends, deeper = sums[["end0", "end1", "end2"]].to_numpy(), sums[["deeper0", "deeper1", "deeper2"]].to_numpy()
    for i, (path, at) in enumerate(zip(sums["path"], sums["at"])):
        rows.append((path, at, state, depth))
        state, depth = int(ends[i, state]), depth + int(deeper[i, state])
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _BEGINS.split(", ")])


def records_of(path: str, at: int, length: int, state: int, depth: int, parse) -> tuple[list[dict], bool]:
    """The records that begin in a stretch, and whether they, and all between them, are as they should be."""
    more = 0
    while True:
        data = read_range(path, at, length + more)
        whole = len(data) < length + more  # nothing comes behind
        found, sound, enough = _cut(data, at == 0, length, state, depth, whole)
        if enough or whole:
            break
        more = max(1 << 16, 2 * more)
    if not sound:
        return [], False
    records = []
    for start, end in found:
        try:
            record = parse(data[start:end].decode("utf-8"))
        except (ValueError, RecursionError):
            return [], False
        if not isinstance(record, dict):
            return [], False
        records.append(record)
    return records, True


def _cut(data: bytes, first: bool, length: int, state: int, depth: int, whole: bool) -> tuple[list, bool, bool]:
    """(start and end of each record, whether what lies between is sound, whether the data was long enough to tell)."""
    at, deeper, _ = scan(data, state)
    behind = depth + np.cumsum(deeper)
    if first:
        head = _HEAD.match(data)
        rest = data[head.end():head.end() + 1] if head else b""
        if not rest:  # whether this is an array shows in the first bytes that are no blanks
            return [], False, whole
        if rest not in b"{]":
            return [], False, True
        if rest == b"]" and not _TAIL.match(data, head.end()):
            return [], False, whole or not _UNDECIDED.match(data, head.end())
    if (behind < 0).any():
        return [], False, True
    opened = np.flatnonzero((deeper > 0) & (behind == 2) & (at < length))
    closed = np.flatnonzero((deeper < 0) & (behind == 1))
    found, sound = [], True
    for i in opened:
        j = np.searchsorted(closed, i)
        if j == len(closed):
            return found, False, False  # the last record goes on
        end = int(at[closed[j]]) + 1
        found.append((int(at[i]), end))
        if not _BETWEEN.match(data, end) and not (whole and _TAIL.match(data, end)):
            if not whole and _UNDECIDED.match(data, end):
                return found, False, False
            sound = False
    return found, sound, True


def _begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        first = [read_range(path, 0, 1 << 16).removeprefix(b"\xef\xbb\xbf").lstrip(b" \t\r\n")[:1] for path in batch["path"]]
        yield batch[[byte == b"[" for byte in first]]


def arrays(files: DataFrame) -> DataFrame:
    """Those of the listed files (``path, length``) whose text begins with a bracket."""
    return files.select("path", "length").mapInPandas(_begin, "path string, length bigint")


def array_records(files: DataFrame, schema: str, row_of, parse, problem: str, length: int, tasks: int) -> DataFrame:
    """Staged records (``path, _block, _seq, fields, problem``) of listed files (``path, length``) that hold an array.

    ``parse`` turns the text of a record into a dict and ``row_of`` that into key-value pairs. Each file also has a row
    without fields, and one with the ``problem`` for every stretch that has one. The number of ``tasks`` is given, as
    adaptive execution would leave rows as small as those of stretches to one.
    """
    stretches = files.select("path", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)).cast("bigint"), F.lit(length).cast("bigint"))).alias("at"))
    spread = stretches.repartition(tasks)
    begins = spread.mapInPandas(_sum_up(length), _SUMS).groupBy("path").applyInPandas(_follow, _BEGINS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.string())
        for batch in batches:
            for one in batch.to_pylist():
                records, sound = records_of(one["path"], one["at"], length, one["state"], one["depth"], parse)
                rows = [row_of(record) for record in records]
                said = [None] * len(rows)
                if one["at"] == 0 or not sound:
                    rows, said = [None, *rows], [None if sound else problem, *said]
                if rows:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([one["path"]] * len(rows)), pa.array([one["at"]] * len(rows), pa.int64()),
                        pa.array(range(len(rows)), pa.int64()), pa.array(rows, kind), pa.array(said, pa.string())],
                        ["path", "_block", "_seq", "fields", "problem"])

    return begins.repartition(tasks).mapInArrow(read, schema)


def parse_record(text: str):
    """A JSON value with its numbers as they are written."""
    return json.loads(text, parse_int=str, parse_float=str, parse_constant=str)
