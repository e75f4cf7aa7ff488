"""Removes repeated byte strings: every byte in a ``LENGTH``-byte string that starts at two places or more.

Sorting a pair of ranks for each byte of a corpus, again and again, would move it many times over. So
1. a task puts the strings of a text into runs that share an anchor of ``ANCHOR`` bytes (see ``anchors``). A run whose
   anchor occurs once holds no repeated string, and a run that occurs twice as a whole holds only such: neither
   needs a rank. What is left are the different runs of an anchor that occurs several times.
2. Prefix doubling ranks these. All members of an anchor's class have the same rank to begin with. In each
   round the rank of a run is paired with the rank of the ``h`` bytes on the left of its anchor (and likewise on
   the right), for offsets ``h`` of 25, 50, 100 and 200. Spark groups the pairs; a pair that is unique ends the
   run's growth on that side, since nothing that long is repeated there, and pairs that occur again are ranks
   of the next round.
3. The strings of a run that its growth on both sides still allows are past the threshold but for one pair: the
   ranks of their two halves. Strings whose pair occurs again are repeated.
4. The spans to be removed meet again with their texts.

Ranks only need to tell strings apart, so they are 64-bit hashes of what they stand for.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.anchors import Spans, runs
from lakestrata.llm.frames import stored, table
from lakestrata.llm.passages import keyed, position, repeated_runs, with_text
from lakestrata.llm.tokens import mix, pieces, text_bytes

LENGTH, ANCHOR = 400, 200
PIECE = 4 << 20
#: What a byte counts in hashes.
_LETTERS = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x51ED270B))

_RUNS = "id long, key int, anchor long, fragment long, first int, number int, lead int"


def _stretches(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, bytes, begin of each text) of stretches of texts."""
    data, offsets = text_bytes(column)
    for first, last in pieces(offsets, PIECE):
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]


def _find_runs(length: int, k: int):
    """A task function: (id, key, text) to its runs."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, data, offsets in _stretches(batch.column(2)):
                found = runs(Spans(_LETTERS[data]), offsets, length, k)
                rows = pa.array(found.text + first)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(rows), batch.column(1).take(rows), pa.array(found.anchor.view(np.int64)),
                    pa.array(found.fragment.view(np.int64)), pa.array(found.first.astype(np.int32)),
                    pa.array(found.number.astype(np.int32)), pa.array(found.lead.astype(np.int32))],
                    ["id", "key", "anchor", "fragment", "first", "number", "lead"])
    return find


_WANTED = ("id", "key", "anchor", "run", "times", "first", "number", "lead")
_FETCHED = ("id long, key int, anchor long, run long, times long, first int, number int, lead int, bytes binary")


def _fetch(length: int):
    """A task function: (text, wanted runs) to a row per run with its bytes."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            out, strings = {c: [] for c in _WANTED}, []
            for i, wanted in enumerate(batch.column(1).to_pylist()):
                for run in wanted:
                    at = int(offsets[i]) + run["first"]
                    for c in _WANTED:
                        out[c].append(run[c])
                    strings.append(data[at:at + run["number"] + length - 1].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(out[c], t) for c, t in zip(_WANTED, types)], pa.array(strings, pa.binary())],
                [*_WANTED, "bytes"])
    return fetch


def offsets_of(length: int, k: int) -> list[int]:
    """The offsets of the rounds: doubled up to what a string can reach beyond its anchor."""
    out, h = [], max((length - k) // 8, 1)
    while h < length - k:
        out.append(h)
        h *= 2
    return [*out, length - k] if length > k else []


def _pairs(h: int, k: int, before: int):
    """A task function over (run, side, rank, lead, bytes): the rank paired with that of the bytes it grows by.

    Growing on the left (side 0) goes from ``before`` to ``h`` bytes in front of the anchor, on the right (1)
    behind it. A run that has not so many bytes there stops.
    """
    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides, ranks, leads = (batch.column(c).to_numpy() for c in ("side", "rank", "lead"))
            data, offsets = text_bytes(batch.column("bytes"))
            spans = Spans(_LETTERS[data])
            left = sides == 0
            starts = offsets[:-1] + leads + np.where(left, -h, k + before)
            ends = offsets[:-1] + leads + np.where(left, -before, k + h)
            fits = (starts >= offsets[:-1]) & (ends <= offsets[1:])
            grown = spans.hashes(starts[fits], ends[fits])
            paired = mix(ranks[fits].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + grown)
            yield pa.RecordBatch.from_arrays(
                [batch.column("run").filter(pa.array(fits)), pa.array(sides[fits]), pa.array(paired.view(np.int64))],
                ["run", "side", "rank"])
    return pair


def growth(fetched: DataFrame, length: int, k: int) -> DataFrame:
    """``run, left, right``: how far at most each run's anchor can grow on either side and still be repeated."""
    steps = offsets_of(length, k)
    text = fetched.select("run", "lead", "bytes")
    alive = fetched.select("run", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"), F.col("anchor").alias("rank"))
    reached, before = None, 0
    for n, h in enumerate(steps):
        paired = alive.join(text, "run").select("run", "side", "rank", "lead", "bytes").mapInArrow(
            _pairs(h, k, before), "run long, side int, rank long")
        paired = stored(paired, "rank-pairs")
        again = paired.groupBy("side", "rank").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        alive = stored(paired.join(again, ["side", "rank"]).select("run", "side", "rank"), "ranks")
        # what was repeated with h bytes may go on up to the next offset
        limit = steps[n + 1] - 1 if n + 1 < len(steps) else length - k
        row = alive.select("run", "side", F.lit(limit).alias("most"))
        reached = row if reached is None else reached.unionByName(row)
        before = h
    least = steps[0] - 1 if steps else 0
    if reached is None:
        return fetched.select("run", F.lit(0).alias("left"), F.lit(0).alias("right"))
    found = reached.groupBy("run").agg(
        F.max(F.when(F.col("side") == 0, F.col("most"))).alias("left"),
        F.max(F.when(F.col("side") == 1, F.col("most"))).alias("right"))
    return fetched.select("run").join(found, "run", "left").na.fill(least, ["left", "right"])


def _strings(length: int, k: int):
    """A task function over (run, number, lead, left, right, bytes): the strings that may be repeated, as pairs of ranks."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = length // 2
        for batch in batches:
            number, lead, left, right = (
                batch.column(c).to_numpy().astype(np.int64) for c in ("number", "lead", "left", "right"))
            data, offsets = text_bytes(batch.column("bytes"))
            spans = Spans(_LETTERS[data])
            # string number w starts lead - w bytes in front of the anchor and ends so far behind it
            low = np.maximum(lead - left, 0)
            high = np.minimum(number - 1, lead + right + k - length)
            many = np.maximum(high - low + 1, 0)
            run = np.repeat(np.arange(len(many)), many)
            nth = low[run] + np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
            starts = offsets[:-1][run] + nth
            one, two = spans.hashes(starts, starts + half), spans.hashes(starts + half, starts + length)
            pair = mix(one * np.uint64(0x9E3779B97F4A7C15) + two)
            yield pa.RecordBatch.from_arrays(
                [batch.column("run").take(pa.array(run)), pa.array(nth.astype(np.int32)), pa.array(pair.view(np.int64))],
                ["run", "nth", "pair"])
    return explode


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, k: int = ANCHOR,
) -> DataFrame:
    """``id, key, start, end``: spans of bytes, overlapping or not, that together are the bytes to be removed."""
    texts = keyed(docs, id_col, text_col)
    found = stored(texts.mapInArrow(_find_runs(length, k), _RUNS), "runs")
    held, kinds = repeated_runs(found)
    joined = held.drop("several").join(kinds, ["anchor", "fragment"])
    end = (F.col("first") + F.col("number") + (length - 1)).alias("end")
    whole = joined.where("times > 1").select("id", "key", F.col("first").alias("start"), end)
    # of the different runs of an anchor, one occurrence each; those of repeated runs only serve the others
    firsts = joined.where(F.col("several") & (position("id", "first") == F.col("place")))
    firsts = firsts.withColumn("run", F.xxhash64("anchor", "fragment")).select(*_WANTED)
    wanted = firsts.groupBy(F.col("id").alias("at_id"), F.col("key").alias("at_key")).agg(
        F.collect_list(F.struct(*_WANTED)).alias("wanted"))
    fetched = with_text(texts, wanted).select("text", "wanted").mapInArrow(_fetch(length), _FETCHED)
    fetched = stored(fetched.dropDuplicates(["run"]), "run-bytes")
    grown = fetched.join(growth(fetched, length, k), "run")
    strings = stored(grown.select("run", "number", "lead", "left", "right", "bytes").mapInArrow(
        _strings(length, k), "run long, nth int, pair long"), "string-pairs")
    again = strings.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("pair")
    single = fetched.where("times = 1").select("run", "id", "key", "first")
    partly = strings.join(again, "pair").join(single, "run").groupBy("run", "id", "key", "first").agg(
        F.sort_array(F.collect_list("nth")).alias("places"))  # no more than a run has
    # neighbouring places become one span
    begins = F.filter("places", lambda x, i: (i == 0) | (F.get("places", i - 1) < x - 1))
    ends = F.filter("places", lambda x, i: (i == F.size("places") - 1) | (F.get("places", i + 1) > x + 1))
    spans = partly.select("id", "key", "first", F.explode(F.arrays_zip(begins.alias("a"), ends.alias("b"))).alias("span"))
    spans = spans.select("id", "key", (F.col("first") + F.col("span.a")).cast("int").alias("start"),
                         (F.col("first") + F.col("span.b") + length).cast("int").alias("end"))
    return whole.unionByName(spans)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, spans) to (id, n_bytes, n_removed, n_spans, kept)."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        removed, spans, kept = [], [], []
        for i, wanted in enumerate(batch.column(2).to_pylist()):
            text = data[offsets[i]:offsets[i + 1]]
            out, at, number = [], 0, 0
            for start, end in sorted((s["start"], s["end"]) for s in wanted or ()):
                if start > at or not number:
                    out.append(text[at:start].tobytes())
                    number += 1
                    at = end
                at = max(at, end)
            out.append(text[at:].tobytes())
            kept.append(b"".join(out))
            removed.append(len(text) - len(kept[-1]))
            spans.append(number)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                    k: int = ANCHOR) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: the bytes that are left (they may cut a character).

    Null text is empty. Spans are maximal: bytes removed side by side are one.
    """
    spans = repeated_spans(docs, id_col, text_col, length, k).groupBy(
        F.col("id").alias("at_id"), F.col("key").alias("at_key")).agg(
        F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = with_text(keyed(docs, id_col, text_col), stored(spans, "repeated"), "left")
    return joined.select("id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def query(spark, sf_dir):
    left = remove_repeated(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
