"""Removes word passages that occurred before: every word in a window of ``WIDTH`` words that also starts earlier.

1. A task puts the windows of a document into runs that share an anchor (see ``anchors``). Windows can only be equal
   if their anchors are, so a run whose anchor occurs once has nothing in common with any other.
2. Equal runs are told by their hash: of all occurrences the earliest one stays, the others are removed whole.
3. The different runs of one anchor are the reference shard of that anchor: in the order of their first
   occurrences they are streamed through a suffix automaton of the ones before, whose matching statistics tell
   the windows that occur earlier, and then added to it. A shard goes where its runs are (no shard is sent to
   tasks that have nothing to match with it); very large shards are decided window by window instead.
4. The removed spans of a document meet again with its text.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.anchors import Spans, runs
from lakestrata.llm.frames import stored, table
from lakestrata.llm.tokens import pieces, span_hashes, text_bytes, word_spans

WIDTH, ANCHOR = 20, 6
PIECE = 4 << 20
#: An anchor with more different runs than this is decided by window hashes, without an automaton in one task.
SHARD_RUNS = 5000
_LAST = 2 ** 63 - 1

_RUNS = "id long, key int, anchor long, fragment long, first int, number int"


class Automaton:
    """A suffix automaton of several sequences (Blumer et al., 1985), whose letters are any hashable values."""

    def __init__(self):
        self.next, self.link, self.length = [{}], [-1], [0]

    def matches(self, letters) -> list[int]:
        """Matching statistics: at each letter the length of the longest suffix that the automaton has."""
        follow, link, length, state, size, out = self.next, self.link, self.length, 0, 0, []
        for letter in letters:
            while state and letter not in follow[state]:
                state = link[state]
                size = length[state]
            target = follow[state].get(letter)
            if target is not None:
                state, size = target, size + 1
            out.append(size)
        return out

    def add(self, letters) -> None:
        last = 0
        for letter in letters:
            last = self._extend(last, letter)

    def _split(self, parent: int, letter, target: int) -> int:
        """A copy of ``target`` for the strings that are one letter longer than those of ``parent``."""
        copy = len(self.next)
        self.next.append(dict(self.next[target]))
        self.link.append(self.link[target])
        self.length.append(self.length[parent] + 1)
        self.link[target] = copy
        while parent >= 0 and self.next[parent].get(letter) == target:
            self.next[parent][letter] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, letter) -> int:
        known = self.next[last].get(letter)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, letter, known)
        new = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        state = last
        while state >= 0 and letter not in self.next[state]:
            self.next[state][letter] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][letter]
            self.link[new] = (
                target if self.length[target] == self.length[state] + 1 else self._split(state, letter, target))
        return new


def _word_hashes(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, word hashes, words before each text) of stretches of texts."""
    data, offsets = text_bytes(column)
    for first, last in pieces(offsets, PIECE):
        part = data[offsets[first]:offsets[last]]
        starts, ends, words = word_spans(part, offsets[first:last + 1] - offsets[first])
        yield first, last, span_hashes(part, starts, ends), words


def _find_runs(width: int, k: int):
    """A task function: (id, key, text) to its runs."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, hashes, words in _word_hashes(batch.column(2)):
                found = runs(Spans(hashes), words, width, k)
                rows = pa.array(found.text + first)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(rows), batch.column(1).take(rows), pa.array(found.anchor.view(np.int64)),
                    pa.array(found.fragment.view(np.int64)), pa.array(found.first.astype(np.int32)),
                    pa.array(found.number.astype(np.int32))], ["id", "key", "anchor", "fragment", "first", "number"])
    return find


def _fetch_words(width: int):
    """A task function: (text, wanted runs) to a row per run with the hashes of its words."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1).to_pylist()
            out = {c: [] for c in ("id", "key", "anchor", "large", "first", "number", "words")}
            for first, last, hashes, words in _word_hashes(batch.column(0)):
                for i in range(first, last):
                    for run in wanted[i]:
                        at = words[i - first] + run["first"]
                        for c in ("id", "key", "anchor", "large", "first", "number"):
                            out[c].append(run[c])
                        out["words"].append(hashes[at:at + run["number"] + width - 1].tobytes())
            types = (pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))
    return fetch


_WORDS = "id long, key int, anchor long, large boolean, first int, number int, words binary"
_SPANS = "id long, key int, start int, end int"


def _stream(width: int):
    """A task function over runs sorted by anchor and place: the spans of the windows that occurred before."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, automaton = None, None
        for batch in batches:
            out = []
            for own, i, key, first, words in zip(*[batch.column(c).to_pylist() for c in (
                    "anchor", "id", "key", "first", "words")]):
                letters = np.frombuffer(words, np.int64).tolist()
                if own != anchor:
                    anchor, automaton = own, Automaton()
                else:
                    for end, size in enumerate(automaton.matches(letters)):
                        if size >= width:
                            start, stop = first + end - width + 1, first + end + 1
                            if out and out[-1][0] == i and out[-1][1] == key and out[-1][3] >= start > out[-1][2]:
                                out[-1][3] = stop
                            else:
                                out.append([i, key, start, stop])
                automaton.add(letters)
            columns = list(zip(*out)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int32()))],
                ["id", "key", "start", "end"])
    return stream


def _windows(width: int):
    """A task function: the runs of very large shards to a row per window."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, starts, names = [], [], [], []
            for i, key, first, number, words in zip(*[batch.column(c).to_pylist() for c in (
                    "id", "key", "first", "number", "words")]):
                names.append(Spans(np.frombuffer(words, np.uint64)).windows(width).view(np.int64))
                starts.append(first + np.arange(number, dtype=np.int32))
                ids += [i] * number
                keys += [key] * number
            flat = np.concatenate(names) if names else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.int32()),
                 pa.array(np.concatenate(starts) if starts else np.zeros(0, np.int32)), pa.array(flat)],
                ["id", "key", "start", "name"])
    return explode


def position(id_col: str, start_col: str) -> Column:
    """(id, start) as one number; a null id comes last."""
    return (F.coalesce(F.col(id_col), F.lit(_LAST)).cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(10,0)")
            + F.col(start_col)).cast("decimal(31,0)")


def repeated_runs(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(occurrences of runs whose anchor occurs more than once, one row per different run of these).

    The first has ``several``: the anchor has different runs. The second has how often the run occurs (``times``)
    and where first (``place``).
    """
    often = found.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("fragment").alias("lo"), F.max("fragment").alias("hi")).where("n > 1")
    held = stored(found.join(often.select("anchor", (F.col("lo") < F.col("hi")).alias("several")), "anchor"), "runs-again")
    kinds = held.groupBy("anchor", "fragment", "several").agg(
        F.count(F.lit(1)).alias("times"), F.min(position("id", "first")).alias("place"))
    return held, stored(kinds, "run-kinds")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, key, text``; the key tells texts apart whose ids are equal."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.hash(F.col(text_col)).alias("key"),
                       F.col(text_col).alias("text"))


def with_text(texts: DataFrame, rows: DataFrame, how: str = "inner") -> DataFrame:
    """Joins ``rows`` (columns ``at_id, at_key`` and others) to the texts."""
    return texts.join(rows, texts["id"].eqNullSafe(rows["at_id"]) & (texts["key"] == rows["at_key"]), how)


def earlier_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, k: int = ANCHOR,
    shard_runs: int = SHARD_RUNS,
) -> DataFrame:
    """``id, key, start, end``: spans of words, overlapping or not, that together are the words to be removed."""
    texts = keyed(docs, id_col, text_col)
    held, kinds = repeated_runs(stored(texts.mapInArrow(_find_runs(width, k), _RUNS), "runs"))
    placed = held.withColumn("at", position("id", "first"))
    joined = placed.join(kinds.drop("several"), ["anchor", "fragment"])
    whole = joined.where(F.col("at") > F.col("place")).select(
        "id", "key", F.col("first").alias("start"), (F.col("first") + F.col("number") + (width - 1)).alias("end"))
    shards = kinds.where("several").groupBy("anchor").agg((F.count(F.lit(1)) > shard_runs).alias("large"))
    firsts = joined.where(F.col("several") & (F.col("at") == F.col("place"))).join(shards, "anchor")
    firsts = firsts.select("id", "key", "anchor", "large", "first", "number").distinct()
    wanted = firsts.groupBy(F.col("id").alias("at_id"), F.col("key").alias("at_key")).agg(
        F.collect_list(F.struct("id", "key", "anchor", "large", "first", "number")).alias("wanted"))
    fetched = with_text(texts, wanted).select("text", "wanted").mapInArrow(_fetch_words(width), _WORDS)
    fetched = stored(fetched.dropDuplicates(["id", "key", "anchor", "first"]), "run-words")
    small = fetched.where("NOT large").repartition("anchor").sortWithinPartitions(
        F.col("anchor"), F.col("id").asc_nulls_last(), "first")
    partly = small.mapInArrow(_stream(width), _SPANS)
    windows = fetched.where("large").mapInArrow(_windows(width), "id long, key int, start int, name long")
    windows = windows.withColumn("at", position("id", "start"))
    least = windows.groupBy("name").agg(F.min("at").alias("place"))
    single = windows.join(least, "name").where(F.col("at") > F.col("place")).select(
        "id", "key", "start", (F.col("start") + width).cast("int").alias("end"))
    return whole.unionByName(partly).unionByName(single)


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, spans) to (id, n_words, n_removed, kept_text)."""
    for batch in batches:
        spans = batch.column(2).to_pylist()
        data, offsets = text_bytes(batch.column(1))
        for first, last in pieces(offsets, PIECE):
            part = data[offsets[first]:offsets[last]]
            starts, ends, words = word_spans(part, offsets[first:last + 1] - offsets[first])
            cover = np.zeros(len(starts) + 1, np.int64)
            for i in range(first, last):
                for span in spans[i] or ():
                    cover[words[i - first] + span["start"]] += 1
                    cover[words[i - first] + span["end"]] -= 1
            kept = np.cumsum(cover)[:-1] == 0
            before = np.concatenate([[0], np.cumsum(kept)])
            raw, texts = part.tobytes(), []
            starts, ends = starts[kept].tolist(), ends[kept].tolist()
            left = before[words].tolist()
            for a, b in zip(left[:-1], left[1:]):
                texts.append(b" ".join([raw[s:e] for s, e in zip(starts[a:b], ends[a:b])]))
            n = np.diff(words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), pa.array(n), pa.array(n - np.diff(before[words])),
                 pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])


def remove_earlier(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, k: int = ANCHOR,
                   shard_runs: int = SHARD_RUNS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``: the words that are left, joined by one blank.

    Null text has no words. A window of a row counts as earlier than an equal one by (id, start), so rows that
    repeat both id and text keep what they have; a null id comes after all others.
    """
    spans = earlier_spans(docs, id_col, text_col, width, k, shard_runs).groupBy(
        F.col("id").alias("at_id"), F.col("key").alias("at_key")).agg(
        F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = with_text(keyed(docs, id_col, text_col), stored(spans, "passages"), "left")
    return joined.select("id", "text", "spans").mapInArrow(
        _rewrite, "doc_id long, n_words long, n_removed long, kept_text string")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
again AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS rn FROM g) WHERE rn > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM d),
marked AS (
  SELECT words.doc_id, words.i, word, max(again.i) OVER (
    PARTITION BY words.doc_id ORDER BY words.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM words LEFT JOIN again ON words.doc_id = again.doc_id AND words.i = again.i),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS t
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def query(spark, sf_dir):
    left = remove_earlier(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
