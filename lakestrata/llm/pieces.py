"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass.

A text gets a blank in front, blanks become marks, and it is cut where no piece can reach across: before a run of
marks and around line feeds. The distinct marked words of a batch are sorted, which makes them the leaves of a
trie in depth-first order, and the forward pass over a word starts where it leaves the word before: the forward
values of their common prefix are kept.

A value of a prefix is its best score and the piece it ends with. For a unigram vocabulary that is the usual
recursion. In a merge (BPE) vocabulary the pieces of a word are those that merging gives, not those with the
highest sum, so a step from one piece to the next has a score only if merging keeps the two apart; then exactly
one path to each prefix is left, and it is what merging gives. Characters outside the vocabulary become bytes.
"""

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from lakestrata.llm.frames import table
from lakestrata.llm.tokens import pieces as stretches

MARK = "▁"
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
_NEVER = float("inf")
#: Words whose ids a task remembers between batches, and pairs of pieces it remembers; beyond that it begins anew.
REMEMBERED, PAIRS = 200_000, 400_000


class Vocabulary:
    """Pieces, scores and what follows from them. Its size is fixed by the model file."""

    def __init__(self, pieces: list[tuple[str, float, str]], merges: bool):
        """``pieces``: (text, score, kind) by id; kind is normal, byte or other. ``merges``: a BPE vocabulary."""
        self.merges = merges
        self.ids = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == "normal"}
        self.scores = {text: pieces[i][1] for text, i in self.ids.items()}
        self.bytes = {int(text[3:5], 16): i for i, (text, _, kind) in enumerate(pieces) if kind == "byte"}
        self.unknown = next((i for i, p in enumerate(pieces) if p[2] == "unknown"), 0)
        self.output = [
            bytes([int(text[3:5], 16)]) if kind == "byte" else text.replace(MARK, " ").encode() if kind == "normal"
            else b"" for text, _, kind in pieces]
        self.worst = min(self.scores.values(), default=0.0) - 10
        self.ends: dict = {}  # pieces as a trie of their reversed texts; "" holds the piece
        for text in self.ids:
            node = self.ends
            for c in reversed(text):
                node = node.setdefault(c, {})
            node[""] = text
        feeds = not any("\n" in text for text in self.ids)
        self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n" if feeds else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        if merges:
            blank = {t for t in self.ids if len(t) > 1 and set(t) == {MARK}}
            last = max((self.scores[t] for t in blank), default=-_NEVER)
            if any(t.startswith(MARK * 2) and t not in blank for t in self.ids) or any(
                    s <= last for t, s in self.scores.items() if t not in blank and len(t) > 1):
                raise ValueError("pieces that join runs of blanks to words are not supported")
            self.blank = blank
            self.runs: dict[int, list[str]] = {}
            self.pairs: dict[tuple[str, str], bool] = {}
            self.left, self.right = {}, {}
            for text in self.ids:
                if text not in blank:
                    self._spines(text)

    @classmethod
    def load(cls, path: str = MODEL_PATH, merges: bool = True) -> "Vocabulary":
        """From a model file of the SentencePiece library."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def kind(i: int) -> str:
            if model.is_byte(i):
                return "byte"
            if model.is_unknown(i):
                return "unknown"
            return "other" if model.is_control(i) or model.is_unused(i) else "normal"

        return cls([(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.vocab_size())], merges)

    def merge(self, text: str, blanks: bool = False) -> list[tuple]:
        """The trees (text, bottleneck, left, right) that merging makes of the characters of ``text``.

        The best pair goes first, of equal ones the leftmost. A tree's bottleneck is the worst rank (minus the
        score) of all merges in it.
        """
        nodes: list = [(c, -_NEVER, None, None) for c in text]
        after, before = list(range(1, len(nodes) + 1)), list(range(-1, len(nodes) - 1))
        heap: list = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else len(nodes)
            if 0 <= i and j < len(nodes):
                both = nodes[i][0] + nodes[j][0]
                if both in self.scores and (blanks or both not in self.blank):
                    heapq.heappush(heap, (-self.scores[both], i, both))

        for i in range(len(nodes) - 1):
            offer(i)
        while heap:
            rank, i, both = heapq.heappop(heap)
            j = after[i]
            if nodes[i] is None or j >= len(nodes) or nodes[i][0] + nodes[j][0] != both:
                continue
            nodes[i] = (both, max(rank, nodes[i][1], nodes[j][1]), nodes[i], nodes[j])
            nodes[j], after[i] = None, after[j]
            if after[i] < len(nodes):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [n for n in nodes if n is not None]

    def _spines(self, text: str) -> None:
        """The symbols at either end of a piece while it is merged, each with the time it is used up."""
        trees = self.merge(text)
        if len(trees) != 1:
            return  # merging never gives this piece
        for side, child in ((self.left, 2), (self.right, 3)):
            node, spine, end = trees[0], [], _NEVER
            while node is not None:
                spine.append((node[0], end))
                end, node = node[1], node[child]
            side[text] = spine[::-1]

    def apart(self, one: str, two: str) -> bool:
        """Whether merging leaves the pieces ``one`` and ``two`` side by side.

        It walks through the symbols that meet at the border. Two of them merge if that is better than what
        uses up either of them next; of equals the leftmost goes first.
        """
        known = self.pairs.get((one, two))
        if known is None:
            left, right = self.right.get(one, [(one, _NEVER)]), self.left.get(two, [(two, _NEVER)])
            i = j = 0
            known = True
            while True:
                (a, end_a), (b, end_b) = left[i], right[j]
                score = self.scores.get(a + b) if a + b not in self.blank else None
                if score is not None and -score < end_a and -score <= end_b:
                    known = False
                    break
                if end_a == end_b == _NEVER:
                    break
                if end_a <= end_b:
                    i += 1
                else:
                    j += 1
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            self.pairs[one, two] = known
        return known

    def to_ids(self, pieces: list[str]) -> list[int]:
        out = []
        for piece in pieces:
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            else:
                out.extend(self.bytes.get(b, self.unknown) for b in piece.encode())
        return out

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """The ids of distinct marked words: one walk through the trie of the sorted words."""
        out, path, previous = {}, [(0.0, "", 0)], ""
        step = self._merged if self.merges else self._best
        for word in sorted(words):
            own, run = word, 0
            if self.merges and word.startswith(MARK):
                run = len(word) - len(word.lstrip(MARK))
                own = word[run - 1:] if run < len(word) else ""
            same, most = 0, min(len(own), len(previous), len(path) - 1)
            while same < most and own[same] == previous[same]:
                same += 1
            del path[same + 1:]
            for i in range(same, len(own)):
                path.append(step(own, i, path))
            pieces, at = [], len(own)
            while at:
                _, piece, at = path[at]
                pieces.append(piece)
            pieces.reverse()
            if run:
                if pieces and pieces[0] != MARK:
                    run -= 1
                else:
                    pieces = pieces[1:]
                pieces = self._run(run) + pieces
            out[word], previous = self.to_ids(pieces), own
        return out

    def _run(self, n: int) -> list[str]:
        """The pieces of a run of marks."""
        if n not in self.runs:
            if len(self.runs) > 10_000:
                self.runs.clear()
            self.runs[n] = [tree[0] for tree in self.merge(MARK * n, blanks=True)]
        return self.runs[n]

    def _merged(self, word: str, i: int, path: list) -> tuple[float, str, int]:
        """The forward value after character ``i``: the one piece that can follow the prefix before it."""
        node, at = self.ends, i
        while at >= 0 and (node := node.get(word[at])) is not None:
            text = node.get("")
            if text is not None and text in self.right:
                score, last, _ = path[at]
                if not at or self.apart(last, text):
                    return score + self.scores[text], text, at
            at -= 1
        return path[i][0] + self.worst, word[i], i  # not in the vocabulary

    def _best(self, word: str, i: int, path: list) -> tuple[float, str, int]:
        """The forward value after character ``i``: the best score of all pieces that end there."""
        best, node, at, single = None, self.ends, i, False
        while at >= 0 and (node := node.get(word[at])) is not None:
            text = node.get("")
            if text is not None:
                single |= at == i
                score = path[at][0] + self.scores[text]
                if best is None or score >= best[0]:  # of equal scores the longer piece
                    best = (score, text, at)
            at -= 1
        if not single:
            score = path[i][0] + self.worst
            if best is None or score > best[0]:
                best = (score, word[i], i)
        return best


def encode_batch(vocabulary: Vocabulary, texts: list[str | None], memory: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after another, and where each text's begin (one more entry)."""
    cut, number, rows = vocabulary.cut, {}, []
    for text in texts:
        words = cut.findall(MARK + text.replace(" ", MARK)) if text else ()
        rows.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
    new = vocabulary.encode_words([w for w in number if w not in memory])
    known = [memory[w] if w in memory else new[w] for w in number]
    if len(memory) + len(new) > REMEMBERED:
        memory.clear()
    memory.update(new)
    lengths = np.array([len(ids) for ids in known], np.int64)
    flat = np.fromiter((i for ids in known for i in ids), np.int32, int(lengths.sum()))
    begins = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    word = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    ids = gather(flat, begins[word], lengths[word])
    ends = np.concatenate([[0], np.cumsum(lengths[word])])
    return ids, ends[np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)].astype(np.int64)


def gather(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Stretches of ``flat`` one after another."""
    shift = begins - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(begins) else begins
    return flat[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))]


def decode_batch(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The text of each stretch of ids, without the blank put in front. Broken UTF-8 gives replacement characters."""
    lengths = np.array([len(b) for b in vocabulary.output], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    data = gather(np.frombuffer(b"".join(vocabulary.output), np.uint8), begins[ids], lengths[ids]).tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths[ids])])[offsets]
    return [data[a:b].decode(errors="replace").removeprefix(" ") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _shared(spark, vocabulary: Vocabulary):
    return spark.sparkContext.broadcast(vocabulary)  # as large as the model file


#: Texts handled at once, by their bytes; words and ids as Python objects take many times as much.
_BYTES = 1_000_000


def _parts(batch: pa.RecordBatch, text: int | str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Runs of rows with their texts; only those of one run are Python strings at a time."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
    for first, last in stretches(np.concatenate([[0], np.cumsum(sizes)]), _BYTES):
        rows = batch.slice(first, last - first)
        yield rows, rows.column(text).to_pylist()


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text in ``ids_col`` (replaced if there is one). Null and empty text have none."""
    held = docs.drop(ids_col)
    shared = _shared(docs.sparkSession, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, list[int]] = {}
        for batch in batches:
            for rows, texts in _parts(batch, text_col):
                ids, offsets = encode_batch(shared.value, texts, memory)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*rows.columns, lists], [*rows.schema.names, ids_col])

    return held.mapInArrow(work, StructType(list(held.schema.fields)).add(ids_col, ArrayType(IntegerType())))


def decode(rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of each list of ids in ``text_col`` (replaced if there is one); null ids are none."""
    held = rows.drop(text_col)
    shared = _shared(rows.sparkSession, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [x or [] for x in batch.column(ids_col).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            ids = np.fromiter((i for x in lists for i in x), np.int64, int(offsets[-1]))
            texts = decode_batch(shared.value, ids, offsets)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text_col])

    return held.mapInArrow(work, StructType(list(held.schema.fields)).add(text_col, "string"))


def round_trip(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip`` per row: encodes, decodes what it got, compares.

    ``ids_sha256`` is of the ids as little-endian 32-bit numbers, ``decoded_sha256`` of the decoded text in UTF-8.
    The trip is whole if the text comes back; the mark character itself comes back as a blank.
    """
    shared = _shared(docs.sparkSession, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, list[int]] = {}
        for batch in batches:
            for rows, texts in _parts(batch, 1):
                ids, offsets = encode_batch(shared.value, texts, memory)
                back = decode_batch(shared.value, ids, offsets)
                raw = ids.astype("<i4")
                names = [hashlib.sha256(raw[a:b].tobytes()).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([
                    rows.column(0), pa.array(np.diff(offsets)), pa.array(names, pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string()),
                    pa.array([t == (own or "").replace(MARK, " ") for t, own in zip(back, texts)])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return pairs.mapInArrow(work, StructType([pairs.schema["doc_id"]]).add("n_tokens", "long").add(
        "ids_sha256", "string").add("decoded_sha256", "string").add("round_trip", "boolean"))


def query(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents"), Vocabulary.load())
