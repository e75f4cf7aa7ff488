"""A hidden Markov language model, with a unigram model as the base to compare with.

A text is its lower-case words and then one end token. Each word has a class, known from its letters; the latent
states emit classes, and a class emits its words by their counts in the training texts, one more for each word and
one for all words never seen. So the model is a hidden Markov model over words whose emission is
``P(class | state) * P(word | class)``, and the likelihood of a text is that of its classes (the forward
recursion) times the second factors, which do not depend on the order.

The texts are kept in blocks: word numbers of a dictionary of the block, and classes. Counting sends the
dictionaries through a shuffle, never the tokens, and the counts of a block's words come back to the block.
Baum-Welch sums expected counts over all training tokens; the tasks' sums are added as whole numbers, so the
order in which they arrive does not matter.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.frames import Scratch, arrow_schema, remainder, stored, table
from lakestrata.llm.tokens import lower_ascii, mix, pieces, span_hashes, text_bytes, word_spans

STATES, CLASSES, PASSES = 6, 256, 4
#: Training cuts the classes of a text into stretches of this length, each a sequence of its own.
STRETCH = 128
#: Bytes of text in a block (a longer text has a block of its own).
BLOCK = 6 << 20
#: Expected counts are added as multiples of this.
UNIT = 2.0 ** -20

_BLOCKS = ("block long, docs array<bigint>, held_out binary, ends binary, classes binary, words binary, "
           "hashes binary, counts binary, kinds binary")


def word_classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """1 to ``CLASSES - 1`` from the last two bytes of a word and whether it has more; 0 is the end token."""
    last = data[ends - 1].astype(np.uint64)
    before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
    longer = np.minimum(ends - starts, 3).astype(np.uint64)
    return (mix(last | before << np.uint64(8) | longer << np.uint64(16)) % np.uint64(CLASSES - 1) + np.uint64(1)).astype(np.uint8)


def _blocks():
    """A task function: (row, id, held_out, text) to blocks; the row number of its first text names a block."""
    schema = arrow_schema(_BLOCKS)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            held = np.array(batch.column(2).to_pylist(), np.uint8)
            data, offsets = text_bytes(batch.column(3))
            for first, last in pieces(offsets, BLOCK):
                part = lower_ascii(data[offsets[first]:offsets[last]])
                starts, ends, words = word_spans(part, offsets[first:last + 1] - offsets[first])
                hashes = span_hashes(part, starts, ends)
                kinds = word_classes(part, starts, ends)
                found, at, number = np.unique(hashes, return_index=True, return_inverse=True)
                doc = np.repeat(np.arange(last - first), np.diff(words))
                counts = np.bincount(number[held[first:last][doc] == 0], minlength=len(found))
                closing = words[1:] + np.arange(1, last - first + 1)  # an end token after each text
                classes = np.zeros(len(hashes) + last - first, np.uint8)
                inner = np.ones(len(classes), bool)
                inner[closing - 1] = False
                classes[inner] = kinds
                packed = pa.compress(number.astype(np.uint32).tobytes(), codec="zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
                    [int(rows[first]), batch.column(1).slice(first, last - first).to_pylist(), held[first:last].tobytes(),
                     closing.astype(np.int64).tobytes(), classes.tobytes(), packed,
                     found.tobytes(), counts.astype(np.int64).tobytes(), kinds[at].tobytes()], schema.types)], schema=schema)
    return make


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch of blocks one by one, as each is large."""
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in batch.columns)


def _dictionaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, hashes, counts, kinds) to a row per word of the block's dictionary."""
    for batch in batches:
        for block, hashes, counts, kinds in _rows(batch):
            hashes = np.frombuffer(hashes, np.int64)
            n = len(hashes)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, block, np.int64)), pa.array(np.arange(n, dtype=np.int32)), pa.array(hashes),
                pa.array(np.frombuffer(counts, np.int64)), pa.array(np.frombuffer(kinds, np.uint8).astype(np.int32))],
                ["block", "place", "hash", "n", "kind"])


class Params:
    """Probabilities of the first state, of the next state (row: from) and of the class (row: state)."""

    def __init__(self, first: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.first, self.move, self.emit = first, move, emit

    @classmethod
    def start(cls, states: int, classes: int, counts: np.ndarray) -> "Params":
        """Sticky states that emit all classes by their frequency, each disturbed in its own fixed way."""
        noise = np.random.default_rng(7).random((states, classes))
        emit = (counts + 1.0) * (0.5 + noise)
        move = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(1, keepdims=True))

    @classmethod
    def from_counts(cls, first: np.ndarray, move: np.ndarray, emit: np.ndarray) -> "Params":
        """The maximum of the expected counts, a little flattened so that nothing is impossible."""
        first, move, emit = first + 0.1, move + 0.1, emit + 0.01
        return cls(first / first.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def stretches(classes: np.ndarray, ends: np.ndarray, held: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Training texts cut into rows of ``length`` classes, and how many of each row count."""
    begins = np.concatenate([[0], ends[:-1]])
    number = np.where(held == 0, -(-(ends - begins) // length), 0)
    text = np.repeat(np.arange(len(ends)), number)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    at = begins[text] + nth * length
    sizes = np.minimum(ends[text] - at, length)
    index = np.minimum(at[:, None] + np.arange(length), max(len(classes) - 1, 0))
    return classes[index], sizes


def expected_counts(params: Params, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch: expected first states, moves and emissions of many short sequences, with scaled recursions."""
    states, classes = params.emit.shape
    order = np.argsort(-sizes, kind="stable")
    rows, sizes = rows[order], sizes[order]
    length = int(sizes[0]) if len(sizes) else 0
    active = [int(np.searchsorted(-sizes, -t, "left")) for t in range(length)]  # rows longer than t
    emit = np.ascontiguousarray(params.emit.T)
    ahead, scale = [], []
    for t in range(length):
        a = params.first * emit[rows[:, 0]] if not t else (ahead[-1][:active[t]] @ params.move) * emit[rows[:active[t], t]]
        scale.append(a.sum(1, keepdims=True))
        ahead.append(a / scale[-1])
    first, move, counts = np.zeros(states), np.zeros((states, states)), np.zeros((classes, states))
    back = np.ones((active[-1] if length else 0, states))
    for t in range(length - 1, -1, -1):
        both = ahead[t] * back
        for s in range(states):
            counts[:, s] += np.bincount(rows[:active[t], t], both[:, s], classes)
        if not t:
            first = both.sum(0)
            break
        step = emit[rows[:active[t], t]] * back / scale[t]
        move += ahead[t - 1][:active[t]].T @ step
        back = np.ones((active[t - 1], states))
        back[:active[t]] = step @ params.move.T
    return first, move * params.move, counts.T


def log10_likelihoods(params: Params, classes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The exact log10 probability of each whole sequence: scaled forward recursion, all sequences side by side."""
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    sizes = ends - begins
    order = np.argsort(-sizes, kind="stable")
    begins, sizes = begins[order], sizes[order]
    out, emit = np.zeros(len(ends)), np.ascontiguousarray(params.emit.T)
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")
    a = None
    for t, n in enumerate(active.tolist()):
        a = (params.first if a is None else a[:n] @ params.move) * emit[classes[begins[:n] + t]]
        scale = a.sum(1)
        out[:n] += np.log10(scale)
        a /= scale[:, None]
    result = np.empty(len(ends))
    result[order] = out
    return result


def _expect(shared):
    """A task function over (held_out, ends, classes): the task's expected counts as (place, value)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params = shared.value
        total = None
        for batch in batches:
            for held, ends, classes in _rows(batch):
                rows, sizes = stretches(
                    np.frombuffer(classes, np.uint8), np.frombuffer(ends, np.int64), np.frombuffer(held, np.uint8), STRETCH)
                for at in range(0, len(rows), 4096):
                    found = expected_counts(params, rows[at:at + 4096], sizes[at:at + 4096])
                    flat = np.concatenate([x.ravel() for x in found])
                    total = flat if total is None else total + flat
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(np.rint(total / UNIT).astype(np.int64))],
                ["place", "value"])
    return work


def baum_welch(blocks: DataFrame, start: Params, passes: int) -> Params:
    """``passes`` rounds over all training texts. What is gathered are the parameters, of a fixed number."""
    spark, params = blocks.sparkSession, start
    states, classes = start.emit.shape
    for _ in range(passes):
        shared = spark.sparkContext.broadcast(params)
        sums = blocks.select("held_out", "ends", "classes").mapInArrow(_expect(shared), "place int, value long")
        total = np.zeros(states + states * states + states * classes)
        for row in sums.groupBy("place").agg(F.sum("value").alias("value")).collect():
            total[row.place] = row.value * UNIT
        first, move, emit = np.split(total, [states, states + states * states])
        params = Params.from_counts(first, move.reshape(states, states), emit.reshape(states, classes))
    return params


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """The counts of one block's words in the order of its dictionary."""
    counts = np.zeros(len(pdf), np.int64)
    counts[pdf["place"].to_numpy()] = pdf["n"].to_numpy()
    return pd.DataFrame({"of_block": [pdf["block"].iloc[0]], "known": [counts.tobytes()]})


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(shared):
    """A task function over (docs, held_out, ends, classes, words, known): the scores of each text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params, n_train, n_kinds, n_ends, of_class, words_of_class = shared.value
        penalty = np.log10(of_class + words_of_class + 1.0)
        for batch in batches:
            for docs, held, ends, classes, words, known in _rows(batch):
                ends = np.frombuffer(ends, np.int64)
                classes = np.frombuffer(classes, np.uint8)
                known = np.frombuffer(known or b"", np.int64)
                tokens = np.diff(ends, prepend=0)
                size = 4 * int(len(classes) - len(ends))
                raw = pa.decompress(words, size, codec="zstd", asbytes=True) if size else b""
                counts = np.full(len(classes), n_ends, np.int64)
                inner = np.ones(len(classes), bool)
                inner[ends - 1] = False
                counts[inner] = known[np.frombuffer(raw, np.uint32)]
                begins = ends - tokens
                logs = np.add.reduceat(np.log10(counts + 1.0), begins)
                base = logs - tokens * np.log10(n_train + n_kinds + 1.0)
                # the end token is the only one of its class
                inside = np.add.reduceat(np.where(inner, np.log10(counts + 1.0) - penalty[classes], 0.0), begins)
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), pa.array(np.frombuffer(held, bool)), pa.array(tokens), pa.array(np.add.reduceat((counts > 0).astype(np.int64), begins)),
                    pa.array(np.full(len(docs), n_train, np.int64)), pa.array(base),
                    pa.array(log10_likelihoods(params, classes, ends) + inside)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return work


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, passes: int = PASSES,
    params: Params | None = None,
) -> tuple[DataFrame, Params]:
    """(``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row, the parameters).

    Learns from the rows whose crc32 of the id modulo 7 is not 2 and scores all. Null text is empty: just the end
    token. An empty table gives an empty result; a table without training rows is scored with flat parameters.
    """
    spark = docs.sparkSession
    held_out = remainder(id_col, 7) == 2
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        held_out.alias("held_out"), F.col(text_col).alias("text"))
    blocks = stored(texts.mapInArrow(_blocks(), _BLOCKS), "lm-blocks")
    with Scratch(spark, "lm-counts") as work:
        entries = work.table(blocks.select("block", "hashes", "counts", "kinds").mapInArrow(
            _dictionaries, "block long, place int, hash long, n long, kind int"), "dictionaries")
        vocabulary = entries.groupBy("hash").agg(F.sum("n").alias("n"), F.min("kind").alias("kind")).where("n > 0")
        vocabulary = work.table(vocabulary, "vocabulary")
        by_class = vocabulary.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
        known = vocabulary.select("hash", F.col("n").alias("known"))
        back = entries.select("block", "place", "hash").join(known, "hash", "left").select(
            "block", "place", F.coalesce("known", F.lit(0)).alias("n"))
        packed = stored(back.groupBy("block").applyInPandas(_pack, "of_block long, known binary"), "lm-known")
    n_ends = docs.where(~held_out).count()
    of_class, words_of_class = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in by_class:
        of_class[row.kind], words_of_class[row.kind] = row.n, row.words
    n_train = int(of_class.sum()) + n_ends
    n_kinds = int(words_of_class.sum()) + (n_ends > 0)
    frequency = of_class.copy()
    frequency[0] = n_ends
    if params is None:
        params = baum_welch(blocks, Params.start(states, CLASSES, frequency), passes)
    shared = spark.sparkContext.broadcast((params, n_train, n_kinds, n_ends, of_class, words_of_class))
    joined = blocks.join(packed, F.col("block") == F.col("of_block"), "left")
    scores = joined.select("docs", "held_out", "ends", "classes", "words", "known").mapInArrow(_score(shared), _SCORED)
    return scores, params


def query(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents"))[0]
