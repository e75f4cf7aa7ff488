"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order byte context tree: how often each byte followed each context of up to
``ORDER`` bytes. A text's code length under a language is the sum over its bytes of the cost of the byte in
the longest known context; a byte the context has not seen costs an escape (method C, with exclusion of the
bytes already ruled out) and is then looked for in the next shorter context, at last among all 256 bytes.
The statistics are frozen, so the cost of every byte in every context is worked out once, and a text is
scored with two table lookups per byte for all languages together.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.frames import Scratch, fresh, given_names, plain_names, remainder, stored, table
from lakestrata.llm.tokens import text_bytes

ORDER = 3
#: The classifier is fitted on at most so many whole documents of each language, drawn by a hash of id and text.
SAMPLE_DOCS = 400
#: Contexts of two and more bytes are kept if the sample has them so often, in any language.
LEAST_SEEN = 2
#: So many keys of the sample are sent to all tasks at most; more are joined by shuffling.
TOLD = 100_000
UNDETERMINED = "und"
#: Bytes scored at once, which bounds the memory of a task whatever the lengths of the texts.
BLOCK = 1 << 20
#: Bytes of the sample that a task counts.
COUNTED = 16 << 20


def sample(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = SAMPLE_DOCS, keep=stored,
) -> DataFrame:
    """``lang, text`` of at most ``per_language`` documents a language; rows without text or language are left out.

    Documents are told apart by id and text together, so null ids and repeated ids are as good as any other;
    rows that are equal in both are one document. ``keep`` writes a work table.
    """
    labelled = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("key"),
        F.col(text_col).alias("text"))
    drawn = labelled.select("lang", "key").distinct().withColumn("draw", F.shiftrightunsigned("key", 1))
    # of a language with many documents only those with a small draw can be among the first
    sizes = drawn.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    drawn = drawn.join(sizes, "lang").where(F.col("draw") / F.lit(2.0 ** 63) < F.lit(4.0 * per_language) / F.col("size"))
    order = Window.partitionBy("lang").orderBy("draw", "key")
    picked = drawn.withColumn("place", F.row_number().over(order))
    picked = keep(picked.where(F.col("place") <= per_language).select("lang", "key"), "language-sample")
    if picked.count() <= TOLD:  # few keys find their texts where they lie
        picked = F.broadcast(picked)
    found = labelled.join(picked, ["lang", "key"], "left_semi")
    return found.dropDuplicates(["lang", "key"]).select("lang", "text")


def count_contexts(order: int):
    """A task function: (lang, text) to how often each byte follows each context, summed over all batches."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in set(langs):
                data, offsets = text_bytes(batch.column(1).filter(pa.array(langs == lang)))
                place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
                code = np.zeros(len(data), np.int64)
                for k in range(order + 1):
                    code[k:] += data[:len(data) - k].astype(np.int64) << (8 * k)
                    found = np.unique(code[place >= k], return_counts=True)
                    held[lang, k] = _added(held[lang, k], found) if (lang, k) in held else found
        for (lang, k), (codes, n) in sorted(held.items()):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes)), pa.array(np.full(len(codes), k, np.int32)),
                 pa.array(codes), pa.array(n.astype(np.int64))], ["lang", "depth", "code", "n"])
    return count


def _added(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The counts of two sorted lists of codes, as one."""
    codes, place = np.unique(np.concatenate([one[0], two[0]]), return_inverse=True)
    n = np.zeros(len(codes), np.int64)
    np.add.at(n, place, np.concatenate([one[1], two[1]]))
    return codes, n


@dataclass
class Model:
    """What tasks need: byte classes, the node of each context, and the cost of each class in each node."""

    languages: list[str]
    classes: np.ndarray  # of each byte; 0 is a byte the sample does not have, and the place before a text
    nodes: np.ndarray  # [class, class, class] of the preceding bytes, the last one last
    costs: np.ndarray  # [node, class, language] in bits


def build_model(rows: list[tuple[str, int, int, int]], least_seen: int = LEAST_SEEN) -> Model:
    """``rows``: (lang, depth, code, n), the code being the context's bytes and then the byte. Depth is 3 at most."""
    languages = sorted({r[0] for r in rows})
    seen = sorted({r[2] for r in rows if r[1] == 0})
    classes = np.zeros(256, np.uint8 if len(seen) < 256 else np.int16)
    classes[seen] = np.arange(1, len(seen) + 1)
    width = len(seen) + 1
    follow: dict[tuple[int, ...], np.ndarray] = {(): np.zeros((len(languages), width))}
    number = {lang: i for i, lang in enumerate(languages)}
    for lang, depth, code, n in rows:
        symbols = [int(classes[(code >> (8 * k)) & 255]) for k in range(depth, -1, -1)]
        context = tuple(symbols[:-1])
        if context not in follow:
            follow[context] = np.zeros((len(languages), width))
        follow[context][number[lang], symbols[-1]] += n
    follow = {c: counts for c, counts in sorted(follow.items(), key=lambda x: (len(x[0]), x[0]))
              if len(c) < 2 or counts.sum() >= least_seen}
    nodes = np.zeros((width, width, width), np.int32)
    costs = np.zeros((len(follow), width, len(languages)), np.float32)
    for node, context in enumerate(follow):
        if context:
            nodes[(..., *context)] = node
        costs[node] = _costs(context, follow, 256 - len(seen)).T
    return Model(languages, classes, nodes, costs)


def _costs(context: tuple[int, ...], follow: dict, unseen: int) -> np.ndarray:
    """Bits of each class after ``context`` (row: language), along the escapes to ever shorter contexts."""
    shape = follow[()].shape
    bits, escape, open_ = np.zeros(shape), np.zeros((shape[0], 1)), np.ones(shape, bool)
    with np.errstate(divide="ignore", invalid="ignore"):
        for k in range(len(context) + 1):
            if (counts := follow.get(context[k:])) is None:
                continue
            counts = np.where(open_, counts, 0)
            n, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
            new = counts > 0
            bits = np.where(new, escape - np.log2(counts / (n + kinds)), bits)
            escape = np.where(n > 0, escape - np.log2(kinds / (n + kinds)), escape)
            open_ &= ~new
        # each class but 0 is one byte; class 0 stands for all bytes that the sample does not have
        return np.where(open_, escape + np.log2(unseen + open_[:, 1:].sum(1, keepdims=True)), bits)


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = SAMPLE_DOCS,
) -> Model:
    """Counts contexts of a bounded sample of the labelled ``docs`` and freezes them. The label set is small.

    As many tasks count as the sample has bytes for, however many hold a piece of it, so that the number of counts
    follows the sample alone.
    """
    with Scratch(docs.sparkSession, "language-texts") as work:
        drawn = work.table(sample(docs, id_col, text_col, lang_col, per_language, work.table), "drawn")
        return build_model([tuple(r) for r in _counts(drawn).collect()])


def _counts(drawn: DataFrame) -> DataFrame:
    size = drawn.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counts = drawn.coalesce(size // COUNTED + 1).mapInArrow(count_contexts(ORDER), "lang string, depth int, code long, n long")
    return counts.groupBy("lang", "depth", "code").agg(F.sum("n").alias("n"))


def code_lengths(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each text under each language; beside the texts only what belongs to one block is held."""
    total = np.zeros((len(offsets) - 1, len(model.languages)))
    width = model.nodes.shape[0]
    flat = model.nodes.ravel()
    for at in range(0, len(data), BLOCK):
        stop = min(at + BLOCK, len(data))
        first = np.searchsorted(offsets, at, "right") - 1
        last = np.searchsorted(offsets, stop, "left")
        lead = min(at, ORDER)
        cls = model.classes[data[at - lead:stop]]
        starts = offsets[:-1][np.searchsorted(offsets[:-1], at - lead):last] - (at - lead)
        index = np.zeros(len(cls) - lead, np.int64)
        for k in range(ORDER, 0, -1):
            before = np.zeros_like(cls)
            before[k:] = cls[:-k]
            for j in range(k):  # bytes of the text before do not count
                edge = starts + j
                before[edge[edge < len(cls)]] = 0
            index *= width
            index += before[lead:]
        cost = model.costs[flat[index], cls[lead:]]
        begin = np.maximum(offsets[first:last], at)
        own = np.flatnonzero(np.minimum(offsets[first + 1:last + 1], stop) > begin)
        total[first + own] += np.add.reduceat(cost, begin[own] - at, axis=0, dtype=np.float64)
    return total


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``bits`` (a byte, under that language), replacing such columns.

    The score is the share of the language among all, from the code lengths. Null text and text without a
    letter give ``und`` with score 0 and null bits, and so does everything if nothing was learned. Ties go to
    the first language by name.
    """
    letters = fresh("has_letter", docs.columns)
    held = docs.drop("lang_pred", "score", "bits")
    marked = held.withColumn(letters, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.languages, UNDETERMINED], object)
        for batch in batches:
            n, wanted = batch.num_rows, np.array(batch.column(batch.num_columns - 1).to_pylist(), bool)
            best, share, bits = np.full(n, len(names) - 1), np.zeros(n), np.zeros(n)
            if known.languages and wanted.any():
                data, offsets = text_bytes(batch.column(text_col).filter(pa.array(wanted)))
                lengths = code_lengths(known, data, offsets)
                best[wanted] = lengths.argmin(1)
                least = lengths.min(1, keepdims=True)
                share[wanted] = 1 / np.exp2(np.maximum(least - lengths, -1000)).sum(1)
                bits[wanted] = least[:, 0] / np.diff(offsets)
            valid = best < len(names) - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names[best], pa.string()), pa.array(share),
                 pa.array(bits, mask=~valid)],
                [*batch.schema.names[:-1], "lang_pred", "score", "bits"])

    from pyspark.sql.types import DoubleType, StringType, StructType

    schema = StructType(list(held.schema.fields)).add("lang_pred", StringType()).add(
        "score", DoubleType()).add("bits", DoubleType())
    return marked.mapInArrow(score, schema)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    model = train(docs.where(~held_out))
    return predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


#: A text that costs more than all bytes being equally likely is in none of the languages.
REJECT_BITS = 8.0


def keep_known_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents in one of the learned languages; the rest (no letter, or nothing like them) go."""
    held_out = remainder(id_col, 4) == 2
    model = train(docs.where(~held_out), id_col, text_col, lang_col)
    inner, named = plain_names(docs)
    judged = predict(inner, model, named[text_col])
    return given_names(judged.where((F.col("lang_pred") != UNDETERMINED) & (F.col("bits") <= REJECT_BITS)), docs)
