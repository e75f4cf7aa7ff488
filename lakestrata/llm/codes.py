"""Vector code compression: product quantisation in whole numbers, with distances by Walsh-Hadamard transform.

Components become ``floor(4096 * x)``. A vector is cut into ``PARTS`` parts, each with a codebook that starts as the
parts of the ``ENTRIES`` vectors of smallest id; ``ROUNDS`` times, parts go to their nearest entry and entries to
the floored mean of their parts. Parts and entries, padded with zeros to a power of two, are transformed; as the
transform keeps distances but for the factor of its length, squared differences may be added up coefficient by
coefficient in sequency order, slow changes first. The entry that leads after the first block of coefficients
gives an upper bound, its whole distance; after every block the entries beyond it are dropped. All of it is exact.

Every round reads the vectors in Arrow batches; a task hands on one row per part and entry, of counts and sums,
and the driver gets ``PARTS * ENTRIES`` rows, the codebook. Nothing else is collected.

Rows whose vector is null or holds null or non-finite components are dropped. Of equal ids the smaller vector counts
as smaller; null ids are the largest. Vectors whose length differs, or is no multiple of ``PARTS``, are filled up with
zeros to the next multiple of the greatest length, so an empty one is all zeros. Components beyond ``LARGEST`` in
magnitude count as that; distances that no 64-bit number holds give the largest one. With fewer vectors than
``ENTRIES`` a codebook has as many entries. An empty table has no rows. Only the three named columns are read.
"""

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.frames import stored, table

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
LARGEST = 2.0 ** 50
_LONG = 2 ** 63 - 1
#: Blocks of coefficients between which entries are dropped.
BLOCKS = 4
#: Labels whose sums are broadcast; more of them are joined by label and salt.
BROADCAST_LABELS, SALTS = 50_000, 64
_SUMS = "part int, entry int, n long, sums array<decimal(38,0)>"


# --- distances ---

def sequency(length: int) -> np.ndarray:
    """The rows of the Hadamard matrix in the order of their sign changes."""
    rows = walsh(np.eye(length, dtype=np.int64), np.arange(length))
    return np.argsort((np.diff(rows, axis=0) != 0).sum(axis=0), kind="stable")


def walsh(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform along the last axis, whose length is a power of two."""
    length, half = values.shape[-1], 1
    while half < length:
        pairs = values.reshape(*values.shape[:-1], length // (2 * half), 2, half)
        a, b = pairs[..., 0, :], pairs[..., 1, :]
        values = np.stack([a + b, a - b], axis=-2).reshape(values.shape)
        half *= 2
    return values[..., order]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each transformed point the first of the nearest transformed entries, and the scaled squared distance."""
    length = points.shape[1]
    width = max(1, length // BLOCKS)
    first = points[:, None, :width] - entries[None, :, :width]
    so_far = (first * first).sum(axis=2)
    whole = points - entries[so_far.argmin(axis=1)]
    bound = (whole * whole).sum(axis=1)
    row, entry = np.nonzero(so_far <= bound[:, None])
    distance = so_far[row, entry]
    for at in range(width, length, width):
        difference = points[row, at:at + width] - entries[entry, at:at + width]
        distance = distance + (difference * difference).sum(axis=1)
        left = distance <= bound[row]
        row, entry, distance = row[left], entry[left], distance[left]
    # the entry that gave the bound is left, so every point has a row
    best = np.minimum.reduceat(distance, np.searchsorted(row, np.arange(len(points))))
    hits = np.flatnonzero(distance == best[row])
    _, where = np.unique(row[hits], return_index=True)
    return entry[hits[where]], best


class Codebooks:
    """``entries[part][entry]`` is a list of whole numbers; every part has as many entries, and ``width`` components."""

    def __init__(self, entries: list[list[list[int]]], width: int):
        self.entries, self.width = entries, width
        self.length = 1 << max(width - 1, 0).bit_length()
        self.order = sequency(self.length)
        #: Below this, squared distances of transformed parts fit into 64 bits.
        self.safe = math.isqrt((1 << 61) // self.length ** 3)
        self.largest = max((abs(x) for part in entries for entry in part for x in entry), default=0)

    def transformed(self, parts: np.ndarray) -> np.ndarray:
        padded = np.zeros((*parts.shape[:-1], self.length), parts.dtype)
        padded[..., :self.width] = parts
        return walsh(padded, self.order)

    def assign(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry of every part, and the squared distances added up per vector. ``parts`` is (vectors, parts, width)."""
        if not self.width or not len(parts):
            return np.zeros(parts.shape[:2], np.int64), np.zeros(len(parts), np.int64)
        exact = np.int64 if max(self.largest, int(np.abs(parts).max())) < self.safe else object
        points = self.transformed(parts.astype(exact))
        codes, errors = np.empty(parts.shape[:2], np.int64), np.zeros(len(parts), object)
        for part, own in enumerate(self.entries):
            codes[:, part], distance = nearest(points[:, part], self.transformed(np.array(own, exact)))
            errors = errors + distance // self.length
        return codes, errors

    def sha256(self) -> str:
        numbers = (str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


# --- vectors ---

def whole_numbers(values: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)``; the product is exact, as the factor is a power of two."""
    return np.floor(np.clip(values.astype(np.float64), -LARGEST, LARGEST) * SCALE).astype(np.int64)


def cut(column: pa.Array, width: int, parts: int = PARTS) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a list column are kept, and the parts of these."""
    sizes = np.diff(np.asarray(column.offsets)) if len(column) else np.zeros(0, np.int64)
    present = column.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.where(present, sizes, 0)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null is not a number
    row = np.repeat(np.arange(len(sizes)), sizes)
    present[row[~np.isfinite(values)]] = False
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    whole = np.zeros((len(sizes), parts * width), np.int64)
    use = present[row]
    whole[row[use], place[use]] = whole_numbers(values[use])
    return present, whole[present].reshape(int(present.sum()), parts, width)


def usable(vector: Column) -> Column:
    infinite = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != infinite))


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    """From the vectors of the smallest ids; a top-n, so no more than these leave their tasks."""
    kept = rows.where(usable(F.col("vector")))
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    width = -(-longest // parts)
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    _, cuts = cut(pa.array(start["vector"].to_pylist(), pa.list_(pa.float64())), width, parts)
    return Codebooks([cuts[:, part].tolist() for part in range(parts)], width)


def sums_of(books: Codebooks):
    """A task function: per part and entry that has any, how many parts are nearest to it and their sums."""
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(books.entries), len(books.entries[0])), np.int64)
        sums = np.zeros((*n.shape, books.width), object)
        for batch in batches:
            _, parts = cut(batch.column(0), books.width, len(books.entries))
            codes, _ = books.assign(parts)
            if np.abs(parts).max(initial=0) * len(parts) >= 2 ** 62:
                parts = parts.astype(object)
            for part, entry in np.argwhere(n >= 0):
                own = codes[:, part] == entry
                n[part, entry] += own.sum()
                sums[part, entry] += parts[own, part].sum(axis=0)
        some = np.argwhere(n > 0)
        yield pa.RecordBatch.from_arrays([
            pa.array(some[:, 0], pa.int32()), pa.array(some[:, 1], pa.int32()), pa.array(n[n > 0], pa.int64()),
            pa.array([[Decimal(int(x)) for x in sums[p, e]] for p, e in some], pa.list_(pa.decimal128(38, 0)))],
            names=["part", "entry", "n", "sums"])
    return add_up


def refined(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the floored mean of the parts that are nearest to it; unused ones stay."""
    found = rows.select("vector").mapInArrow(sums_of(books), _SUMS).groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(books.width)]).alias("sums"))
    entries = [list(part) for part in books.entries]
    for part, entry, n, sums in found.collect():  # as many rows as the codebooks have entries
        entries[part][entry] = [int(x) // n for x in sums]
    return Codebooks(entries, books.width)


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks for ``rows`` (``vec_id``, ``vector``)."""
    books = first_codebooks(rows, parts, entries)
    if books.width:
        for _ in range(rounds):
            books = refined(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` of every row with a usable vector."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, parts = cut(batch.column(2), books.width, len(books.entries))
            codes, errors = books.assign(parts)
            text = [bytes(row).hex() for row in codes.astype(np.uint8)]
            mask = pa.array(kept)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).filter(mask), batch.column(1).filter(mask), pa.array(text, pa.string()),
                pa.array([min(int(e), _LONG) for e in errors], pa.int64())], names=["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "vector").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def with_label_error(coded: DataFrame, broadcast_labels: int = BROADCAST_LABELS, salts: int = SALTS) -> DataFrame:
    """Adds the errors' sum over rows of the same label, null being one too."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(Decimal(_LONG))).cast("long")
    sums = stored(coded.groupBy("label").agg(total.alias("label_error")), "label-errors").withColumnRenamed(
        "label", "summed")
    same = F.col("label").eqNullSafe(F.col("summed"))
    if sums.count() <= broadcast_labels:
        return coded.join(F.broadcast(sums), same).drop("summed")
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)))
    copies = sums.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, same & (F.col("salt") == F.col("other"))).drop("summed", "salt", "other")


def compress(
    docs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """One row per usable vector: ``vec_id, code, error, label_error, codebooks_sha256``."""
    rows = docs.select(*[F.col(f"`{c}`").alias(name) for c, name in (
        (id_col, "vec_id"), (label_col, "label"), (vector_col, "vector"))])
    books = train(rows, parts, entries, rounds)
    coded = stored(encode(rows, books), "codes")
    return with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _sql_round(number: int) -> str:
    return f"""
a{number} AS MATERIALIZED (
  SELECT vec_id, part, min(d) AS d, arg_min(entry, d * {ENTRIES} + entry) AS entry FROM (
    SELECT vec_id, p.part, entry, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(p.v, b.v)]) AS d
    FROM p JOIN b{number} b ON p.part = b.part) GROUP BY vec_id, part)"""


def _sql_books(number: int) -> str:
    return f"""
b{number + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{number} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY i) AS v FROM (
      SELECT part, entry, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS mean FROM (
        SELECT p.part, entry, unnest(p.v) AS x, generate_subscripts(p.v, 1) AS i
        FROM p JOIN a{number} a ON p.vec_id = a.vec_id AND p.part = a.part)
      GROUP BY part, entry, i) GROUP BY part, entry) m ON b.part = m.part AND b.entry = m.entry)"""


ORACLE = f"""
WITH k AS (
  SELECT vec_id, label, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND coalesce(list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding]), true)),
p AS MATERIALIZED (
  SELECT vec_id, label, part, v[part * len(v) // {PARTS} + 1:(part + 1) * len(v) // {PARTS}] AS v
  FROM k, range({PARTS}) r(part)),
b0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v FROM p
  QUALIFY entry < {ENTRIES}),
{",".join(_sql_round(n) + "," + _sql_books(n) for n in range(ROUNDS))},
{_sql_round(ROUNDS)},
c AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS}
      GROUP BY vec_id),
s AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT c.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM c JOIN k ON c.vec_id = k.vec_id CROSS JOIN s"""


def query(spark, sf_dir):
    return compress(table(spark, sf_dir, "embeddings"))
