"""Exact Jaccard join of documents on word shingles, in the metric space of the Jaccard distance.

Two documents link when at least ``PERCENT`` of a hundred of the shingles of both together are shared, so
their distance ``1 - similarity`` is at most ``RADIUS``. The result is the components of these links.

1. A document becomes its set of shingle hashes. Equal sets become one node.
2. Linked sets share some of their first shingles in any common order, and a good part of them at that. The
   order puts frequent shingles last. Sets that share enough of the rarer first shingles, or any frequent
   one, are put in one region, so no link leaves a region.
3. A region that fits a task is joined there. A larger one is split by pivots: each set goes to the cell of
   its nearest pivot and, by the triangle inequality, to each cell whose pivot is at most twice the radius
   farther. The cells are regions again. What still is too large after some rounds is joined in blocks, pair
   by pair of blocks, so nothing is ever left out.
4. Inside a region, the sets within the radius of a pivot are one component. A member needs to be a pivot
   only if some set outside the component is within the radius plus its own distance of that pivot.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.components import components
from lakestrata.llm.frames import Scratch, arrow_schema, given_names, plain_names, stored, table
from lakestrata.llm.tokens import lower_ascii, mix, pieces, span_hashes, text_bytes, window_hashes, word_spans

SHINGLE = 5
PERCENT = 80
#: A region of more shingles than this is split before it is joined (8 bytes each).
REGION_SHINGLES = 4_000_000
#: First shingles of more rows than this are put last in the order.
OFTEN = 16
#: A first shingle of more sets than this, in that order, is frequent.
FREQUENT = 64
#: Shingles to be put last that are told to all tasks: the most frequent ones, 8 bytes each.
#: The others only cost speed.
TOLD = 1 << 20
#: Bytes of text handled at once.
PIECE = 4 << 20
#: Rounds of splitting by pivots before blocks are used.
ROUNDS = 3
PIVOTS = 64
GROWTH = 2


def doc_sets(column, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``width`` are one shingle."""
    data, offsets = text_bytes(column)
    data = lower_ascii(data)
    for first, last in pieces(offsets, PIECE):
        part = data[offsets[first]:offsets[last]]
        starts, ends, words = word_spans(part, offsets[first:last + 1] - offsets[first])
        hashes = span_hashes(part, starts, ends)
        windows = window_hashes(hashes, width)
        for a, b in zip(words[:-1], words[1:]):
            if b - a >= width:
                yield np.unique(windows[a:b - width + 1])
            elif b > a:
                yield window_hashes(hashes[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)


def set_digest(s: np.ndarray) -> tuple[str, int]:
    """A 128-bit name of a set, and 64 bits of it."""
    one = np.sum(mix(s), dtype=np.uint64)
    two = np.bitwise_xor.reduce(mix(s ^ np.uint64(0x632BE59BD9B4E019)))
    return f"{len(s)}-{int(one):016x}-{int(two):016x}", int(np.int64(one ^ two))


_DESCRIBED = "row long, id long, key long, size long, digest string, short long, firsts binary"


def _describe(width: int, percent: int):
    """A task function: (row, id, key, text) to the size, the names and the first shingles of each set."""
    schema = arrow_schema(_DESCRIBED)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, shorts, firsts = [], [], [], []
            for s in doc_sets(batch.column(3), width):
                name = set_digest(s) if len(s) else (None, None)
                sizes.append(len(s))
                digests.append(name[0])
                shorts.append(name[1])
                firsts.append(s[:first_length(len(s), percent)].tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *[
                pa.array(v, schema.field(k + 3).type) for k, v in enumerate((sizes, digests, shorts, firsts))]],
                schema=schema)
    return describe


def _each_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(short, firsts) to a row per first shingle."""
    for batch in batches:
        firsts = batch.column(1).to_pylist()
        flat = np.frombuffer(b"".join(firsts), np.int64)
        number = np.array([len(f) // 8 for f in firsts], np.int64)
        shorts = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), number)
        yield pa.RecordBatch.from_arrays([pa.array(shorts), pa.array(flat)], ["short", "shingle"])


def _sets(width: int):
    """A task function: the set of each text (last column) instead of the text."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in doc_sets(batch.column(batch.num_columns - 1), width)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sets, pa.binary())], [*batch.schema.names[:-1], "shingles"])
    return make


def first_length(size: int, percent: int) -> int:
    """So many first shingles of a set contain one that any linked set has among its own first ones."""
    return size - -(-size * percent // 100) + 1


def _firsts(told, width: int, percent: int):
    """A task function: (text) to the first shingles of its set, in the order that puts the told ones last."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = told.value
        for batch in batches:
            shorts, sizes, out = [], [], []
            for s in doc_sets(batch.column(0), width):
                if not len(s):
                    continue
                short, size = set_digest(s)[1], len(s)
                s = s.view(np.int64)
                if len(last):
                    place = np.minimum(np.searchsorted(last, s), len(last) - 1)
                    s = s[np.argsort(last[place] == s, kind="stable")]
                out.append(s[:first_length(size, percent)])
                shorts.append(np.full(len(out[-1]), short, np.int64))
                sizes.append(np.full(len(out[-1]), size, np.int32))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(v)) for v in (shorts, out, sizes)], ["short", "shingle", "size"])
    return pick


class Region:
    """The sets of one region as a sparse matrix, by which one set is compared with all others at once."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        _, self.shingle = np.unique(flat, return_inverse=True)
        self.start = np.concatenate([[0], np.cumsum(self.sizes)])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(self.shingle, kind="stable")
        self.owners = owner[order]
        n = int(self.shingle.max()) + 1 if len(flat) else 0
        self.posting = np.searchsorted(self.shingle[order], np.arange(n + 1))

    def shared(self, i: int) -> np.ndarray:
        """How many shingles each set shares with set ``i``."""
        own = self.shingle[self.start[i]:self.start[i + 1]]
        begin, number = self.posting[own], self.posting[own + 1] - self.posting[own]
        take = np.repeat(begin - np.concatenate([[0], np.cumsum(number)[:-1]]), number) + np.arange(number.sum())
        return np.bincount(self.owners[take], minlength=len(self.sizes))

    def compare(self, i: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether each set links with set ``i`` (whole numbers only), and the distances."""
        shared = self.shared(i)
        union = self.sizes + self.sizes[i] - shared
        return 100 * shared >= percent * union, 1 - shared / np.maximum(union, 1)


def join_region(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """For each set the first set of its component, all links between the sets being followed."""
    region, n = Region(sets), len(sets)
    radius = 1 - percent / 100 + 1e-9
    label = np.full(n, -1)
    for seed in range(n):
        if label[seed] >= 0:
            continue
        label[seed], todo, best = seed, [seed], np.full(n, np.inf)
        best[seed] = 0
        while todo:
            pivot = todo.pop()
            links, distance = region.compare(pivot, percent)
            outside = np.flatnonzero(label < 0)
            new = outside[links[outside]]
            label[new] = seed
            outside = np.flatnonzero(label < 0)
            # a member nearer to this pivot than any set outside less the radius has no link outside
            reach = distance[outside].min() - radius if len(outside) else np.inf
            todo = [m for m in todo if distance[m] >= reach]
            todo += [m for m in new if distance[m] >= reach]
    return label


def _join(percent: int):
    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id").drop_duplicates("id")
        label = join_region([np.frombuffer(s, np.int64) for s in pdf["shingles"]], percent)
        ids = pdf["id"].to_numpy()
        linked = ids != ids[label]
        return pd.DataFrame({"a": ids[linked], "b": ids[label][linked]})
    return join


def _to_cells(percent: int):
    """A function of a chunk of a region's sets and the region's pivots: the cells of each set."""
    def deal(sets: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        window = 2 * (1 - percent / 100) + 1e-9
        if sets.empty:
            return sets[["region", "id", "shingles"]]
        pivots = pivots.sort_values("id")
        own = [np.frombuffer(s, np.int64) for s in sets["shingles"]]
        centre = Region(own + [np.frombuffer(s, np.int64) for s in pivots["shingles"]])
        far = np.stack([centre.compare(len(own) + k, percent)[1][:len(own)] for k in range(len(pivots))])
        cell, which = np.nonzero(far <= far.min(0) + window)
        parent = sets["region"].iloc[0]
        names = [f"{parent}/{i}" for i in pivots["id"]]
        return pd.DataFrame({
            "region": [names[c] for c in cell], "id": sets["id"].to_numpy()[which],
            "shingles": sets["shingles"].to_numpy()[which]})
    return deal


def _sizes(regions: DataFrame) -> DataFrame:
    return regions.groupBy("region").agg(
        F.sum(F.length("shingles") / 8).cast("long").alias("load"), F.count(F.lit(1)).alias("members"))


def split_regions(large: DataFrame, limit: int, percent: int, work: Scratch) -> DataFrame:
    """(region, id, shingles) of too large regions dealt to the Voronoi cells of pivots, windows included.

    A region gets a pivot for each ``limit / 2`` shingles, but about ``PIVOTS`` at most in one round. Its sets
    are handled in chunks of about ``limit`` shingles, each together with the pivots.
    """
    sizes = _sizes(large).withColumn("chunks", F.ceil(F.col("load") / limit).cast("int")).withColumn(
        "wanted", F.least(F.lit(PIVOTS), 2 * F.col("chunks") + 1))
    sized = large.join(sizes, "region")
    drawn = sized.where(F.pmod(F.xxhash64("id", "region"), F.col("members")) < F.col("wanted"))
    first = large.groupBy("region").agg(F.min("id").alias("id"))  # so that there is one
    pivots = drawn.unionByName(sized.join(first, ["region", "id"], "left_semi")).dropDuplicates(["region", "id"])
    columns = ["region", "chunk", "id", "shingles"]
    pivots = pivots.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    pivots = work.table(pivots.select(columns), "pivots")
    chunks = sized.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    return chunks.select(columns).groupBy("region", "chunk").cogroup(
        pivots.groupBy("region", "chunk")).applyInPandas(
        _to_cells(percent), "region string, id long, shingles binary")


def block_pairs(large: DataFrame, limit: int) -> DataFrame:
    """(region, id, shingles) dealt to pairs of blocks, so that any two sets of a region meet in one of them."""
    sizes = _sizes(large).withColumn("blocks", F.ceil(2 * F.col("load") / limit).cast("int"))
    placed = large.join(sizes, "region").withColumn(
        "own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    placed = placed.select("region", "id", "shingles", "own", other)
    return placed.select(
        F.concat_ws("*", "region", F.least("own", "other"), F.greatest("own", "other")).alias("region"),
        "id", "shingles")


def region_links(
    regions: DataFrame, work: Scratch, percent: int = PERCENT, limit: int = REGION_SHINGLES, rounds: int = ROUNDS
) -> DataFrame:
    """Links (a, b) that connect exactly the sets which chains of links within a region connect.

    Regions above the limit are split by pivots, as long as all cells of a region together are at most ``GROWTH``
    times as large as the region; otherwise its blocks are joined pair by pair.
    """
    join = (_join(percent), "a long, b long")
    links, left = [], regions
    for step in range(rounds + 1):
        sizes = work.table(_sizes(left), "region-sizes")
        over = sizes.where(F.col("load") > limit)
        if over.isEmpty():
            links.append(left.groupBy("region").applyInPandas(*join))
            break
        links.append(left.join(over, "region", "left_anti").groupBy("region").applyInPandas(*join))
        large = work.table(left.join(over.select("region"), "region", "left_semi"), "large-regions")
        if step == rounds:
            links.append(block_pairs(large, limit).groupBy("region").applyInPandas(*join))
            break
        cells = work.table(split_regions(large, limit, percent, work), "region-cells")
        parent = F.regexp_extract("region", "^(.*)/[^/]*$", 1)
        grown = _sizes(cells).groupBy(parent.alias("region")).agg(F.sum("load").alias("cell_load"))
        good = over.join(grown, "region").where(F.col("cell_load") <= GROWTH * F.col("load")).select("region")
        good = work.table(good, "split-regions")
        bad = large.join(good, "region", "left_anti")
        links.append(block_pairs(bad, limit).groupBy("region").applyInPandas(*join))
        left = cells.withColumn("parent", parent).join(
            good.withColumnRenamed("region", "parent"), "parent", "left_semi").drop("parent")
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def _shared_by_sets(firsts: DataFrame) -> DataFrame:
    """Shingles that different sets have among their first ones, and how many rows have them."""
    return firsts.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("n"), F.min("short").alias("leader"), F.max("short").alias("other")).where("leader < other")


def region_edges(texts: DataFrame, each: DataFrame, width: int, percent: int, work: Scratch) -> DataFrame:
    """``short, other``: pairs of sets that connect any two linked ones.

    Say ``x`` and ``y`` are linked and the first shingles of ``x`` end first in the order. They share at least
    ``a = ceil(percent / (100 + percent) * (|x| + |y|))``, so at most ``|x| - a`` first shingles of ``x`` are not in
    ``y``, and the rest are first shingles of ``y``, too. Sets that share a frequent one are connected through its
    smallest set. Of all others the shared ones are counted: sets sharing fewer than this are no link.
    """
    found = each.where("short IS NOT NULL").select("short", "firsts").mapInArrow(
        _each_first, "short long, shingle long")
    often = _shared_by_sets(found).where(F.col("n") > OFTEN).orderBy(F.desc("n"), "shingle").limit(TOLD)
    told = np.sort(np.array([r[0] for r in often.select("shingle").collect()], np.int64))  # 8 MiB at most
    told = texts.sparkSession.sparkContext.broadcast(told)
    firsts = work.table(texts.select("text").mapInArrow(
        _firsts(told, width, percent), "short long, shingle long, size int"), "first-shingles")
    shared = firsts.join(_shared_by_sets(firsts).select("shingle"), "shingle").distinct()
    shared = work.table(shared, "shared-first-shingles")
    sets = shared.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("short").alias("leader"))
    shared = work.table(shared.join(sets, "shingle"), "first-shingle-groups")
    frequent = shared.where(F.col("n") > FREQUENT)
    starred = frequent.where("short <> leader").select("short", F.col("leader").alias("other"))
    # how many shared first shingles are not counted below
    hidden = frequent.groupBy("short").agg(F.count(F.lit(1)).alias("hidden"))
    rare = shared.where(F.col("n") <= FREQUENT).select("shingle", "short", "size")
    rare = work.table(rare.join(hidden, "short", "left").na.fill(0, ["hidden"]), "rare-first-shingles")
    one = rare.select("shingle", *[F.col(c).alias(f"{c}_1") for c in ("short", "size", "hidden")])
    two = rare.select("shingle", *[F.col(c).alias(f"{c}_2") for c in ("short", "size", "hidden")])
    # each set is compared with the at most FREQUENT - 1 others of the shingle
    similar = (100 * F.least("size_1", "size_2") >= percent * F.greatest("size_1", "size_2"))
    pairs = one.join(two, "shingle").where((F.col("short_1") < F.col("short_2")) & similar).groupBy(
        "short_1", "short_2", "size_1", "size_2", "hidden_1", "hidden_2").agg(F.count(F.lit(1)).alias("n"))
    least = F.ceil(percent * (F.col("size_1") + F.col("size_2")) / F.lit(100 + percent))

    def needed(k: int) -> Column:
        size = F.col(f"size_{k}")
        return size - F.ceil(percent * size / F.lit(100)) + 1 - (size - least) - F.col(f"hidden_{k}")

    pairs = pairs.where(F.col("n") >= F.least(needed(1), needed(2)))
    return starred.unionByName(pairs.select(F.col("short_1").alias("short"), F.col("short_2").alias("other"))).distinct()


def grouped_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT,
    limit: int = REGION_SHINGLES,
) -> DataFrame:
    """One row per document: ``id, key, size, component, component_id``; ``key`` is a hash of the text.

    ``component`` tells groups apart whatever their ids are; it is null for texts without words.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    each = stored(texts.select(F.monotonically_increasing_id().alias("row"), "id", "key", "text").mapInArrow(
        _describe(width, percent), _DESCRIBED), "shingle-sets")
    with Scratch(spark, "first-shingles") as work:
        regions = components(region_edges(texts, each, width, percent, work), "short", "other")
    # equal sets are one node: one of their rows stands for them
    classes = each.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("row").alias("node"), F.min("id").alias("rep"), F.min("short").alias("short"))
    classes = stored(classes, "set-classes")
    reps = classes.join(regions, classes["short"] == regions["node"]).select(
        classes["node"], F.col("component").cast("string").alias("region"))
    reps = each.join(reps, each["row"] == reps["node"]).select("node", "region", "id", "key")
    held = texts.join(reps, texts["id"].eqNullSafe(reps["id"]) & (texts["key"] == reps["key"]))
    held = held.select("region", reps["node"].alias("id"), "text").mapInArrow(
        _sets(width), "region string, id long, shingles binary")
    with Scratch(spark, "regions") as work:
        held = work.table(held, "regions")
        linked = components(region_links(held, work, percent, limit), "a", "b")
    named = classes.select("digest", "node", "rep").join(linked, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    named = stored(named, "linked-classes")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    own = named.join(least, "component").select("digest", "component", "component_id")
    return each.join(own, "digest", "left").select("id", "key", "size", "component", "component_id")


def similar_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT,
    limit: int = REGION_SHINGLES,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Null, empty and blank texts have the empty set and are linked with nothing. Rows that repeat an id are
    told apart only by their text; a null id is never a component's id unless all of its ids are null.
    """
    return grouped_rows(docs, id_col, text_col, width, percent, limit).select(
        F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                percent: int = PERCENT) -> DataFrame:
    """The document with the smallest id of each component, whole and once; documents without words all stay.

    Documents are told apart by id and text: a null id comes after all others, and of equal ids the text with the
    smallest hash stays. Rows that are equal in both are one document.
    """
    rows = grouped_rows(docs, id_col, text_col, width, percent)
    # the smallest id of a group is null only if all are, so that nulls are last
    least = rows.where("component IS NOT NULL AND id <=> component_id").groupBy("component").agg(
        F.min("component_id").alias("id"), F.min("key").alias("key"))
    kept = least.select("id", "key").unionByName(rows.where("component IS NULL").select("id", "key").distinct())
    kept = kept.select(F.col("id").alias("kept_id"), F.col("key").alias("kept_key"))
    inner, named = plain_names(docs)
    found = inner.join(kept, F.col(named[id_col]).cast("long").eqNullSafe(F.col("kept_id"))
                       & (F.xxhash64(F.col(named[text_col])) == F.col("kept_key")), "left_semi")
    return given_names(found.dropDuplicates([named[id_col], named[text_col]]), docs)


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach AS (
  WITH RECURSIVE r(doc_id, other) AS (
    SELECT doc_id, doc_id FROM words UNION SELECT r.doc_id, links.b FROM r JOIN links ON links.a = r.other)
  SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT words.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM words LEFT JOIN sizes USING (doc_id) JOIN reach USING (doc_id)"""


def query(spark, sf_dir):
    return similar_groups(table(spark, sf_dir, "documents"))
