"""Merkle manifest of a dataset, by lag and lead windows.

A leaf is the SHA-256 of a document's fields. Per language, leaves stand by id; ``FAN`` consecutive nodes become
their digest, level by level, until one is left, the subroot. Subroots by language become the root likewise.

Leaves are sorted by ranges, and counts per range give each its number. Blocks of ``FAN ** LEVELS`` consecutive
leaves then climb ``LEVELS`` levels in one task: at each level a node lies on the row of its first leaf, lag and
lead columns at fixed offsets, masked by slot and run length, hold its siblings, and the first child of a run
hashes the parent. The blocks' nodes are the leaves of the next climb, so no task ever has a whole language.
Siblings above a block are joined back by block. Digests are 32 bytes wherever they are moved.

Null languages are a group of their own, before the empty one. Null ids come first, and equal ids are ordered by
leaf, so repeated rows are repeated leaves. A null id counts as the empty text where its checksum is asked for.
An empty table has no rows. Only the named columns are read, so others may have any name.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.frames import Scratch, lower_ascii, remainder, table

FAN = 8
#: Levels of one climb: a block has 512 leaves.
LEVELS = 3
BLOCK = FAN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before: binary, after: binary>>"


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def as_hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def field(value: Column) -> Column:
    """A field as it is hashed: its length in bytes, a colon, its value; ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, tampered: int = 3) -> DataFrame:
    """``id, group, node, forged``: the leaf, and the leaf of the tampered text where ``tampered`` divides the id's checksum."""
    id_, source, lang, n_chars, text = (F.col(f"`{name}`") for name in fields)
    head = F.concat(*[field(value) for value in (id_, source, lang, n_chars)])
    return docs.select(
        id_.cast("long").alias("id"), F.coalesce(F.concat(F.lit("="), lang), F.lit("")).alias("group"),
        digest(F.concat(head, field(text))).alias("node"),
        F.when(remainder(id_, tampered) == 0, digest(F.concat(head, field(lower_ascii(text))))).alias("forged"))


def numbered(work: Scratch, nodes: DataFrame) -> DataFrame:
    """Adds ``idx``, a node's number in its group by (id, node), and ``size``, how many the group has."""
    order = ["group", "id", "node"]
    ordered = work.table(nodes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "row", F.monotonically_increasing_id()), "ordered").withColumn("part", F.shiftright("row", 33))
    # a row for each range that a group reaches into
    group = Window.partitionBy("group")
    ahead = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = work.table(ordered.groupBy("group", "part").agg(
        F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).select(
        "group", "part", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"),
        F.sum("n").over(group).alias("size")), "ranges")
    return ordered.join(ranges, ["group", "part"]).withColumn(
        "idx", F.col("row") - F.col("first") + F.col("ahead")).drop("row", "part", "first", "ahead")


def climb(nodes: DataFrame) -> DataFrame:
    """Adds ``block``, ``path``, a node's siblings at each level inside its block, and ``top``, the block's node.

    ``top`` is on the first row of each block only. A group with one node left does not climb further.
    """
    rows = Window.partitionBy("group", "block").orderBy("idx")
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    frame, plain = nodes.withColumn("block", F.expr(f"idx div {BLOCK}")), [*nodes.columns, "block"]
    held, sides = "node", []
    for level in range(LEVELS):
        step = FAN ** level
        place = F.floor(F.col("idx") / step)
        count = F.ceil(F.col("size") / step)
        slot = place % FAN
        run = F.least(F.lit(FAN), count - place + slot)
        frame = frame.withColumns({
            **{f"lag{j}": F.lag(held, j * step).over(rows) for j in range(1, FAN)},
            **{f"lead{j}": F.lead(held, j * step).over(rows) for j in range(1, FAN)}})
        before = F.concat(*[F.when(slot >= j, F.col(f"lag{j}")).otherwise(F.lit(b"")) for j in range(FAN - 1, 0, -1)])
        after = F.concat(*[F.when(slot + j < run, F.col(f"lead{j}")).otherwise(F.lit(b"")) for j in range(1, FAN)])
        parent = F.when(count > 1, digest(as_hex(F.concat(F.col(held), after)))).otherwise(F.col(held))
        frame = frame.select(
            *plain, *[f"path{k}" for k in sides], *([held] if held != "node" else []),
            F.when((F.col("idx") % step == 0) & (count > 1), F.struct(before.alias("before"), after.alias("after"))
                   ).alias(f"path{level}"),
            F.when(F.col("idx") % (step * FAN) == 0, parent).alias(f"node{level + 1}"))
        if level:  # from the row of the first leaf to all leaves below the node
            frame = frame.withColumn(f"path{level}", F.last(f"path{level}", ignorenulls=True).over(so_far))
        held = f"node{level + 1}"
        sides.append(level)
    path = F.array_compact(F.array(*[F.col(f"path{k}") for k in sides])).cast(_PATH)
    return frame.select(*plain, path.alias("path"), F.col(held).alias("top"))


def tower(work: Scratch, nodes: DataFrame) -> list[DataFrame]:
    """The nodes, then those of their blocks, and so on, until every group has one."""
    found = [nodes]
    largest = nodes.agg(F.max("size")).first()[0] or 0
    while largest > 1:
        above = climb(found[-1]).where(F.col("idx") % BLOCK == 0).select(
            "group", F.col("block").alias("idx"), F.ceil(F.col("size") / BLOCK).alias("size"), F.col("top").alias("node"))
        found.append(work.table(above, "nodes"))
        largest = -(-largest // BLOCK)
    return found


def descend(found: list[DataFrame], upper: DataFrame) -> DataFrame:
    """The lowest nodes with their whole ``path``. ``upper`` has that of the highest ones, and columns that all get."""
    for nodes in reversed(found[:-1]):
        above = upper.withColumnsRenamed({"idx": "block", "path": "above"}).drop("size", "node")
        upper = climb(nodes).drop("top").join(above, ["group", "block"]).withColumn(
            "path", F.concat("path", "above")).drop("block", "above")
    return upper


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf (32 bytes) and its siblings give, in hexadecimal."""
    return F.aggregate(path, as_hex(leaf), lambda node, side: F.sha2(
        F.concat(as_hex(side["before"]), node, as_hex(side["after"])).cast("binary"), 256))


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, tampered: int = 3) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``fields`` name the id, source, language, number of characters and text.
    """
    spark = docs.sparkSession
    with Scratch(spark, "merkle-leaves") as first:
        # the leaves are written once, as the sort by ranges reads its input twice
        made = first.table(leaves(docs, fields, tampered), "leaves")
        work = Scratch(spark, "merkle")  # read by the result
        languages = tower(work, numbered(work, made))
    no_path = F.array().cast(_PATH)
    subroots = work.table(languages[-1].select("group", "node"), "subroots")
    roots = tower(work, numbered(work, subroots.select(F.lit("").alias("group"), F.col("group").alias("id"), "node")))
    top = roots[-1].select("group", "idx", no_path.alias("path"), F.col("node").alias("root"))
    if len(roots) == 1:  # one language or none: its subroot is the root
        top = roots[0].select("id", "node", no_path.alias("path"), F.col("node").alias("root"))
    upper = descend(roots, top).select(
        F.col("id").alias("group"), F.lit(0).cast("long").alias("idx"), "path", F.col("node").alias("subroot"), "root")
    upper = work.table(upper, "upper")
    if len(languages) == 1:
        rows = languages[0].join(upper, ["group", "idx"])
    else:
        rows = descend(languages, upper)
    siblings = F.array_join(F.transform("path", lambda side: as_hex(F.concat(side["before"], side["after"]))), "")
    root = as_hex(F.col("root"))
    return rows.select(
        F.col("id").alias("doc_id"), as_hex(F.col("node")).alias("leaf"), as_hex(F.col("subroot")).alias("subroot"),
        root.alias("root"), F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        fold(F.coalesce("forged", "node"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def _sql_field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


_HEAD = " || ".join(_sql_field(name) for name in FIELDS[:-1])
ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({_HEAD} || {_sql_field('text')}) AS leaf,
         sha256({_HEAD} || {_sql_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS forged,
         list_reduce([4294967295] || [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')],
           lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
  FROM documents),
l AS (SELECT *, xor(crc, 4294967295) % 3 = 0 AS bad, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS idx,
             count(*) OVER (PARTITION BY g) AS n FROM d),
t AS (
  SELECT g, 0 AS lev, idx, n, leaf AS h FROM l
  UNION ALL
  SELECT g, lev + 1, idx // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM t WHERE n > 1
  GROUP BY g, lev, idx // 8),
s AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS lev, idx, n, h FROM s
  UNION ALL
  SELECT lev + 1, idx // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM u WHERE n > 1
  GROUP BY lev, idx // 8),
k AS (SELECT *, max(lev) OVER (PARTITION BY g) AS top FROM (
  SELECT g, lev, idx, n, h FROM t UNION ALL SELECT NULL, lev, idx, n, h FROM u)),
sib AS (
  SELECT a.g, a.lev, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lo,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS hi
  FROM k a JOIN k b ON a.g IS NOT DISTINCT FROM b.g AND a.lev = b.lev AND a.idx // 8 = b.idx // 8
  WHERE a.n > 1 GROUP BY a.g, a.lev, a.idx),
f AS (
  SELECT doc_id, g, 0 AS lev, idx, CASE WHEN bad THEN forged ELSE leaf END AS cur, '' AS proof FROM l
  UNION ALL
  SELECT doc_id, f.g, f.lev + 1, f.idx // 8, sha256(lo || cur || hi), proof || lo || hi
  FROM f JOIN sib ON f.g = sib.g AND f.lev = sib.lev AND f.idx = sib.idx),
e AS (
  SELECT y.doc_id, 0 AS lev, s.idx, y.f.cur AS cur, y.f.proof AS proof, s.h AS subroot
  FROM (SELECT doc_id, arg_max(f, lev) AS f FROM f GROUP BY doc_id) y JOIN s ON y.f.g = s.g
  UNION ALL
  SELECT doc_id, e.lev + 1, e.idx // 8, sha256(lo || cur || hi), proof || lo || hi, subroot
  FROM e JOIN sib ON sib.g IS NULL AND e.lev = sib.lev AND e.idx = sib.idx),
z AS (SELECT doc_id, arg_max(e, lev) AS e FROM e GROUP BY doc_id)
SELECT z.doc_id, l.leaf, z.e.subroot AS subroot, r.h AS root, sha256(z.e.proof) AS proof_sha256, z.e.cur AS folded_root,
       z.e.cur = r.h AS verified
FROM z JOIN l ON z.doc_id = l.doc_id CROSS JOIN (SELECT h FROM u WHERE n = 1) r"""


def query(spark, sf_dir):
    return manifest(table(spark, sf_dir, "documents"))
