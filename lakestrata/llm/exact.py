"""Exact deduplication with a heavy-hitter split.

Texts are equal when they are identical without white space. Of equal texts the one with the most code
points stays, then the smallest id. Digests that many rows share would all meet in one shuffle partition,
so they are found first (a Misra-Gries summary per task), their winners are computed with map-side
combination and broadcast, and their rows are judged where they lie. All other digests are shuffled.
"""

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.frames import given_names, plain_names, stored, without_spaces

#: Counters per Misra-Gries summary. Every digest of at least ``2 / COUNTERS`` of all rows is found, and no
#: more than ``COUNTERS`` digests are ever broadcast.
COUNTERS = 1000
#: Lengths and ids packed into one number: the longer text is larger, then the smaller id.
_ID_SPAN = Decimal(10 ** 20)
_TOP_ID = Decimal(2 ** 63 - 1)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``text_sha256`` of the text without white space, ``rank``, ``row``. Null text is empty.

    ``rank`` orders the members of a group. A null id comes after all others. ``row`` tells repeated rows apart.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    place = F.coalesce(F.lit(_TOP_ID) - F.col(id_col).cast("decimal(19,0)") + 1, F.lit(0))
    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.sha2(without_spaces(text).cast("binary"), 256).alias("text_sha256"),
        (F.length(text).cast("decimal(10,0)") * F.lit(_ID_SPAN) + place)
        .cast("decimal(38,0)").alias("rank"),
        F.monotonically_increasing_id().alias("row"))


def misra_gries(counters: int):
    """A task function: at most ``counters`` digests, each with a count it reaches at least."""
    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, int] = {}
        for batch in batches:
            for digest, n in batch["text_sha256"].value_counts(sort=False).items():
                held[digest] = held.get(digest, 0) + n
            if len(held) > counters:  # the batch form: take the (counters + 1)-th largest count off all
                off = sorted(held.values(), reverse=True)[counters]
                held = {digest: n - off for digest, n in held.items() if n > off}
        yield pd.DataFrame({"text_sha256": list(held), "least": list(held.values())}).astype(
            {"text_sha256": "object", "least": "int64"})
    return summarise


def heavy_digests(marked: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them each that ``2 / counters`` of the rows share.

    A task's summary misses at most ``1 / (counters + 1)`` of its rows per digest, hence so does the sum.
    """
    found = marked.select("text_sha256").mapInPandas(misra_gries(counters), "text_sha256 string, least long")
    found = found.groupBy("text_sha256").agg(F.sum("least").alias("least"))
    total = marked.agg(F.count(F.lit(1))).scalar()
    return (found.where(F.col("least") * counters > total)
            .orderBy(F.desc("least"), "text_sha256").limit(counters).select("text_sha256"))


def _winners(rows: DataFrame) -> DataFrame:
    return rows.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("group_size"), F.max("rank").alias("best"), F.max_by("row", "rank").alias("winner"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Exactly one row of each group is kept, also if rows are repeated. Groups whose only ids are null keep a
    null id. An empty table gives an empty result; other columns are not looked at.
    """
    marked = stored(digests(docs, id_col, text_col), "digests")
    heavy = stored(heavy_digests(marked, counters), "heavy")
    hot = marked.join(F.broadcast(heavy), "text_sha256")
    rest = marked.join(F.broadcast(heavy), "text_sha256", "left_anti")
    hot_winners = _winners(hot)  # at most ``counters`` rows
    judged = marked.join(F.broadcast(hot_winners), "text_sha256").unionByName(
        rest.join(_winners(rest), "text_sha256"))
    remainder = F.col("best") % F.lit(_ID_SPAN)
    keep = F.when(remainder > 0, (F.lit(_TOP_ID) + 1 - remainder).cast("long"))
    return judged.select(
        F.col("id").alias("doc_id"), keep.alias("keep_id"), "group_size",
        (F.col("row") == F.col("winner")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, whole and with all their columns, as one row each.

    Rows that repeat both the id and the text are one document: the first that Spark meets stays.
    """
    kept = exact_groups(docs, id_col, text_col, counters).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_digest"))
    inner, named = plain_names(docs)
    text = F.coalesce(F.col(named[text_col]), F.lit(""))
    marked = inner.withColumn("digest", F.sha2(without_spaces(text).cast("binary"), 256))
    found = marked.join(
        kept, F.col(named[id_col]).cast("long").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest")),
        "left_semi")
    return given_names(found.dropDuplicates([named[id_col], "digest"]), docs)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
r AS (
  SELECT *, row_number() OVER w AS rn, first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM r"""


def query(spark, sf_dir):
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
