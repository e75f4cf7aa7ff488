"""Mixing sources to target weights along a time-varying curriculum, with DataFrame functions only.

Every source gets a target number of words: its weight's share of all words, at most ``REPEATS`` times what it
has, the excess going to the other sources by weight. Training time runs from 0 to 1. A source's weight at
time ``t`` is ``target * (1 + slope * (2 t - 1))``: heavy sources lead at first and the others at the end. Its
integral, ``target * (t + slope * (t * t - t))``, is the number of words demanded up to ``t``. The documents of
a source stand in the order of a hash of their ids and repeat from the start when they are used up; inverting
the integral at the words in front of a document gives the time at which it is due. Sorting by that time, by
ranges, gives the training order.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.frames import given_names, plain_names, stored, table
from lakestrata.llm.tokens import WORD

WEIGHTS = (5, 2, 1)
#: Slope of the weight schedule of the sources with each of the weights, between -1 and 1.
SLOPES = (-0.5, 0.0, 0.5)
REPEATS = 3
#: Documents of a source that are put in order together; a larger source has more such groups.
GROUP = 1 << 12


def n_words(text: Column) -> Column:
    """The number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id, source, size, key, mark`` of every row: ``key`` tells texts apart, ``mark`` orders the documents of a source."""
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
        F.xxhash64(F.col(text_col)).alias("key"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("mark"))


def targets(sized: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size, members, target, slope`` per source (by code point, null last).

    Sources are raised together until they meet their limit: in the order of ``source_size / weight``, the
    first ones are full, and the rest share what is left by weight. There is a row per source only, so
    windows over all of them are small.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("members"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1

    def turn(values: tuple) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(rank, F.lit(len(values))) + 1).cast("int"))

    weighed = totals.select("*", turn(weights).alias("weight"), turn(slopes).alias("slope"))
    fullness = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = fullness.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - repeats * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    share = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = weighed.select(
        "*", F.row_number().over(fullness).alias("place"), left.alias("left"), share.alias("share"))
    # the first source that would not be full: 1 * left / share <= repeats * size / weight, in whole numbers
    open_ = F.col("left") * F.col("weight") <= repeats * F.col("source_size") * F.col("share")
    level = level.withColumn("first", F.min(F.when(open_, F.col("place"))).over(everything))
    at_first = F.col("place") == F.col("first")
    level = level.select(
        "*", F.max(F.when(at_first, F.col("left"))).over(everything).alias("rest"),
        F.max(F.when(at_first, F.col("share"))).over(everything).alias("shares"))
    target = F.when(
        F.col("place") >= F.col("first"),
        F.col("weight").cast("double") * F.col("rest").cast("double") / F.col("shares").cast("double"),
    ).otherwise((F.lit(repeats) * F.col("source_size")).cast("double"))
    return level.select("source", "source_size", "members", target.alias("target"), "slope")


def plan_mix(
    sized: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, repeats: int = REPEATS, group: int = GROUP,
) -> DataFrame:
    """Adds ``source_size, target, slope, members`` and ``start``, the words of its source in front of the document.

    ``sized`` should be a written table. Running sums are taken in groups of the documents of a source, by
    ranges of the mark, and over the groups' totals, so that no task has all documents of a source.
    """
    shares = stored(targets(sized, weights, slopes, repeats), "mix-targets")
    groups = F.ceil(F.col("members") / group)
    place = F.floor(F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") * groups / F.lit(1 << 32)).cast("long")
    same = sized["source"].eqNullSafe(shares["source"])
    placed = sized.join(shares, same).select(
        sized["id"], sized["source"], "size", "key", "mark", "source_size", "target", "slope", place.alias("part"))
    parts = placed.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("source").alias("part_source"), F.col("part").alias("part_no"),
        F.coalesce(F.sum("part_size").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("source", "part").orderBy("mark", "id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = placed.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(
        parts, F.col("source").eqNullSafe(F.col("part_source")) & (F.col("part") == F.col("part_no")))
    return joined.select(
        "id", "source", "size", "key", "mark", "source_size", "target", "slope",
        (F.col("ahead") + F.col("within")).alias("start"))


def words_taken(repeats: int = REPEATS) -> Column:
    """Words of a document that the mix takes: all of it once per full round, and up to the target in the last."""
    limit = F.floor("target").cast("long")
    each = [F.greatest(F.lit(0), F.least(F.col("size"), limit - e * F.col("source_size") - F.col("start")))
            for e in range(repeats)]
    return sum(each[1:], each[0]).cast("long")


def due(offset: Column) -> Column:
    """The time at which a source's demand reaches ``offset`` words: the inverse of the integrated weight.

    Solves ``slope * t**2 + (1 - slope) * t = offset / target`` in the form that is also right for slope 0.
    """
    y, a = offset.cast("double") / F.col("target"), F.col("slope")
    b = F.lit(1.0) - a
    return (F.lit(2.0) * y) / (b + F.sqrt(b * b + F.lit(4.0) * a * y))


def copies(plan: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """A row for each time that a document is due: adds ``round`` and ``position`` (0 to 1), sorted by position.

    A document is due in a round if the middle of its words lies below the target; empty ones never are.
    """
    rounds = plan.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    offset = F.col("round") * F.col("source_size") + F.col("start")
    rounds = rounds.where((F.col("size") > 0) & (2 * offset + F.col("size") <= 2 * F.col("target")))
    return rounds.withColumn("position", due(offset)).orderBy("position", "mark", "source", "id", "round")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` in training order: documents repeat or are left out as the targets ask. Columns as given.

    Rows that agree in id, source and text are one document that is due as often as all of them are.
    """
    sized = stored(sizes(docs, id_col, text_col, source_col), "mix-sizes")
    whole = ["id", "source", "key"]
    timed = copies(plan_mix(sized)).groupBy(*[F.col(c).alias(f"due_{c}") for c in whole]).agg(
        F.collect_list("position").alias("times"))
    inner, named = plain_names(docs)
    marked = inner.withColumn("text_key", F.xxhash64(F.col(named[text_col])))
    if not sized.groupBy(*whole).count().where("count > 1").isEmpty():
        marked = marked.dropDuplicates([named[id_col], named[source_col], "text_key"])
    joined = marked.join(
        timed, F.col(named[id_col]).eqNullSafe(F.col("due_id")) & F.col(named[source_col]).eqNullSafe(F.col("due_source"))
        & (F.col("text_key") == F.col("due_key")))
    return given_names(joined.withColumn("time", F.explode("times")).orderBy("time"), docs)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS mark FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight,
         [-0.5, 0.0, 0.5][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)]::DOUBLE AS slope
  FROM sized GROUP BY source),
level AS (
  SELECT *, row_number() OVER f AS place,
    CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0) AS BIGINT) AS rest,
    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS BIGINT) AS shares
  FROM totals
  WINDOW f AS (ORDER BY source_size / CAST(weight AS DOUBLE), source NULLS LAST),
         b AS (ORDER BY source_size / CAST(weight AS DOUBLE), source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
opened AS (SELECT place, rest, shares FROM level WHERE rest * weight <= 3 * source_size * shares ORDER BY place LIMIT 1),
target AS (
  SELECT source, source_size, slope,
    CASE WHEN place >= (SELECT place FROM opened)
         THEN CAST(weight AS DOUBLE) * CAST((SELECT rest FROM opened) AS DOUBLE) / CAST((SELECT shares FROM opened) AS DOUBLE)
         ELSE CAST(3 * source_size AS DOUBLE) END AS target FROM level),
placed AS (
  SELECT doc_id, size, source_size, target, slope, CAST(coalesce(sum(size) OVER (PARTITION BY sized.source
      ORDER BY mark, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized JOIN target ON sized.source IS NOT DISTINCT FROM target.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(
    greatest(0, least(size, CAST(floor(target) AS BIGINT) - start))
  + greatest(0, least(size, CAST(floor(target) AS BIGINT) - source_size - start))
  + greatest(0, least(size, CAST(floor(target) AS BIGINT) - 2 * source_size - start)) AS BIGINT) AS taken,
  CASE WHEN size > 0 AND start < floor(target) THEN (2.0::DOUBLE * (CAST(start AS DOUBLE) / target))
    / ((1.0::DOUBLE - slope) + sqrt((1.0::DOUBLE - slope) * (1.0::DOUBLE - slope)
       + 4.0::DOUBLE * slope * (CAST(start AS DOUBLE) / target))) END AS position
FROM placed"""


def query(spark, sf_dir):
    sized = stored(sizes(table(spark, sf_dir, "documents")), "mix-sizes")
    plan = plan_mix(sized)
    first = F.when((F.col("size") > 0) & (F.col("start") < F.floor("target")), due(F.col("start")))
    return plan.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", words_taken().alias("taken"),
        first.alias("position")).orderBy(F.col("position").asc_nulls_last(), "doc_id")
